"""Operators of the pipeline against brute force, and their defined cases on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablelab.llm import catalogue, components, decontaminate, fingerprints, groups, jaccard, language, licences, line_dedup, lm, mixing, toxicity, warc, words

BLANKS = " \t\n\x0b\x0c\r"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"


def make_words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def table(spark, texts, start=0):
    rows = [(start + i, t, "en", f"src{i % 3}", None if t is None else len(t), 0.5, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_rows(spark):
    """Nulls, empty and blank texts, a long text, repeated rows, a null id."""
    texts = [None, "", "  \n ", "one", "a b c d e f g h i j k l " * 3_000, "one two three four five six", "one two three four five six"]
    rows = [(i, t, None if i % 2 else "en", None if i == 3 else "s", None, 1.0, None) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[5], (None, "no id here at all today", None, None, None, None, None)], DOCUMENTS)


def split_blank(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += ch.lower() if "A" <= ch <= "Z" else ch
    return out


def shingles(text, size=5):
    w = split_blank(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_words_are_found_and_hash_alike():
    texts = ["Hello, World hello", "", None, "ÀB c\td", "x", "a  b", "  ", "HELLO,"]
    found = words.hash_words(pa.array(texts), words.BLANK_SEPARATED)
    expected = [w for t in texts for w in split_blank(t)]
    assert found.counts.tolist() == [len(split_blank(t)) for t in texts]
    by_word = {}
    for w, h in zip(expected, found.hash):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_long_words_hash_like_pieces(monkeypatch):
    texts = pa.array(["q" * 500 + " z " + "y" * 130 + " q", "q" * 500])
    whole = words.hash_words(texts, words.BLANK_SEPARATED).hash
    monkeypatch.setattr(words, "SLICE", 64)
    monkeypatch.setattr(words, "_tables", [])
    assert (words.hash_words(texts, words.BLANK_SEPARATED).hash == whole).all()


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (None, 4), (3, 7), (7, 1)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(links, "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 8, 9: 8}
    assert components.components(links.limit(0), "a", "b").count() == 0


def test_jaccard_groups_match_brute_force(spark):
    rng, texts = random.Random(3), []
    for family in range(8):
        base = make_words(rng, rng.choice([3, 12, 60, 200]))
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(make_words(rng, 3))
            texts.append(" ".join(copy))
    shared = " ".join(make_words(rng, 40))
    texts += [shared + " " + " ".join(make_words(rng, 60)) for _ in range(30)] + [None, "", " "]
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: r for r in jaccard.join_groups(table(spark, texts)).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == label


def test_jaccard_columns_are_cut_into_blocks(spark):
    rng = random.Random(5)
    base = make_words(rng, 100)
    texts = []
    for _ in range(60):
        copy = list(base)
        copy[rng.randrange(100)] = "new" + str(rng.random())
        texts.append(" ".join(copy))
    rows = jaccard.sizes(table(spark, texts), 5)
    bounds = jaccard.Bounds(80)
    found = jaccard.candidates(table(spark, texts), 5, bounds, 8)
    sets = jaccard.whole_sets(table(spark, texts), rows, found, 5)
    none = spark.createDataFrame([], "sig long, component long")
    whole = {r["sig"]: set(np.frombuffer(r["members"], np.uint64).tolist()) for r in sets.collect()}
    alike = lambda a, b: 100 * len(whole[a] & whole[b]) >= 80 * len(whole[a] | whole[b])
    assert len(whole) == 60 and all(alike(a, b) for a in whole for b in whole)
    for k in (7, 4096):
        columns = found.select("sig", F.explode("grams.h").alias("group"))
        links = groups.tie(columns, none, sets, bounds, lambda p: jaccard.verified(p, sets, bounds), limit=k)
        assert all(alike(r["a"], r["b"]) for r in links.collect())
        tied = components.components(links, "a", "b").collect()
        assert {r["id"] for r in tied} == set(whole) and len({r["component"] for r in tied}) == 1


@pytest.mark.parametrize("limit", [3, 1000])
def test_ties_reach_what_all_links_reach(spark, limit):
    rng, sets = np.random.default_rng(11), []
    for _ in range(12):  # chains of near sets around the threshold, of several sizes
        now = rng.integers(1, 1 << 62, int(rng.choice([6, 40, 150])), dtype=np.uint64)
        for _ in range(9):
            now = now.copy()
            now[rng.integers(0, len(now), max(1, len(now) // int(rng.choice([9, 12, 30]))))] = rng.integers(1, 1 << 62, dtype=np.uint64)
            sets.append(np.unique(now))
    rows = [(i, cell) for i in range(len(sets)) for cell in {i // 9, (i + 4) // 9 + 100}]
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    members = {}
    for i, cell in rows:
        members.setdefault(cell, []).append(i)
    links = {(min(a, b), max(a, b)) for own in members.values() for a in own for b in own if a != b and alike(sets[a], sets[b])}

    def label_of(pairs):
        label = list(range(len(sets)))
        for _ in sets:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    frame = spark.createDataFrame([(i, len(x), bytearray(x.tobytes())) for i, x in enumerate(sets)], "sig long, n long, members binary")
    none, bounds = spark.createDataFrame([], "sig long, component long"), jaccard.Bounds(80)
    groups_of = spark.createDataFrame(rows, "sig long, group long")
    got = [(r["a"], r["b"]) for r in groups.tie(groups_of, none, frame, bounds, lambda p: jaccard.verified(p, frame, bounds), limit).collect()]
    assert set(got) <= links and label_of(got) == label_of(links)
    assert 20 < len(got) <= len(links)


def test_jaccard_odd_rows(spark):
    got = sorted(jaccard.join_groups(odd_rows(spark)).collect(), key=str)
    assert len(got) == 9
    by = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got)
    assert by[(5, 2, 5)] == 2 and by[(6, 2, 5)] == 1 and by[(0, 0, 0)] == 1 and by[(None, 1 + 1, None)] == 1
    assert jaccard.join_groups(odd_rows(spark).limit(0)).count() == 0


def test_decontamination_finds_exact_and_near(spark):
    rng = random.Random(1)
    item = make_words(rng, 30)
    texts = [" ".join(make_words(rng, 50) + item[5:20] + make_words(rng, 9)), " ".join(make_words(rng, 80)), " ".join(item[:9]), "Go,go GO!", None, ""]
    items = spark.createDataFrame([(7, " ".join(item)), (8, "go go go"), (9, ""), (None, "x"), (10, None)], "item_id long, text string")
    index = decontaminate.build_index(table(spark, texts))
    phrases = decontaminate.phrases_of(items)
    got = {r["doc_id"]: r for r in decontaminate.summarise(index, decontaminate.search(index, phrases)).collect()}
    assert [got[i]["n_hit"] for i in range(6)] == [15, 0, 0, 3, 0, 0]
    assert got[0]["item_ids"] == ["7"] and got[3]["item_ids"] == ["8"] and got[4]["n_words"] == 0
    again = {r["doc_id"]: r["n_hit"] for r in decontaminate.summarise(index, decontaminate.search(index, phrases, portion=3)).collect()}
    assert again == {i: got[i]["n_hit"] for i in range(6)}
    near = table(spark, [" ".join(item[:5] + ["between"] + item[5:12])])
    near_index = decontaminate.build_index(near)
    assert decontaminate.search(near_index, phrases).count() == 0
    assert decontaminate.search(near_index, phrases, slop=1).count() == 1
    empty = decontaminate.build_index(near.limit(0))
    assert decontaminate.summarise(empty, decontaminate.search(empty, phrases)).count() == 0
    assert decontaminate.summarise(index, decontaminate.search(index, phrases.limit(0))).count() == 6
    odd = decontaminate.build_index(odd_rows(spark))
    assert decontaminate.summarise(odd, decontaminate.search(odd, phrases)).count() == 9


def test_licences(spark):
    texts = ["MIT licence?\nReleased under the MIT Licence", "licensed under Creative Commons BY-NC v4.0", "Copyright 2020 Me\n(c) You\nReleased under the MIT License!", "nothing", None, ""]
    got = {(r["doc_id"], r["license"]): (r["n_lines"], r["whole"]) for r in licences.scan(table(spark, texts), licences.known(spark)).collect()}
    assert got == {(0, "MIT"): (1, False), (2, "MIT"): (1, True)} | ({(1, "CC-BY-NC-4.0"): (1, True)} if (1, "CC-BY-NC-4.0") in got else {})
    assert licences.scan(odd_rows(spark), licences.known(spark)).count() == 0


def test_mixing_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 50), rng.choice(["a", "b", None]), rng.choice(["x", "y", "z"])) for i in range(3_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(frame, {"source": {"a": 0.5, "b": 0.3}, "lang": {"x": 0.2, "y": 0.3, "z": 0.5}}, budget=0.2).toPandas()
    mass = got["n_tokens"] * got["rate"]
    assert mass.sum() / got["n_tokens"].sum() == pytest.approx(0.2, abs=1e-4)
    for column, want in (("source", {"a": 0.5, "b": 0.3}), ("lang", {"x": 0.2, "y": 0.3, "z": 0.5})):
        for level, share in want.items():
            assert mass[got[column] == level].sum() / mass.sum() == pytest.approx(share, abs=1e-3)
    # the same fit by hand
    cells = got.assign(source=got["source"].fillna("?")).groupby(["source", "lang"])["n_tokens"].sum().unstack().to_numpy(float)
    w = cells / cells.sum()
    order = sorted(set(got["source"].fillna("?")))
    goal = np.array([{"a": 0.5, "b": 0.3, "?": 0.2}[s] for s in order])
    for _ in range(12):
        w *= (goal / w.sum(1))[:, None]
        w *= np.array([0.2, 0.3, 0.5]) / w.sum(0)
    rate = w / cells * 0.2 * cells.sum()
    first = got[(got["source"] == "a") & (got["lang"] == "y")]["rate"].iloc[0]
    assert first == pytest.approx(rate[order.index("a"), 1], rel=1e-3)
    assert mixing.mix(odd_rows(spark), {"source": {"s": 0.9}, "lang": {"en": 1.0, "xx": 3.0}}).count() == 9
    assert mixing.mix(frame.limit(0), {"source": {"a": 1.0}}).count() == 0


def test_mixing_stays_within_what_cells_have(spark):
    # the cell (a, x) has few tokens: it stays at rate 1 and the others of its levels make up for it
    n = {("a", "x"): 40, ("a", "y"): 400, ("b", "x"): 400, ("b", "y"): 1000}
    rows = [(i, "w", s, t) for i, (s, t) in enumerate(k for k, v in n.items() for _ in range(v))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, rate_of string").withColumnRenamed("rate_of", "_rate")
    targets = {"source": {"a": 0.4, "b": 0.6}, "_rate": {"x": 0.6, "y": 0.4}}
    raked = mixing.rake(mixing.count_cells(frame, ["source", "_rate"], mixing.tokens()), targets, budget=0.3)
    got = {(r["column"], r["level"]): r for r in mixing.attained(raked, targets).collect()}
    assert {k: r["wanted"] for k, r in got.items()} == {("source", "a"): 0.4, ("source", "b"): 0.6, ("_rate", "x"): 0.6, ("_rate", "y"): 0.4}
    assert all(abs(r["wanted"] - r["attained"]) < 0.005 for r in got.values())
    rates = {(r["source"], r["_rate"]): r["rate"] for r in mixing.mix(frame, targets, budget=0.3).distinct().collect()}
    assert rates["a", "x"] == 1.0 and max(rates.values()) <= 1.0 and 0.2 < rates["a", "y"] < 0.5
    # a target that no sample can meet is reported as missed
    raked = mixing.rake(mixing.count_cells(frame, ["source"], mixing.tokens()), {"source": {"a": 0.9}}, budget=0.5)
    got = {r["level"]: r["attained"] for r in mixing.attained(raked, {"source": {"a": 0.9}}).collect()}
    assert 0.8 < got["a"] < 0.87


def test_mixing_takes_clashing_names(spark):
    got = mixing.mix(odd_rows(spark).withColumnsRenamed({"score": "_n", "key": "n_tokens"}), {"source": {"s": 0.9}})
    assert got.count() == 9 and sorted(got.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "_n", "n_tokens", "rate", "kept"])


def test_levels_without_a_target_are_not_lost(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(20, 50), rng.choice(["en", "de", "fr", "es", "it", None]), f"src{i % 3}") for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.op4_mixing(spark, str(tmp_path)).toPandas()
    mass, n = got["n_tokens"] * got["rate"], got["n_tokens"]
    assert mass.sum() / n.sum() == pytest.approx(0.3, abs=1e-4)
    for other in (got["lang"].isna(), got["lang"] == "it"):
        assert (got.loc[other, "rate"] > 0).all() and got.loc[other, "kept"].any()
        assert mass[other].sum() / mass.sum() == pytest.approx(n[other].sum() / n.sum(), abs=1e-3)
    en, de = (mass[got["lang"] == x].sum() for x in ("en", "de"))
    assert en / de == pytest.approx(2, abs=1e-2)


def test_warc_round_trip_over_ranges(spark, tmp_path):
    pages = [(1, "http://a", "<p>é</p>" * 500), (2, None, "same"), (5, "http://b\nc", "same"), (4, "u", None), (3, "v", ""), (9, "w", "WARC/1.1\r\n\r\n x"), (None, "n", "alone"), (7, "m", "same")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    archives = warc.write(frame, folder)
    for size in (37, 1 << 20):
        got = {r["page_id"]: r for r in warc.read(archives, range_bytes=size, folder=folder).collect()}
        assert len(got) == 8
        for i, _, html in pages:
            body = (html or "").encode()
            assert got[i]["payload_bytes"] == len(body)
            assert got[i]["payload_digest"] == __import__("base64").b32encode(hashlib.sha1(body).digest()).decode()
            if got[i]["record_type"] == "response":
                assert bytes(got[i]["payload"]) == body
        assert {i: r["refers_to"] for i, r in got.items()} == {1: None, 2: 7, 5: 7, 7: None, 4: None, 3: 4, 9: None, None: None}
    assert warc.read(warc.write(frame.limit(0), folder), folder=folder).count() == 0


def test_toxicity_learns_marks(spark):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(240):
        w = make_words(rng, 60)
        if i % 4 == 0:
            for _ in range(6):
                w[rng.randrange(60)] = rng.choice(["blockhead", "nincompoop"])
        texts.append(" ".join(w))
        labels.append((i, i % 2, int(i % 4 == 0)))
    frame = table(spark, texts)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(frame.where("doc_id < 180"), marks.where("doc_id < 180"))
    got = toxicity.score(frame.where("doc_id >= 180"), model, ["doc_id"]).toPandas()
    hit = got[got["doc_id"] % 4 == 0]["score"]
    assert (hit >= 0.5).mean() > 0.8 and (got[got["doc_id"] % 4 != 0]["score"] < 0.5).mean() > 0.8
    assert toxicity.score(odd_rows(spark), model, ["doc_id"]).count() == 9
    assert toxicity.score(odd_rows(spark), toxicity.learn(frame, marks.limit(0)), ["doc_id"]).where("score != 0").count() == 0


def test_language_of_single_and_mixed_texts(spark):
    rng = random.Random(6)
    stock = {"aa": "the and of with from this", "bb": "der die und nicht mit auf", "cc": "que los una para con del"}
    text = lambda lang, n: " ".join(rng.choice(stock[lang].split()) for _ in range(n))
    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, chances = language.learn(frame)
    asked = spark.createDataFrame([(0, text("aa", 30)), (1, text("bb", 60) + " " + text("cc", 20)), (2, "123 !?"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.predict(asked, names, chances, ["doc_id"]).collect()}
    assert got[0]["lang_pred"] == "aa" and got[0]["langs"] == ["aa"]
    assert got[1]["langs"] == ["bb", "cc"] and 0.6 < got[1]["score"] < 0.9
    assert [got[i]["lang_pred"] for i in (2, 3, 4)] == ["und"] * 3
    none = language.learn(frame.limit(0))
    assert language.predict(asked, *none, ["doc_id"]).where("lang_pred != 'und'").count() == 0


def _fingerprint(text):
    import xxhash

    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    w = [x for x in split_blank(text) if x]
    terms = [w[i : i + 5] for i in range(max(1, len(w) - 4))] if w else []
    votes = np.zeros(64)
    for t in terms:
        h = 42
        for x in t:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
        votes += [1 if h >> b & 1 else -1 for b in range(64)]
    return signed(sum(1 << b for b in range(64) if votes[b] > 0))


def test_fingerprints_match_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(make_words(rng, n)) for n in (1, 3, 5, 6, 40, 300)] + [None, "", " "]
    texts += [texts[5] + " more", texts[5], texts[4]]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(table(spark, texts), ["doc_id"]).collect()}
    assert [got[i] for i in range(len(texts))] == [_fingerprint(t) for t in texts]


def test_near_fingerprints_match_brute_force(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(40)]
    marks = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 5))) for b in base]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in marks]
    frame = spark.createDataFrame([(m,) for m in signed + signed[:3]], "fingerprint long")
    got = {(r["query"], r["near"]): r["distance"] for r in fingerprints.near_pairs(frame, frame, 3).collect()}
    want = {(a, b): (x ^ y).bit_count() for a, x in zip(signed, marks) for b, y in zip(signed, marks) if (x ^ y).bit_count() <= 3}
    assert got == want


def test_line_dedup_keeps_first_occurrence(spark):
    rng = random.Random(10)
    line = " ".join(make_words(rng, 90))
    parts = line.split()
    parts[40] = "changed"
    texts = [f"alpha beta gamma\n{line}\nshort one", f"{line.upper()}!\ndelta epsilon zeta", " ".join(parts) + "\nshort one", None, "", "alpha, beta gamma\nalpha beta gamma"]
    gone = line_dedup.decide(table(spark, texts))
    got = {(r["doc_id"], r["line_no"]) for r in gone.collect()}
    assert {(1, 0), (5, 0), (5, 1)} <= got and not got & {(0, 0), (0, 1), (0, 2), (1, 1), (2, 1)}
    after = {r["doc_id"]: r["text"] for r in line_dedup.apply(table(spark, texts), gone).collect()}
    assert after[0] == texts[0] and after[1] == "delta epsilon zeta" and after[3] is None and after[5] == "" and after[4] == ""
    assert line_dedup.apply(odd_rows(spark), line_dedup.decide(odd_rows(spark))).count() == 9
    assert line_dedup.decide(odd_rows(spark).limit(0)).count() == 0


def test_candidates_are_all_within_radius(spark):
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(30)]
    marks = base + [b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 3))) for b in base for _ in range(3)]
    marks += marks[:9]  # classes with one fingerprint
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in marks]
    frame = spark.createDataFrame([(i.to_bytes(16, "big"), m) for i, m in enumerate(signed)], "key binary, fingerprint long")
    nothing = spark.createDataFrame([], "id binary, component binary")
    shared = line_dedup.shared_slots(frame)
    got = {tuple(int.from_bytes(k, "big") for k in r) for r in line_dedup.other_pairs(shared, frame, nothing).collect()}
    near = {(i, j) for j, y in enumerate(marks) for i, x in enumerate(marks[:j]) if (x ^ y).bit_count() <= 3}
    assert got == near
    first = {tuple(sorted(int.from_bytes(k, "big") for k in r)) for r in line_dedup.neighbour_pairs(shared, frame).collect()}
    assert first and first <= near


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_similar_lines_are_all_found(spark):
    rng = random.Random(21)
    stock = make_words(rng, 60)
    lines = []
    for n in (4, 5, 7, 10, 20, 50, 100):
        for _ in range(8):
            line = [rng.choice(stock) for _ in range(n)]
            lines.append(line)
            for edits in {1, n // 10, n // 5}:
                copy = list(line)
                for at in rng.sample(range(n), min(edits, n)):
                    copy[at] = rng.choice(["", "{} more", "other"]).format(copy[at])
                lines.append(" ".join(copy).split())
    lines += [["la"] * 5, ["la"] * 6, ["la"] * 9]
    group = list(range(len(lines)))
    for j, y in enumerate(lines):
        for i, x in enumerate(lines[:j]):
            longest = max(len(x), len(y))
            if abs(len(x) - len(y)) * 5 <= longest and 5 * word_edits(x, y) <= longest:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    gone = line_dedup.decide(table(spark, [" ".join(x) for x in lines]))
    assert {r["doc_id"]: r["group_doc"] for r in gone.collect()} == {i: g for i, g in enumerate(group) if g != i}


def test_short_and_unspaced_lines(spark, tmp_path):
    texts = ["one\nshort one\n--", "Short, one!\n--", "ONE", "\u4eca\u65e5\u306f\u5929\u6c17\u304c\u826f\u3044\u3067\u3059\u306d", "\u4eca\u65e5\u306f\u5929\u6c17\u304c\u60aa\u3044\u3067\u3059\u306d", "short two"]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["line_no"], r["group_doc"]) for r in catalogue.op7_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (4, 0, 3)}


def test_line_fingerprints_match_brute_force(spark):
    rng = random.Random(5)
    lines = [" ".join(make_words(rng, n)) for n in (3, 4, 40, 200)]
    frame = spark.createDataFrame([(i.to_bytes(16, "big"), t.split(" ")) for i, t in enumerate(lines)], "key binary, words array<string>")
    hashes = {r["w"]: r["h"] for r in frame.select(F.explode("words").alias("w")).select("w", F.xxhash64("w").alias("h")).collect()}
    for width in (16, 32):
        for r in line_dedup._fingerprints(frame, width).collect():
            words_ = lines[int.from_bytes(r["key"], "big")].split(" ")
            votes = [sum(hashes[w] >> k & 1 for w in words_) for k in range(64)]
            assert r["fingerprint"] & (1 << 64) - 1 == sum(1 << k for k in range(64) if 2 * votes[k] > len(words_))


def test_language_model_matches_brute_force(spark):
    rng = random.Random(11)
    stock = make_words(rng, 40)
    texts = [" ".join(rng.choice(stock) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", "never seen before"]
    frame = table(spark, texts)
    got = {r["doc_id"]: r for r in lm.score(frame, "doc_id % 7 != 2", mu=4.0).collect()}
    toks = {i: [*split_blank(t), None] for i, t in enumerate(texts)}
    train = [i for i in toks if i % 7 != 2]
    c = Counter(t for i in train for t in toks[i])
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for i in train for p in zip(["<", *toks[i]], toks[i]))
    before = Counter(p for i in train for p in ["<", *toks[i][:-1]])
    p_word = lambda w: (c[w] + 1) / (n + v + 1)
    for i, t in toks.items():
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"], got[i]["learnt"]) == (len(t), sum(c[x] > 0 for x in t), n, i in train)
        assert got[i]["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), rel=1e-6)
        want = sum(math.log10((pairs[(a, b)] + 4 * p_word(b)) / (before[a] + 4)) for a, b in zip(["<", *t], t))
        assert got[i]["score"] == pytest.approx(want, rel=0.02)
    assert lm.score(odd_rows(spark), "doc_id > 2").count() == 9
    assert lm.score(frame.limit(0), "true").count() == 0


def test_rare_words_keep_their_own_probability(spark):
    rng = random.Random(13)
    stock = sorted(set(make_words(rng, 300)))
    texts = [" ".join(stock[int(len(stock) * rng.random() ** 3)] for _ in range(60)) for _ in range(40)] + ["never seen before"]
    got = {r["doc_id"]: r["score"] for r in lm.score(table(spark, texts), "doc_id % 4 != 1 and doc_id < 40", mu=1e6, frequent_words=8).collect()}
    toks = {i: [*t.split(), None] for i, t in enumerate(texts)}
    c = Counter(t for i in toks if i % 4 != 1 and i < 40 for t in toks[i])
    total = sum(c.values()) + len(c) + 1
    for i, t in toks.items():
        # so large a weight leaves the single words only
        assert got[i] == pytest.approx(sum(math.log10((c[x] + 1) / total) for x in t), rel=2e-3)


def test_elias_fano_and_trie_give_back_what_they_hold():
    rng = np.random.default_rng(1)
    for universe in (10, 1_000, 1 << 50):
        values = np.sort(rng.integers(0, universe, 500)).astype(np.uint64)
        kept = lm.EliasFano.build(values, universe)
        assert (kept.values(0, 500) == values).all() and (kept.values(17, 300) == values[17:300]).all()
    context = np.sort(rng.choice(1 << 60, 50, replace=False)).astype(np.uint64)
    first = np.concatenate([[0], np.cumsum(rng.integers(1, 20, 50))])
    word = np.concatenate([np.sort(rng.choice(1 << 40, k, replace=False)) for k in np.diff(first)]).astype(np.uint64)
    log_p = -rng.random(len(word))
    trie = lm.Trie(context, word, log_p, -rng.random(50), first)
    owner = np.repeat(context, np.diff(first))
    got, weight, row = trie.look_up(owner, word)
    assert np.abs(got - log_p).max() < 0.01 and not np.isnan(weight).any() and (row >= 0).all()
    got, weight, _ = trie.look_up(owner[:1] + np.uint64(1), word[:1])
    assert np.isnan(got).all() and np.isnan(weight).all()


def test_next_by_descending_id(spark):
    rows = [(i * 3, f"t{i}") for i in range(50)]
    got = {r["doc_id"]: (r["next_id"], r["next_text"]) for r in catalogue.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (rows[k - 1][0], rows[k - 1][1]) for k, (i, _) in enumerate(rows)}


def test_pipeline_stages_agree_with_their_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns, name
        assert out.count() <= kept.count()
        kept = spark.createDataFrame(out.collect(), docs.schema)
    got = jaccard.join_groups(kept)
    assert got.where("n_shingles > 0 and doc_id != component_id").count() == 0
    index = decontaminate.build_index(kept)
    assert decontaminate.search(index, decontaminate.phrases_of(spark.read.parquet(f"{sf}/benchmark.parquet"))).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, kept, sf).count() > 0


def test_held_out_rows_follow_crc32(spark, sf):
    got = catalogue.op8_language(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
