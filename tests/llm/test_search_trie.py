"""Prefix trie, chosen-path join and ranked search against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm import make_words, odd_rows, shingles, table

from tablelab.llm import catalogue, chosen_path, jaccard, prefix_trie, search

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(convs):
    members, children, out = defaultdict(list), defaultdict(list), []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)

    def below(k):
        own = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        sums = [below(x) for x in children[k]]
        return (sum(x[0] for x in sums) or 1, own + sum(x[1] for x in sums))

    for k, own in members.items():
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(k))))
        parent = min(members[k[:-1]]) if k else None
        out.append((min(own), len(k), parent, len(own), len(children[k]), *below(k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*TRIE).collect()), key=repr)


@pytest.mark.parametrize("rows_per_task", [100_000, 3, 17])
def test_trie_matches_brute_force(spark, rows_per_task):
    rng = random.Random(rows_per_task)
    convs = {c * 7 % 1009: [(rng.choice("ab"), rng.choice(["x", "yy", "z\u20ac"])) for _ in range(rng.choice([1, 1, 2, 3, 5, 12]))] for c in range(250)}
    turns = [(c, i, role, text) for c, own in convs.items() for i, (role, text) in enumerate(own)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert rows_of(prefix_trie.build(prefix_trie.turn_rows(df), rows_per_task=rows_per_task, fan_in=3)) == trie_of(convs)


def test_trie_of_odd_rows(spark):
    turns = [
        (1, 0, "u", "a", 1), (1, None, None, "b", 1), (1, 0, "u", "a", 1), (2, None, "", "b", 1), (None, 0, "u", "a", 1),
        (5, 1, None, None, 1), (6, 0, "u", "long " * 5000, 1),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, depth int")
    a, b, none = ("u", "a"), ("", "b"), ("", "")
    want = trie_of({1: [b, a, a], 2: [b], 5: [none], 6: [("u", "long " * 5000)]})
    assert rows_of(prefix_trie.build(prefix_trie.turn_rows(df))) == want
    assert prefix_trie.build(prefix_trie.turn_rows(df.limit(0))).count() == 0
    # a conversation without turns belongs to the root only
    empty = prefix_trie.turn_rows(df).withColumn("turns", F.when(F.col("conv_id") == 2, F.slice("turns", 1, 0)).otherwise(F.col("turns")))
    want = trie_of({1: [b, a, a], 2: [], 5: [none], 6: [("u", "long " * 5000)]})
    assert rows_of(prefix_trie.build(empty)) == want


def test_ends_of_many_copies_are_joined_in_order(spark):
    df = spark.range(3000).select((F.col("id") * 37 % 3001).alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("hi").alias("text"))
    ids = sorted(i * 37 % 3001 for i in range(3000))
    got = {r["depth"]: r for r in prefix_trie.sequences(prefix_trie.turn_rows(df), ids_per_slice=64).selectExpr("1 as depth", "n", "low", "ends").collect()}
    assert got[1]["n"] == 3000 and got[1]["low"] == 0 and got[1]["ends"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def near_texts(rng):
    texts = []
    for _ in range(10):
        base = make_words(rng, rng.choice([3, 12, 60, 200]))
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(make_words(rng, 3))
            texts.append(" ".join(copy))
    shared = " ".join(make_words(rng, 40))
    return texts + [shared + " " + " ".join(make_words(rng, 60)) for _ in range(60)] + [None, "", " "]


@pytest.mark.parametrize("small", [2, 256])
def test_chosen_path_matches_brute_force(spark, small):
    texts = near_texts(random.Random(4))
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 85 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: r for r in chosen_path.join_groups(table(spark, texts), small=small, depth=5).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert [got[i]["kept"] for i in range(len(texts))] == [x == i for i, x in enumerate(label)]


def test_chosen_path_odd_rows(spark):
    got = chosen_path.join_groups(odd_rows(spark)).collect()
    by = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got)
    assert len(got) == 9 and by[(5, 2, 5, True)] == 2 and by[(6, 2, 5, False)] == 1 and by[(0, 0, 0, True)] == 1 and by[(None, 2, None, True)] == 1
    assert chosen_path.join_groups(odd_rows(spark).limit(0)).count() == 0


def test_minwise_tokens_agree_like_the_sets():
    rng = random.Random(2)
    base = make_words(rng, 400)
    other = base[:320] + make_words(rng, 80)
    h, at, _ = jaccard._sets(pa.array([" ".join(base), " ".join(other)]), 5)
    tokens = chosen_path.minwise(h, at)
    same = len(shingles(" ".join(base)) & shingles(" ".join(other))) / len(shingles(" ".join(base)) | shingles(" ".join(other)))
    assert abs((tokens[0] == tokens[1]).mean() - same) < 0.2


def ranked(docs, items, k):
    words = {d: re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", (t or "").translate(LOWER)) for d, t in docs}
    n, length = sum(bool(w) for w in words.values()), sum(map(len, words.values()))
    df = Counter(t for w in words.values() for t in set(w))
    out = []
    for item, text in items:
        terms = set(re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", (text or "").translate(LOWER)))
        scores = []
        for d, w in words.items():
            m, tf = 50 + 50 * len(w) * n // max(length, 1), Counter(w)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            scores += [(-s, d)] if s > 0 else []
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("k, terms_per_pass", [(5, 1 << 17), (7, 40)])
def test_search_matches_brute_force(spark, k, terms_per_pass):
    rng = random.Random(k)
    vocabulary = make_words(rng, 150) + ["\u00c9t\u00e9", "x1", "Z"]
    docs = [(i, "-".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 300])))) for i in range(300)] + [(500, None), (501, "x1 " * 20000)]
    docs += [(600 + i, docs[3][1]) for i in range(20)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 8, 90])))) for i in range(12)] + [(77, None), (78, "nowhere else")]
    a = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = search.search(a, spark.createDataFrame(items, "item_id long, text string"), k, terms_per_pass)
    assert sorted(tuple(r) for r in got.collect()) == ranked(docs, items, k)


def test_search_odd_rows(spark):
    items = spark.createDataFrame([(1, "alpha", "e"), (1, "beta", "e"), (None, "alpha", "e"), (2, "", "e"), (3, None, "e")], "item_id long, text string, score string")
    docs = spark.createDataFrame([(None, "alpha", 1), (4, "alpha", 1), (4, "alpha", 1), (5, "ALPHA beta", 1), (6, None, 1), (7, "gamma delta", 1)], "doc_id long, text string, rank int")
    got = search.search(docs, items, k=2).collect()
    by = sorted(((r["item_id"], r["rank"], r["doc_id"]) for r in got), key=str)
    assert by == sorted([(1, 1, 5), (1, 2, 4), (None, 1, 4), (None, 2, 4)], key=str)
    assert search.search(docs.limit(0), items).count() == 0 and search.search(docs, items.limit(0)).count() == 0


def test_new_queries_are_registered():
    assert {"op11_prefix_trie", "op12_minhash_dedup", "op13_ranked_search"} <= set(catalogue.QUERIES) & set(catalogue.ORACLES)
