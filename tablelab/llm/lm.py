"""Language model in Elias-Fano n-gram tries: trained and queried shard by shard.

Model: p(w|v) = (c(vw) + mu * p(w)) / (c(v) + mu), v the word before (or the text's begin), and p(w) the share of
w with one added to each count; words never seen in training have 1 as their count. Words of at least 2^-18 of all
training tokens are at most 2^18, whatever the corpus, and are sent to all tasks (nothing else is). The counts of
all rarer words go by a shuffle to the shards that hold a pair with them.

Word pairs of all texts are cut by their context into shards; contexts that are too frequent for one shard are
cut again by their next word. Each shard counts the pairs of training texts and stores them as a trie: sorted
contexts, Elias-Fano pointers to their successors, Elias-Fano successors relative to their context, quantised
log-probabilities and context weights, packed in one memory-mapped file. All pairs of the shard are then looked
up in it, and sums for each text go back to the block of texts they come from. What is gathered grows with the
input, and nothing else but pairs and counts is shuffled.

Defined cases: null and empty texts have one token, the end; with no training texts every word is unknown;
repeated rows are scored one by one; rows with a null id are held out.
"""

from __future__ import annotations

import math
import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import words

BEGIN, END = np.uint64(0x6265676965EF1D37), np.uint64(0x656E6430C3B1A7F5)
LOW40 = np.uint64((1 << 40) - 1)
U64 = np.uint64


class EliasFano:
    """A monotone sequence below ``universe`` in about 2 + log2(universe / n) bits for each value."""

    def __init__(self, high: np.ndarray, low: np.ndarray, n: int, width: int):
        self.high, self.low, self.n, self.width = high, low, n, width

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        width = max(0, (int(universe) // max(n, 1)).bit_length() - 1)
        values = values.astype(U64)
        bits = np.zeros(n + (int(universe) >> width) + 1, np.uint8)
        bits[(values >> U64(width)).astype(np.int64) + np.arange(n)] = 1
        return cls(np.packbits(bits), cls._pack(values & U64((1 << width) - 1), width), n, width)

    @staticmethod
    def _pack(values: np.ndarray, width: int) -> np.ndarray:
        if not width:
            return np.zeros(0, np.uint8)
        out = [np.packbits(((values[i : i + (1 << 16), None] >> np.arange(width, dtype=U64)) & U64(1)).astype(np.uint8)) for i in range(0, len(values), 1 << 16)]
        return np.concatenate(out) if out else np.zeros(0, np.uint8)

    def values(self, a: int, b: int, ones: np.ndarray | None = None) -> np.ndarray:
        """Values a to b (b excluded); ``ones``: positions of all set high bits."""
        ones = self.ones() if ones is None else ones
        high = (ones[a:b] - np.arange(a, b)).astype(U64) << U64(self.width)
        if not self.width or a == b:
            return high
        lo, hi = a * self.width, b * self.width
        bits = np.unpackbits(self.low[lo // 8 : -(-hi // 8)])[lo % 8 : lo % 8 + hi - lo].reshape(b - a, self.width)
        out = high
        for k in range(self.width):
            out |= bits[:, k].astype(U64) << U64(k)
        return out

    def ones(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.high))[: self.n]


class Trie:
    """Contexts, successors and quantised probabilities of one shard in a memory-mapped file."""

    RANGE = 1 << 40

    def __init__(self, context: np.ndarray, word: np.ndarray, log_p: np.ndarray, log_weight: np.ndarray, first: np.ndarray):
        """``word`` is sorted within each context; ``first[i]`` is where context i's successors begin."""
        self.n, self.contexts = len(word), len(context)
        pointers = EliasFano.build(first, self.n + 1)
        owner = np.repeat(np.arange(self.contexts, dtype=U64), np.diff(first))
        # successors relative to their context: high part the context's number, low part the word
        successors = EliasFano.build((owner << U64(40)) | word, max(self.contexts, 1) << 40)
        self._codes, book = self._quantise(log_p)
        codes_w, book_w = self._quantise(log_weight)
        arrays = [context.astype(U64), pointers.high, pointers.low, successors.high, successors.low, self._codes, book, codes_w, book_w]
        with tempfile.TemporaryFile() as f:  # has no name, so nothing stays behind
            at = []
            for a in arrays:
                at.append(f.tell())
                f.write(a.tobytes())
                f.write(b"\0" * (-f.tell() % 8))
            f.write(b"\0" * 8)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        got = [np.frombuffer(self._map, a.dtype, len(a), p) for a, p in zip(arrays, at)]
        self.context, self._codes, self._book, self._codes_w, self._book_w = got[0], *got[5:9]
        self._pointers = EliasFano(got[1], got[2], pointers.n, pointers.width)
        self._successors = EliasFano(got[3], got[4], successors.n, successors.width)

    @staticmethod
    def _quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of 16 bits into a book of means of equally filled bins."""
        if not len(x):
            return np.zeros(0, np.uint16), np.zeros(1)
        cuts = np.unique(np.quantile(x, np.linspace(0, 1, 4097)))
        codes = np.minimum(np.searchsorted(cuts, x, side="right") - 1, max(len(cuts) - 2, 0)).astype(np.uint16)
        n = np.bincount(codes)
        return codes, np.bincount(codes, x) / np.maximum(n, 1)

    def look_up(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted queries: log-probability (nan: pair unseen), context weight (nan: context unseen), row of context."""
        log_p, weight = np.full(len(context), np.nan), np.full(len(context), np.nan)
        if not self.contexts:
            return log_p, weight, np.full(len(context), -1)
        at = np.minimum(np.searchsorted(self.context, context), self.contexts - 1)
        known = self.context[at] == context
        weight[known] = self._book_w[self._codes_w[at[known]]]
        first = self._pointers.values(0, self.contexts + 1).astype(np.int64)
        ones, q = self._successors.ones(), np.flatnonzero(known)
        wanted = (at[q].astype(U64) << U64(40)) | word[q]
        for a in range(0, self.contexts, 1 << 17):  # a range of contexts at a time
            b = min(a + (1 << 17), self.contexts)
            i, j = np.searchsorted(at[q], [a, b])
            if i == j:
                continue
            for lo in range(int(first[a]), int(first[b]), 1 << 20):
                hi = min(lo + (1 << 20), int(first[b]))
                level = self._successors.values(lo, hi, ones)
                k, m = np.searchsorted(wanted[i:j], [level[0], level[-1]]) + i
                m = int(np.searchsorted(wanted[i:j], level[-1], side="right")) + i
                spot = np.minimum(np.searchsorted(level, wanted[k:m]), len(level) - 1)
                hit = level[spot] == wanted[k:m]
                log_p[q[k:m][hit]] = self._book[self._codes[lo + spot[hit]]]
        return log_p, weight, np.where(known, at, -1)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (word before, word, index of the text) of each token, and the number of tokens of each text."""
    found = words.hash_words(texts, words.BLANK_SEPARATED)
    n = found.counts + 1
    ends = np.cumsum(n) - 1
    doc = np.repeat(np.arange(len(n), dtype=np.uint16), n)
    word = np.empty(n.sum(), U64)
    inside = np.ones(len(word), bool)
    inside[ends] = False
    word[inside], word[ends] = found.hash, END
    before = np.empty_like(word)
    before[1:], before[ends[:-1] + 1] = word[:-1], BEGIN
    if len(before):
        before[0] = BEGIN
    return before, word, doc, n


def _blocks(batches, size: int):
    for block in words.blocks(batches, "text", size):
        for at in range(0, block.num_rows, 60_000):
            yield block.slice(at, 60_000)


def count_words(documents: DataFrame, learn: str, size: int = 8 << 20) -> DataFrame:
    """h (hash of a word, or the end), c: occurrences in the texts where ``learn`` holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, size):
            _, word, _, _ = _tokens(block.column(0))
            h, c = np.unique(word, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c, pa.int64())], names=["h", "c"])

    rows = documents.where(learn).select(F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def score(documents: DataFrame, learn: str, mu: float = 4.0, tokens_per_shard: int = 1_500_000, block_bytes: int = 4 << 20, frequent_words: int = 1 << 18) -> DataFrame:
    """Train on rows where ``learn`` (SQL on the columns of ``documents``) holds and score all rows.

    Returns doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score, one row for each input row.
    """
    spark = documents.sparkSession
    counted = session.stage(count_words(documents, learn), "wordcounts")
    n_all, v_all = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the least share of a frequent word bounds the number of them
    least = F.lit(n_all / frequent_words)
    frequent = counted.where(F.col("c") >= least).toPandas().sort_values("h")
    freq_h = frequent["h"].to_numpy(np.int64).view(U64)
    order = np.argsort(freq_h)
    freq_h, freq_c = freq_h[order], frequent["c"].to_numpy(np.int64)[order]
    ends = int(freq_c[freq_h == END].sum()) if len(freq_h) else 0
    if n_all and not ends:
        ends = int(counted.where(F.col("h") == int(np.array([END]).view(np.int64)[0])).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.expr(learn), F.lit(False)).alias("learnt"), F.coalesce("text", F.lit("")).alias("text"))
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(wanted, math.ceil(n_all / tokens_per_shard))
    common = {"h": freq_h, "c": freq_c, "n": int(n_all), "v": int(v_all), "ends": ends, "shards": shards, "mu": mu}
    common["h40"] = np.sort(freq_h & LOW40)
    common["p40"] = ((freq_c + 1) / (n_all + v_all + 1))[np.argsort(freq_h & LOW40)]
    pairs = rows.mapInArrow(_cut(common, block_bytes), "shard int, block long, payload binary")
    asked = rows.select("text").mapInArrow(_ask(common, block_bytes), "home int, payload binary")
    short = F.col("h").bitwiseAND(F.lit((1 << 40) - 1))
    held = counted.where(F.col("c") < least).select(F.pmod(short, F.lit(shards)).cast("int").alias("home"), short.alias("h40"), "c")
    counts = asked.repartition(shards, "home").groupBy("home").cogroup(held.repartition(shards, "home").groupBy("home")).applyInPandas(_answer, "shard int, payload binary")
    sums = pairs.repartition(shards, "shard").groupBy("shard").cogroup(counts.repartition(shards, "shard").groupBy("shard")).applyInPandas(_shard(common), "block long, kind int, payload binary")
    return sums.groupBy("block").applyInPandas(_total(common), "doc_id long, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _count_of(common: dict, h: np.ndarray) -> np.ndarray:
    """Training count of frequent words, 0 for all others; the begin counts once for each training text."""
    if not len(common["h"]):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(common["h"], h), len(common["h"]) - 1)
    return np.where(h == BEGIN, common["ends"], np.where(common["h"][at] == h, common["c"][at], 0))


def _shard_of(common: dict, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Shard of each pair: that of its context, cut again by the next word if the context is too frequent."""
    share = max(common["n"] / common["shards"] / 8, 1.0)
    pieces = np.ceil(_count_of(common, before) / share).astype(U64)
    salt = np.where(pieces > U64(1), words.mix(word) % np.maximum(pieces, U64(1)), U64(0))
    return (words.mix(before + salt * U64(0x9E3779B97F4A7C15)) >> U64(8)) % U64(common["shards"])


def _runs(sorted_: np.ndarray):
    """(value, begin, end) of each run of equal values."""
    names, first = np.unique(sorted_, return_index=True)
    return zip(names, first, [*first[1:], len(sorted_)])


def _ask(common: dict, block_bytes: int):
    """Rare words of each block and the shards that need their counts, by the home of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_bytes):
            before, word, _, _ = _tokens(block.column(0))
            rare = ~np.isin(word & LOW40, common["h40"])
            shard, short = _shard_of(common, before[rare], word[rare]), word[rare] & LOW40
            home = short % U64(common["shards"])
            order = np.lexsort((shard, short, home))
            shard, short, home = shard[order], short[order], home[order]
            new = np.ones(len(short), bool)
            new[1:] = (short[1:] != short[:-1]) | (shard[1:] != shard[:-1])
            shard, short, home = shard[new], short[new], home[new]
            out = [(int(k), short[i:j].tobytes() + shard[i:j].astype(np.uint32).tobytes()) for k, i, j in _runs(home)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.binary()])], names=["home", "payload"])

    return run


def _read_counts(blobs, kind) -> tuple[np.ndarray, np.ndarray]:
    """Words and what is stored with each (``kind`` of 4 bytes) of payloads."""
    found = [(np.frombuffer(x, U64, len(x) // 12), np.frombuffer(x, kind, len(x) // 12, len(x) // 12 * 8)) for x in blobs]
    if not found:
        return np.zeros(0, U64), np.zeros(0, kind)
    return tuple(np.concatenate(x) for x in zip(*found))


def _answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Training counts of the rare words that were asked for, by shard; words never seen are left out."""
    short, shard = _read_counts(asked["payload"], np.uint32)
    names, index = np.unique(held["h40"].to_numpy(np.int64).view(U64), return_inverse=True)
    if not len(names) or not len(short):
        return pd.DataFrame({"shard": np.zeros(0, np.int32), "payload": np.zeros(0, object)})
    c = np.bincount(index, held["c"].to_numpy(np.int64)).astype(np.uint32)
    at = np.minimum(np.searchsorted(names, short), len(names) - 1)
    seen = names[at] == short
    short, shard, c = short[seen], shard[seen], c[at[seen]]
    order = np.lexsort((short, shard))
    short, shard, c = short[order], shard[order], c[order]
    new = np.ones(len(short), bool)
    new[1:] = (short[1:] != short[:-1]) | (shard[1:] != shard[:-1])
    short, shard, c = short[new], shard[new], c[new]
    out = [(int(k), short[i:j].tobytes() + c[i:j].tobytes()) for k, i, j in _runs(shard)]
    return pd.DataFrame({"shard": np.array([k for k, _ in out], np.int32), "payload": [x for _, x in out]})


def _cut(common: dict, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        for block in _blocks(batches, block_bytes):
            key = part << 32 | no
            no += 1
            before, word, doc, n = _tokens(block.column(2))
            learnt = np.array(block.column(1).to_pylist(), bool)
            shard = _shard_of(common, before, word)
            short = word & LOW40
            order = np.lexsort((short, before, shard))
            before, short, doc, shard = before[order], short[order], doc[order], shard[order]
            names, first = np.unique(shard, return_index=True)
            out = []
            for s, i, j in zip(names, first, [*first[1:], len(shard)]):
                b, m = np.unique(before[i:j], return_counts=True)
                w = np.ascontiguousarray(short[i:j]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                blob = [np.array([len(b), j - i], np.int64).tobytes(), b.tobytes(), m.astype(np.uint32).tobytes(), doc[i:j].tobytes(), w, np.packbits(learnt[doc[i:j]]).tobytes()]
                out.append((int(s), key, b"".join(blob)))
            ids = block.column(0)
            meta = np.stack([ids.fill_null(0).to_numpy(zero_copy_only=False), np.array([x is not None for x in ids.to_pylist()], np.int64), learnt.astype(np.int64), n.astype(np.int64)])
            out.append((-1 - key % common["shards"], key, meta.astype(np.int64).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), pa.int64(), pa.binary()])], names=["shard", "block", "payload"])

    return run


def _read(blob: bytes):
    contexts, n = np.frombuffer(blob, np.int64, 2)
    at = 16
    b = np.frombuffer(blob, U64, contexts, at)
    m = np.frombuffer(blob, np.uint32, contexts, at := at + 8 * contexts)
    doc = np.frombuffer(blob, np.uint16, n, at := at + 4 * contexts)
    raw = np.frombuffer(blob, np.uint8, 5 * n, at := at + 2 * n).reshape(n, 5)
    word = np.zeros((n, 8), np.uint8)
    word[:, :5] = raw
    learnt = np.unpackbits(np.frombuffer(blob, np.uint8, -1, at + 5 * n))[:n].astype(bool)
    return np.repeat(b, m), word.view(U64).reshape(n), doc, learnt


def _shard(common: dict):
    def run(frame: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if not len(frame) or frame["shard"].iloc[0] < 0:
            return pd.DataFrame({"block": frame["block"], "kind": 0, "payload": frame["payload"]})
        parts = [_read(x) for x in frame["payload"]]
        context, word, learnt = (np.concatenate([p[k] for p in parts]) for k in (0, 1, 3))
        begins = context == BEGIN
        order = np.lexsort((word, context))
        c, w, t = context[order], word[order], learnt[order]
        del context, word, learnt
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1])
        pair = np.cumsum(new) - 1
        uc, uw = c[new], w[new]
        del c, w, new
        n = np.bincount(pair, t)  # training occurrences of each pair
        starts = np.flatnonzero(np.append(True, uc[1:] != uc[:-1])) if len(uc) else np.zeros(0, np.int64)
        own = np.add.reduceat(n, starts) if len(starts) else np.zeros(0)
        table = _count_of(common, uc[starts])
        total = np.where(table > 0, table, own)  # frequent contexts may lie in several shards
        group = np.cumsum(np.append(True, uc[1:] != uc[:-1])) - 1
        p_word = _word_share(common, uw, *_read_counts(counts["payload"], np.uint32))
        log_p = np.log10((n + common["mu"] * p_word) / (total[group] + common["mu"]))
        kept = n > 0
        counts = np.bincount(group, kept, len(starts)).astype(np.int64)
        some = counts > 0
        weights = np.log10(common["mu"] / (total + common["mu"]))
        trie = Trie(uc[starts][some], uw[kept], log_p[kept], weights[some], np.concatenate([[0], np.cumsum(counts[some])]))
        log_seen, log_weight, _ = trie.look_up(uc, uw)
        # a context that was never followed by anything in training leaves its next word to the single words
        rest = np.where(np.isnan(log_weight), weights[group], log_weight) + np.log10(p_word)
        answer = np.empty(len(order))
        answer[order] = np.where(np.isnan(log_seen), rest, log_seen)[pair]
        count = np.empty(len(order))
        count[order] = total[group][pair]
        base = np.where(begins, 0.0, np.log10(count + 1))
        known = (count > 0) & ~begins
        out, at = [], 0
        for p in parts:
            doc, to = p[2], at + len(p[2])
            docs, index = np.unique(doc, return_inverse=True)
            blob = [np.array([len(docs)], np.int64).tobytes(), *[np.bincount(index, x[at:to]).astype(t).tobytes() for x, t in ((answer, np.float32), (base, np.float32), (known, np.int32))], docs.astype(np.uint16).tobytes()]
            out.append(b"".join(blob))
            at = to
        return pd.DataFrame({"block": frame["block"], "kind": 1, "payload": out})

    return run


def _word_share(common: dict, short: np.ndarray, rare: np.ndarray, rare_c: np.ndarray) -> np.ndarray:
    """Smoothed share of each word; ``rare``, ``rare_c``: words of the shard that are not in the list, and their counts."""
    total = common["n"] + common["v"] + 1
    out = np.full(len(short), 1 / total)
    order = np.argsort(rare)
    for names, p in ((rare[order], (rare_c[order].astype(float) + 1) / total), (common["h40"], common["p40"])):
        if len(names):
            at = np.minimum(np.searchsorted(names, short), len(names) - 1)
            out = np.where(names[at] == short, p[at], out)
    return out


def _total(common: dict):
    n_all, v_all = common["n"], common["v"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        meta = np.frombuffer(frame.loc[frame["kind"] == 0, "payload"].iloc[0], np.int64).reshape(4, -1)
        docs = meta.shape[1]
        score, base, known = np.zeros(docs), np.zeros(docs), np.zeros(docs)
        for blob in frame.loc[frame["kind"] == 1, "payload"]:
            k = int(np.frombuffer(blob, np.int64, 1)[0])
            doc = np.frombuffer(blob, np.uint16, k, 8 + 12 * k)
            score[doc] += np.frombuffer(blob, np.float32, k, 8)
            base[doc] += np.frombuffer(blob, np.float32, k, 8 + 4 * k)
            known[doc] += np.frombuffer(blob, np.int32, k, 8 + 8 * k)
        base += math.log10(common["ends"] + 1) - meta[3] * math.log10(n_all + v_all + 1)
        known += common["ends"] > 0
        ids = pd.array(meta[0], dtype="Int64")
        ids[meta[1] == 0] = pd.NA
        return pd.DataFrame({"doc_id": ids, "learnt": meta[2].astype(bool), "n_tokens": meta[3], "n_known": known.astype(np.int64), "train_tokens": n_all, "base_score": base, "score": score})

    return run
