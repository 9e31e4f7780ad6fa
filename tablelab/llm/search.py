"""Ranked lexical search of many items at once: documents grouped by the mask of item terms they hold.

A first scan counts documents, terms and document frequencies; a second one scores. In the second scan each task
takes its documents in blocks. A block's postings of item terms are built once; for each item the
postings set bits in one bitmap row a document (its mask of matched terms), equal masks are one group, and the
largest score that a mask can have in the block is the sum of its terms' largest parts. Masks are evaluated in
descending order of that bound until the item's k-th best score so far lies above all bounds left, so most
documents are never scored. The best k of an item are carried from block to block of a task; the tasks' lists meet
in two steps.

Integer scores (64 bits, division rounds down): N documents with a term, L their terms, n those of one document,
m = 50 + (50 * n * N) div L, w = floor(1000 * ln((2N + 2) / (2df + 1))); a document's score is the sum over the
item's terms of w * ((1000000000 * tf) div (1000 * tf + 20 * m)).

Items are searched in passes of about ``terms_per_pass`` different terms, so what is sent to the tasks is bounded
whatever the number of items.

Defined cases: null and empty texts have no terms, so such documents are never found and such items find nothing;
rows of one item_id are one item with the terms of all of them; a null item_id is an item of its own; repeated
documents are ranked each; equal scores rank by ascending doc_id, null last; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import words

BLOCK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term (hash): the different terms of each item; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", BLOCK_BYTES):
            found = words.hash_words(block.column(1), words.ALPHANUMERIC)
            yield pa.RecordBatch.from_arrays([block.column(0).take(pa.array(found.doc)), pa.array(found.hash.view(np.int64))], names=["item_id", "term"])

    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    return session.stage(rows.mapInArrow(run, f"item_id {kind}, term long").distinct(), "terms")


def _postings(block: pa.RecordBatch, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and count of the vocabulary's terms in a block, by document; and the number of terms of each text."""
    found = words.hash_words(block.column(1), words.ALPHANUMERIC)
    at = np.minimum(np.searchsorted(vocabulary, found.hash), len(vocabulary) - 1)
    known = vocabulary[at] == found.hash
    code, tf = np.unique(found.doc[known].astype(np.int64) * len(vocabulary) + at[known], return_counts=True)
    return code // len(vocabulary), code % len(vocabulary), tf.astype(np.int64), found.counts


def statistics(documents: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, their terms, and the document frequency of each term of the vocabulary, over all rows."""
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size + 2, np.int64)
        for block in words.blocks(batches, "text", BLOCK_BYTES):
            _, term, _, lengths = _postings(block, vocabulary)
            count[:size] += np.bincount(term, minlength=size)
            count[size:] += ((lengths > 0).sum(), lengths.sum())
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["at", "n"])

    got = documents.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # one row a term
    out = np.zeros(size + 2, np.int64)
    for at, n in got:
        out[at] = n
    return int(out[size]), int(out[size + 1]), out[:size]


class Best:
    """The k best (score, doc_id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """A score below this one is not among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        some = score >= self.least
        score, doc = np.concatenate([self.score, score[some]]), np.concatenate([self.doc, doc[some]])
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]


class Block:
    """Postings of a block with the part of a score that each of them adds."""

    def __init__(self, block: pa.RecordBatch, vocabulary: np.ndarray, weight: np.ndarray, n: int, length: int):
        doc, term, tf, lengths = _postings(block, vocabulary)
        m = 50 + (50 * lengths.astype(np.int64) * n) // max(length, 1)
        self.rows, self.doc, self.term = block.num_rows, doc, term
        self.ids = block.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        self.part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        self.from_doc = np.searchsorted(doc, np.arange(self.rows + 1))
        by_term = np.argsort(term, kind="stable")
        self.of_term, self.from_term = doc[by_term], np.searchsorted(term[by_term], np.arange(len(vocabulary) + 1))
        self.most = np.zeros(len(vocabulary), np.int64)
        np.maximum.at(self.most, term, self.part)

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """Bitmaps of matched terms: one row of 64-bit words for each document."""
        out = np.zeros((self.rows, -(-len(terms) // 64)), np.uint64)
        for i, t in enumerate(terms):
            out[self.of_term[self.from_term[t] : self.from_term[t + 1]], i // 64] |= np.uint64(1 << i % 64)
        return out

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Whole scores of some documents; ``wanted`` marks the item's terms."""
        n = self.from_doc[docs + 1] - self.from_doc[docs]
        at = np.repeat(self.from_doc[docs] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        part = np.where(wanted[self.term[at]], self.part[at], 0)
        totals = np.concatenate([[0], np.cumsum(part)])
        ends = np.cumsum(n)
        return totals[ends] - totals[ends - n]


def search_block(block: Block, terms: np.ndarray, wanted: np.ndarray, best: Best) -> None:
    """Add a block's best documents for one item: its masks by descending bound, until none left can enter."""
    masks = block.masks(terms)
    docs = np.flatnonzero(masks.any(1))
    if not len(docs):
        return
    order = docs[np.lexsort(masks[docs].T)]
    rows = masks[order]
    start = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1)))
    bits = np.unpackbits(rows[start].view(np.uint8), axis=1, bitorder="little")[:, : len(terms)]
    bound = bits.astype(np.int64) @ block.most[terms]
    size = np.diff(np.append(start, len(order)))
    turn = np.argsort(-bound, kind="stable")
    turn = turn[bound[turn] >= best.least]
    at, chunk = 0, best.k
    while at < len(turn) and bound[turn[at]] >= best.least:
        to = at + 1 + int(np.searchsorted(np.cumsum(size[turn[at:]]), chunk))
        group = turn[at:to]
        n = size[group]
        asked = order[np.repeat(start[group] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        best.add(block.scores(asked, wanted), block.ids[asked])
        at, chunk = to, 2 * chunk


def _search_pass(documents: DataFrame, items: list[np.ndarray], k: int) -> DataFrame:
    """item (position in ``items``), doc_id, score: the k best documents of each item in each task."""
    vocabulary = np.unique(np.concatenate(items))
    n, length, df = statistics(documents, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    places = [np.searchsorted(vocabulary, t) for t in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        wanted = np.zeros(len(vocabulary), bool)
        for part in words.blocks(batches, "text", BLOCK_BYTES):
            block = Block(part, vocabulary, weight, n, length)
            for terms, own in zip(places, best):
                wanted[terms] = True
                search_block(block, terms, wanted, own)
                wanted[terms] = False
        task = TaskContext.get().partitionId()
        for some in batched(enumerate(best), 256):
            item = np.repeat([i for i, _ in some], [len(b.doc) for _, b in some]).astype(np.int64)
            doc, score = (np.concatenate([getattr(b, c) for _, b in some]) for c in ("doc", "score"))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=doc == NO_ID), pa.array(score), pa.array(np.full(len(doc), task, np.int64))], names=["item", "doc_id", "score", "task"])

    return documents.mapInArrow(run, "item long, doc_id long, score long, task long")


def search(documents: DataFrame, items: DataFrame, k: int = 50, terms_per_pass: int = 1 << 17) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 of each item."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    terms = item_terms(items)
    passes = 1 + terms.count() // terms_per_pass
    found = []
    for i in range(passes):
        # one row for each item of the pass, and about terms_per_pass terms in all
        own = terms.where(F.pmod(F.xxhash64("item_id", F.lit(5)), F.lit(passes)) == i).groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if not own:
            continue
        lists = [np.unique(np.array(r["terms"], np.int64).view(np.uint64)) for r in own]
        names = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(own)], f"item long, item_id {dict(terms.dtypes)['item_id']}")
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        part = _search_pass(rows, lists, k).withColumn("part", F.pmod("task", F.lit(64)))
        for keys in (["item", "part"], ["item"]):
            part = part.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        found.append(part.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return terms.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
