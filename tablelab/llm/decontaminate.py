"""Benchmark passages in training texts, by a positional inverted index.

``build_index`` stores the postings of every training token: for each block of whole texts the sorted terms,
and the positions of each. ``search`` looks phrases up in every block: it starts from the phrase's rarest term
(rarest over all blocks), intersects offset-adjusted position lists term by term, and keeps the positions where
all terms stand at their offsets (``slop=0``) or within ``slop`` words of them (proximity matches). The index is
split by documents, so a search shuffles only its matches, and a passage in a third of all texts is spread over
all blocks. Phrases are sent to the blocks in portions of at most ``portion`` phrases, whatever the size of the
benchmark.

Defined cases: null and empty texts have no words and no hits; items without words never occur; items of fewer
words than a window are one window; an item that repeats another's window is reported with it; repeated
documents are told apart by their place in the index; rows with a null id are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import words

GAP = 64  # free positions between texts, more than a phrase and its slop
_INDEX = "block long, ids array<long>, n_words array<long>, base array<long>, terms binary, starts binary, positions binary"


def build_index(documents: DataFrame, block_bytes: int = 3 << 20) -> DataFrame:
    """Stored postings of all words of ``documents`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        part, no = TaskContext.get().partitionId(), 0
        for block in words.blocks(batches, "text", block_bytes):
            found = words.hash_words(block.column(1), words.ALPHANUMERIC)
            base = found.first[:-1] + GAP * np.arange(1, block.num_rows + 1)
            position = (np.arange(len(found.hash)) + GAP * (found.doc.astype(np.int64) + 1)).astype(np.uint32)
            order = np.argsort(found.hash, kind="stable")
            terms, starts = np.unique(found.hash[order], return_index=True)
            row = [part << 32 | no], [block.column(0).to_pylist()], [found.counts.tolist()], [base.tolist()]
            blobs = [[terms.tobytes()], [starts.astype(np.uint32).tobytes()], [position[order].tobytes()]]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in row[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), *lists, *[pa.array(x, pa.binary()) for x in blobs]], names=["block", "ids", "n_words", "base", "terms", "starts", "positions"])
            no += 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return session.stage(rows.mapInArrow(run, _INDEX), "postings")


def phrases_of(items: DataFrame, size: int = 10) -> DataFrame:
    """Distinct runs of ``size`` words of the items: phrase (array of term hashes), item_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", 1 << 20):
            found = words.hash_words(block.column(1), words.ALPHANUMERIC)
            ids, out_ids, out = block.column(0).to_pylist(), [], []
            for d, item in enumerate(ids):
                w = found.hash[found.first[d] : found.first[d + 1]].view(np.int64)
                for i in range(max(1, len(w) - size + 1) if len(w) else 0):
                    out_ids.append(item), out.append(w[i : i + size])
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, pa.string()), pa.array(out, pa.list_(pa.int64()))], names=["item_id", "phrase"])

    rows = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    found = rows.mapInArrow(run, "item_id string, phrase array<long>")
    return found.groupBy("phrase").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


class _Block:
    """Postings of one block: where a term stands, and whether it stands near a position."""

    def __init__(self, terms: bytes, starts: bytes, positions: bytes):
        self.terms = np.frombuffer(terms, np.uint64)
        self.positions = np.frombuffer(positions, np.uint32)
        self.bounds = np.append(np.frombuffer(starts, np.uint32).astype(np.int64), len(self.positions))

    def rows_of(self, wanted: np.ndarray) -> np.ndarray:
        """Row of each wanted term, -1 where the block has none."""
        if not len(self.terms):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[at] == wanted, at, -1)

    def sorted_keys(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Postings of some rows as one ascending list: (index into rows) << 32 | position. And the list bounds."""
        size = self.bounds[rows + 1] - self.bounds[rows]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - self.bounds[rows], size)
        return (np.repeat(np.arange(len(rows), dtype=np.int64), size) << 32) | self.positions[at].astype(np.int64), ends


def _match(block: _Block, grid: np.ndarray, size: np.ndarray, weight: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases found in a block and their first positions. ``grid`` has a row of term numbers for each phrase."""
    vocabulary, grid = grid
    row = block.rows_of(vocabulary)
    here = np.flatnonzero(row >= 0)
    local = np.full(len(vocabulary) + 1, -1)
    local[here] = np.arange(len(here))
    keys, ends = block.sorted_keys(row[here])
    known = local[grid]  # phrases x offsets, -1: absent, or beyond a short phrase
    inside = np.arange(grid.shape[1]) < size[:, None]
    alive = np.flatnonzero(((known >= 0) | ~inside).all(1))
    if not len(alive) or not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rarity = np.where(inside[alive], weight[grid[alive]], np.inf)
    turn = np.argsort(rarity, axis=1, kind="stable")
    found_p, found_s = [], []
    lists = known[alive, turn[:, 0]]
    length = ends[lists + 1] - ends[lists]
    cuts = np.searchsorted(np.cumsum(length), np.arange(0, length.sum() + 1, 1 << 20))
    for lo, hi in zip(cuts, [*cuts[1:], len(alive)]):  # bounded portions of candidates
        part = slice(lo, hi)
        n = length[part]
        if not n.sum():
            continue
        who = np.repeat(np.arange(lo, hi), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - ends[lists[part]], n)
        start = (keys[at] & 0xFFFFFFFF) - turn[who, 0]
        for k in range(1, grid.shape[1]):
            offset = turn[who, k]
            needed = inside[alive[who], offset]
            want = (known[alive[who], offset] << 32) + start + offset
            i = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
            ok = ~needed | ((keys[i] >= want - slop) & (keys[i] <= want + slop))
            who, start = who[ok], start[ok]
        found_p.append(alive[who]), found_s.append(start)
    return (np.concatenate(found_p), np.concatenate(found_s)) if found_p else (np.zeros(0, np.int64),) * 2


def _portions(phrases: DataFrame, portion: int) -> Iterator[pd.DataFrame]:
    """Phrases in portions of a bounded number of rows."""
    n = phrases.count()
    parts = -(-n // portion)
    numbered = phrases.withColumn("portion", F.pmod(F.xxhash64("phrase"), F.lit(max(parts, 1) * 2 if parts > 1 else 1)))
    for i in range(max(parts, 1) * 2 if parts > 1 else parts):
        yield numbered.where(F.col("portion") == i).select("phrase", "item_ids").toPandas()


def search(index: DataFrame, phrases: DataFrame, slop: int = 0, portion: int = 100_000) -> DataFrame:
    """Matches of phrases: block, place (of the text in it), doc_id, item_ids, starts, lengths of the hit runs."""
    if not 0 <= slop < GAP // 4:
        raise ValueError(f"slop must be from 0 to {GAP // 4 - 1}")
    schema = "block long, place int, doc_id long, item_ids array<string>, starts array<long>, lengths array<long>"
    found = None
    for held in _portions(phrases, portion):
        if not len(held):
            continue
        size = np.array([len(p) for p in held["phrase"]])
        vocabulary, flat = np.unique(np.concatenate(held["phrase"].to_list()).astype(np.int64).view(np.uint64), return_inverse=True)
        grid = np.full((len(held), size.max()), len(vocabulary))
        grid[np.arange(size.max()) < size[:, None]] = flat
        items = [list(x) for x in held["item_ids"]]

        def count(batches, vocabulary=vocabulary):
            total = np.zeros(len(vocabulary), np.int64)
            for batch in batches:
                for r in batch.to_pylist():
                    b = _Block(r["terms"], r["starts"], b"")
                    row = b.rows_of(vocabulary)
                    bounds = np.append(b.bounds[:-1], r["n"])
                    total += np.where(row >= 0, bounds[row + 1] - bounds[row], 0)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["term", "n"])

        sizes = index.select("terms", "starts", (F.octet_length("positions") / 4).cast("long").alias("n"))
        counts = sizes.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
        weight = np.zeros(len(vocabulary) + 1)
        weight[counts["term"].to_numpy(dtype=np.int64)] = counts["n"].to_numpy(dtype=float)

        def look(batches, vocabulary=vocabulary, grid=grid, size=size, weight=weight, items=items):
            for batch in batches:
                for r in batch.to_pylist():
                    block = _Block(r["terms"], r["starts"], r["positions"])
                    phrase, start = _match(block, (vocabulary, grid), size, weight, slop)
                    if not len(phrase):
                        continue
                    base = np.array(r["base"])
                    place = np.searchsorted(base, start + slop, side="right") - 1
                    order = np.lexsort((start, place))
                    phrase, start, place = phrase[order], start[order], place[order]
                    docs, first = np.unique(place, return_index=True)
                    out = []
                    for d, i, j in zip(docs, first, [*first[1:], len(place)]):
                        own = sorted({x for p in set(phrase[i:j].tolist()) for x in items[p]})
                        out.append((r["block"], int(d), r["ids"][d], own, (start[i:j] - base[d]).tolist(), size[phrase[i:j]].tolist()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*out)), [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())])], names=["block", "place", "doc_id", "item_ids", "starts", "lengths"])

        part = index.mapInArrow(look, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else index.sparkSession.createDataFrame([], schema)


def summarise(index: DataFrame, matches: DataFrame) -> DataFrame:
    """One row for each indexed text: doc_id, n_words, n_hit (words inside any match), item_ids (sorted)."""
    spans = F.transform(F.sequence(F.lit(0), F.size("starts") - 1), lambda i: F.struct(F.get("starts", i).alias("s"), (F.get("starts", i) + F.get("lengths", i)).alias("e")))
    merged = matches.groupBy("block", "place").agg(
        F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(s["s"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["e"]).alias("end"))
    merged = merged.select("block", "place", F.aggregate("spans", zero, step)["n"].alias("n_hit"), "item_ids")
    texts = index.select("block", F.posexplode(F.arrays_zip("ids", "n_words")).alias("place", "t")).select("block", "place", F.col("t.ids").alias("doc_id"), F.col("t.n_words").alias("n_words"))
    return texts.join(merged, ["block", "place"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")
    )
