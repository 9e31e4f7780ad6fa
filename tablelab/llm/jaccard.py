"""Documents whose sets of word n-grams are alike, by a blocked sparse product of the incidence matrix.

A document's set is the set of its distinct word n-grams (hashed to 64 bits). Equal sets are one vertex from the
start. Sizes bound what a link needs: for a set of n n-grams and threshold t a partner shares at least
ceil(t * n) of them, so any two linked sets share l n-grams among the first n - ceil(t * n) + l of each, in
whatever common order. With l = ceil(n / 5):

1. Each text gives that many n-grams of smallest hash; counted over all texts, n-grams of one set only are
   dropped, and so are sets with fewer than l others left: they cannot have a link.
2. Of the rest, all but the l - 1 most frequent n-grams are the non-zeros of the matrix.
3. In every column the most typical set (the one with the highest counts) is a centre; overlaps with centres
   are accumulated over the columns, and each set is verified against the centre of its largest overlap. This
   ties groups of copies together by few pairs.
4. All pairs of a column that step 3 has not put into one component are compared in blocks (``groups.tie``): the
   symmetric difference of two sets is at least the number of differing bits of their parity bitmaps, which
   discards nearly all pairs below the bound; the others are verified on the whole sets.
5. Components of all verified links.

The counts of step 1 hold a bucket of columns in one task; from step 3 on long columns are cut into blocks, and the
rows of a column's largest component are only compared with the others.

Defined cases: null texts and texts without words are empty sets, linked with nothing; repeated rows and
documents with one id are rows of their own; a null id is never the id of a component unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import groups, words
from tablelab.llm.components import components

U64 = np.uint64
BLOCK_BYTES = 4 << 20


class Bounds:
    """What sizes tell about links at a threshold of ``percent``."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("the threshold must be from 50 to 100 percent")
        self.percent = percent

    def least_shared(self, n):
        return -(-self.percent * n // 100)

    def common(self, n):
        return -(-n // 5)

    def first(self, n):
        return np.minimum(n, n - self.least_shared(n) + self.common(n))

    def common_with_any(self, n):
        return self.common(self.least_shared(n))

    def most_different(self, n, m):
        return (100 - self.percent) * (n + m) // (100 + self.percent)

    def linked(self, shared, n, m):
        return 100 * shared >= self.percent * (n + m - shared)


def _sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of all texts, their bounds, and a signature of each set (0: empty)."""
    h, doc = words.windows(words.hash_words(texts, words.BLANK_SEPARATED), size)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    totals = np.concatenate([np.zeros(1, U64), np.cumsum(words.mix(h + U64(1)))])
    signature = words.mix(totals[at[1:]] - totals[at[:-1]] + np.diff(at).astype(U64))
    signature[np.diff(at) == 0] = 0
    return h, at, signature


def _firsts(at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices of the first ``count`` members of each set."""
    return np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def sizes(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, sig (vertex of the set, null if it is empty) of each row; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", BLOCK_BYTES):
            _, at, sig = _sets(block.column(1), size)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(np.diff(at), pa.int64()), pa.array(sig.view(np.int64), mask=sig == 0)], names=["doc_id", "n_shingles", "sig"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return session.stage(rows.mapInArrow(run, "doc_id long, n_shingles long, sig long"), "sizes")


def candidates(documents: DataFrame, size: int, bounds: Bounds, buckets: int) -> DataFrame:
    """Steps 1 and 2: sig, n, grams (array of h, df, by df) of sets that can have a link; stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", BLOCK_BYTES):
            for start in range(0, block.num_rows, 60_000):
                h, at, sig = _sets(block.column(0).slice(start, 60_000), size)
                n = np.diff(at)
                _, first = np.unique(sig, return_index=True)  # copies in the block count once
                once = np.zeros(len(n), bool)
                once[first] = True
                take = np.where(once & (n > 0), bounds.first(n), 0)
                # six bytes are enough to find candidates; links are verified on whole hashes
                grams, owner = h[_firsts(at, take)] >> U64(16), np.repeat(np.arange(len(n), dtype=np.uint16), take)
                bucket = ((grams ^ (grams >> U64(29))) % U64(buckets)).astype(np.int32)
                order = np.lexsort((grams, bucket))
                grams, owner, bucket = grams[order], owner[order], bucket[order]
                names, i = np.unique(bucket, return_index=True)
                out = []
                for a, b in zip(i, [*i[1:], len(bucket)]):
                    used, local = np.unique(owner[a:b], return_inverse=True)
                    head = np.array([len(used), b - a], np.int64).tobytes()
                    cut6 = np.ascontiguousarray(grams[a:b]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    out.append(head + sig[used].tobytes() + n[used].astype(np.int64).tobytes() + cut6 + local.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(out, pa.binary())], names=["bucket", "payload"])

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for blob in frame["payload"]:
            docs, k = np.frombuffer(blob, np.int64, 2)
            sig = np.frombuffer(blob, U64, docs, 16)
            n = np.frombuffer(blob, np.int64, docs, 16 + 8 * docs)
            wide = np.zeros((k, 8), np.uint8)
            wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * k, 16 + 16 * docs).reshape(k, 6)
            local = np.frombuffer(blob, np.uint16, k, 16 + 16 * docs + 6 * k)
            parts.append((wide.view(U64).reshape(k), sig[local], n[local]))
        h, sig, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((sig, h))
        h, sig, n = h[order], sig[order], n[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])  # copies in other blocks
        h, sig, n = h[new], sig[new], n[new]
        group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
        df = np.bincount(group)[group]
        several = df > 1
        return pd.DataFrame({"sig": sig[several].view(np.int64), "n": n[several], "h": h[several].view(np.int64), "df": df[several].astype(np.int64)})

    def keep(frame: pd.DataFrame) -> pd.DataFrame:
        sig, n, h, df = (frame[c].to_numpy() for c in ("sig", "n", "h", "df"))
        order = np.lexsort((h, df, sig))
        sig, n, h, df = sig[order], n[order], h[order], df[order]
        first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        shared = np.diff(np.append(first, len(sig)))
        take = np.maximum(shared - bounds.common_with_any(n[first]) + 1, 0)
        out = []
        for f, t, s in zip(first[take > 0], take[take > 0], shared[take > 0]):
            typical = float(np.log(df[f : f + s]).sum())
            out.append((int(sig[f]), int(n[f]), typical, [{"h": int(x), "df": int(y)} for x, y in zip(h[f : f + t], df[f : f + t])]))
        return pd.DataFrame(out, columns=["sig", "n", "typical", "grams"])

    rows = documents.select(F.coalesce("text", F.lit("")).alias("text"))
    posted = rows.mapInArrow(cut, "bucket int, payload binary").repartition(buckets, "bucket").groupBy("bucket")
    counted = posted.applyInPandas(count, "sig long, n long, h long, df long")
    part = F.pmod(F.xxhash64("sig"), F.lit(4 * buckets))
    kept = counted.withColumn("part", part).groupBy("part").applyInPandas(keep, "sig long, n long, typical double, grams array<struct<h:long,df:long>>")
    return session.stage(kept, "candidates")


def _sieve(keepers: DataFrame, key: Column, log_bits: int) -> np.ndarray:
    """A bitmap of 2**log_bits bits with the bit of the ``key`` of every row set."""
    slot = F.pmod(key, F.lit(1 << log_bits))
    rows = keepers.select((slot / 32768).cast("int").alias("page"), F.pmod(slot, F.lit(32768)).alias("bit"))
    pages = rows.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = bytearray(1 << log_bits - 3)
    for r in pages:
        out[4096 * r["page"] : 4096 * (r["page"] + 1)] = r["bits"]
    return np.frombuffer(bytes(out), np.uint8)


def _passed(sieve: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = (key % U64(8 * len(sieve))).astype(np.int64)
    return (sieve[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def whole_sets(documents: DataFrame, rows: DataFrame, found: DataFrame, size: int, mapped: DataFrame | None = None) -> DataFrame:
    """sig, n, members (binary, sorted) of the sets in ``found``; stored.

    One document stands for all its copies; texts of other documents are not cut into n-grams. The bitmaps let few other rows
    through, which repeat a set at worst. With ``mapped``, the rows are the sets in that table, each with the bitmap ``bits``
    of ``groups``, and members are null but for the sets in ``found``, which are among them.
    """
    wanted = (found if mapped is None else mapped).select("sig")
    keepers = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc_id")).join(wanted, "sig")
    keepers = session.stage(keepers, "keepers")
    log_bits = min(28, max(20, (8 * keepers.count()).bit_length()))
    owner = F.coalesce("doc_id", F.lit(0))
    both = F.col("sig").bitwiseXOR(owner)
    by_id, by_set = _sieve(keepers, owner, log_bits), _sieve(keepers, both, log_bits)
    by_whole = by_set if mapped is None else _sieve(keepers.join(found.select("sig"), "sig", "left_semi"), both, log_bits)
    with_bits = mapped is not None

    def ids_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).view(U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = (batch.filter(pa.array(_passed(by_id, ids_of(batch)))) for batch in batches)
        for block in words.blocks(owners, "text", BLOCK_BYTES):
            h, at, sig = _sets(block.column(1), size)
            key = sig ^ ids_of(block)
            passed = np.flatnonzero((sig != 0) & _passed(by_set, key))
            _, first = np.unique(sig[passed], return_index=True)
            passed = passed[first]
            own = [h[at[i] : at[i + 1]] for i in passed]
            whole = [x.tobytes() if w else None for x, w in zip(own, _passed(by_whole, key[passed]))]
            columns = [pa.array(sig[passed].view(np.int64)), pa.array([len(x) for x in own], pa.int64()), pa.array(whole, pa.binary())]
            if with_bits:
                columns.append(pa.array([groups.parity(x) for x in own], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["sig", "n", "members", "bits"][: len(columns)])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return session.stage(texts.mapInArrow(run, "sig long, n long, members binary" + (", bits binary" if with_bits else "")), "sets")


def verified(pairs: DataFrame, sets: DataFrame, bounds: Bounds) -> DataFrame:
    """Pairs (a, b) that are links, by the whole sets; with shared, the size of the intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*[c.to_pylist() for c in batch.columns]):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                if bounds.linked(shared, len(x), len(y)):
                    out.append((a, b, shared))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["a", "b", "shared"])

    # at most 2**18 slots of hashed vertices go to all tasks, to leave out other sets before the shuffle
    slot = lambda c: F.pmod(F.col(c), F.lit(1 << 18))
    slots = pairs.select(F.explode(F.array("a", "b")).alias("v")).select(slot("v").alias("slot")).distinct()
    # copies that the bitmap of ``whole_sets`` let through fall together where the join needs them anyway
    asked = sets.withColumn("slot", slot("sig")).join(F.broadcast(slots), "slot", "left_semi").groupBy("sig").agg(F.first("members").alias("members"))
    left = asked.select(F.col("sig").alias("a"), F.col("members").alias("x"))
    right = asked.select(F.col("sig").alias("b"), F.col("members").alias("y"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long, shared long")


def _centre_pairs(found: DataFrame, bounds: Bounds) -> DataFrame:
    """Each set with the one centre (the most typical set of a column) that it shares most columns with: a, b."""
    cells = found.select("sig", "n", (F.col("typical") / F.col("n")).alias("typical"), F.explode("grams.h").alias("h"))
    centre = cells.groupBy("h").agg(F.max_by(F.struct("sig", "n"), F.struct("typical", -F.col("sig"))).alias("c"))
    both = cells.join(centre, "h").where("sig != c.sig").where(100 * F.least("n", "c.n") >= bounds.percent * F.greatest("n", "c.n"))
    pairs = both.groupBy(F.col("sig").alias("a"), F.col("c.sig").alias("b")).agg(F.count("*").alias("overlap"))
    return pairs.groupBy("a").agg(F.max_by("b", F.struct("overlap", -F.col("b"))).alias("b"))


def links(documents: DataFrame, size: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Rows of ``sizes`` and the verified links (a, b) between vertices, enough to tie every component."""
    bounds = Bounds(percent)
    rows = sizes(documents, size)
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(buckets, grams // 4_000_000)
    found = candidates(documents, size, bounds, buckets)
    sets = whole_sets(documents, rows, found, size)
    near = session.stage(verified(session.stage(_centre_pairs(found, bounds), "centres"), sets, bounds).select("a", "b"), "near")
    label = components(near, "a", "b").select(F.col("id").alias("sig"), "component")
    columns = found.select("sig", F.explode("grams.h").alias("group"))
    return rows, near.unionByName(groups.tie(columns, label, sets, bounds, lambda p: verified(p, sets, bounds)))


def named_rows(rows: DataFrame, near: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of ``rows`` (doc_id, n_shingles, sig) by links between vertices."""
    label = components(near, "a", "b").select(F.col("id").alias("sig"), "component")
    rows = rows.join(label, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").select("component", "least")
    least = session.stage(least, "least")
    return rows.join(least, "component", "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def join_groups(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) of each row."""
    return named_rows(*links(documents, size, percent))
