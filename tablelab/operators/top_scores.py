"""Best items per user by the product of factor vectors, without scoring every pair.

Items are cut into chunks of about equal, bounded size by falling length of their vectors; a chunk is one pass over the
users that are not finished. Within a chunk items come in blocks. No item of a block, or after it, can score above
length of the user x longest item of the block; a user whose k-th score lies above that is finished.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session

#: Bytes of item vectors that travel to the tasks at a time (cuts come from a sample, so about), items of one block, and users
#: whose products with a block are held at a time.
CHUNK_BYTES = 32 << 20
BLOCK_ITEMS = 512
GROUP_USERS = 1024
_USERS = "user int, u array<double>, items array<int>, scores array<double>, scored long, finished boolean"


def _merge(items: np.ndarray, scores: np.ndarray, ids: np.ndarray, fresh: np.ndarray, k: int) -> None:
    """Put into each row's list the k best of it and of the new block, in place; equal scores by smaller id.

    Only products that reach a row's k-th score, and the block's own k-th, are sorted.
    """
    rows = np.flatnonzero((fresh >= scores[:, -1:]).any(axis=1))
    if not len(rows):
        return
    some = fresh[rows]
    some[np.isnan(some)] = -np.inf
    edge = scores[rows, -1]
    if some.shape[1] > k:
        edge = np.maximum(edge, np.partition(some, -k, axis=1)[:, -k])
    row, col = np.nonzero(some >= edge[:, None])
    owner = np.concatenate([np.repeat(np.arange(len(rows)), k), row])
    all_ids = np.concatenate([items[rows].ravel(), ids[col]])
    all_scores = np.concatenate([scores[rows].ravel(), some[row, col]])
    order = np.lexsort((all_ids, -all_scores, owner))
    counts = np.bincount(owner, minlength=len(rows))  # k at least
    best = order[(np.cumsum(counts) - counts)[:, None] + np.arange(k)]
    items[rows], scores[rows] = all_ids[best], all_scores[best]


def _pass(chunk, k: int):
    """Offer one chunk (ids, vectors, longest vector of each block) to all unfinished users."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors, longest = chunk.value
        for batch in batches:
            if not len(batch):
                continue
            u = np.stack(batch["u"].to_numpy())
            items = np.stack([np.pad(np.asarray(x, dtype="int32"), (0, k - len(x)), constant_values=np.iinfo("int32").max) for x in batch["items"]])
            scores = np.stack([np.pad(np.asarray(x, dtype=float), (0, k - len(x)), constant_values=-np.inf) for x in batch["scores"]])
            scored, finished = batch["scored"].to_numpy().copy(), batch["finished"].to_numpy().copy()
            length = np.sqrt((u * u).sum(axis=1))
            for first in range(0, len(u), GROUP_USERS):
                group = np.arange(first, min(first + GROUP_USERS, len(u)))
                for no, at in enumerate(range(0, len(ids), BLOCK_ITEMS)):
                    # a little slack, so that rounding never ends a user too early
                    finished[group] |= length[group] * longest[no] * (1 + 1e-9) < scores[group, -1]
                    who = group[~finished[group]]
                    if not len(who):
                        break
                    block = slice(at, at + BLOCK_ITEMS)
                    kept_items, kept_scores = items[who], scores[who]
                    _merge(kept_items, kept_scores, ids[block], u[who] @ vectors[block].T, k)
                    items[who], scores[who] = kept_items, kept_scores
                    scored[who] += len(ids[block])
            full = np.isfinite(scores)
            yield pd.DataFrame({
                "user": batch["user"], "u": batch["u"], "items": [x[f] for x, f in zip(items, full)],
                "scores": [x[f] for x, f in zip(scores, full)], "scored": scored, "finished": finished,
            })

    return run


def best_items(users: DataFrame, items: DataFrame, k: int = 5, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """user, items, scores (best first, equal scores by smaller item), scored (number of items looked at).

    ``users``, ``items``: id and features (array of numbers), one row each. All users get min(k, items) items. Without
    items the lists are empty. Rows with null features are left out.
    """
    spark = users.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = items.where("features is not null").select("id", F.col("features").cast("array<double>").alias("v"))
    vectors = vectors.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    chunks = -(-n * (8 * (width or 1) + 8) // chunk_bytes)
    # range partitions by falling length are the chunks; equal lengths are divided by id
    ranged = vectors.repartitionByRange(chunks, F.desc("length"), "id") if chunks else vectors
    chunked = session.stage(ranged.withColumn("chunk", F.spark_partition_id()), "items")
    state = users.where("features is not null").select(
        F.col("id").alias("user"), F.col("features").cast("array<double>").alias("u"), F.array().cast("array<int>").alias("items"),
        F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored"), F.lit(False).alias("finished"))
    # factor tables come in few partitions; each pass is work of the users alone
    state, done = session.stage(state.repartition(parts), "users"), []
    for no in range(chunks):
        rows = chunked.where(F.col("chunk") == no).select("id", "v", "length").toPandas().sort_values(["length", "id"], ascending=[False, True])
        if rows.empty:
            continue
        chunk = spark.sparkContext.broadcast((rows["id"].to_numpy(dtype="int32"), np.stack(rows["v"].to_numpy()), rows["length"].to_numpy()[::BLOCK_ITEMS]))
        after = session.stage(state.mapInPandas(_pass(chunk, k), _USERS), "offered")
        chunk.destroy()  # what was offered is stored
        done.append(after.where("finished"))
        state = after.where("not finished")
        if no + 1 < chunks and state.isEmpty():
            break
    out = state
    for frame in done:
        out = out.unionByName(frame)
    return out.select("user", "items", "scores", "scored")
