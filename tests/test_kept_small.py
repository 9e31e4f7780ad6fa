"""What long fits hold: tables of finished rounds are dropped, and packing rows holds little more than one group."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablelab import session
from tablelab.operators import boosting, bounded_kmeans, recommend


def test_tables_of_finished_trees_are_dropped(spark):
    rows = spark.range(400).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 7 > 3).cast("int").alias("y"), (F.col("id") % 3 == 0).alias("held"))
    before = set(session._staged)
    model = boosting.fit_boosted(rows, "y", ["x"], ["id"], "held", trees=3, depth=2, patience=0)
    assert len(model.trees) == 3 and set(session._staged) == before


def test_als_grid_lets_go_after_each_setting(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(recommend, "release", lambda spark, *staged: calls.append(len(staged)))
    pairs = spark.range(60).select((F.col("id") % 6).cast("int").alias("user"), (F.col("id") % 10).cast("int").alias("item"), F.lit(1.0).alias("rating"))
    got = recommend.als_grid(pairs, pairs.where("item < 5"), pairs.where("item >= 5").select("user", "item"), ranks=(2,), alphas=(1.0, 2.0), iterations=1)
    assert got.count() == 2 and len(calls) >= 3 and calls[-1] == 1


def test_packing_holds_one_group(monkeypatch):
    monkeypatch.setattr(bounded_kmeans, "GROUP_BYTES", 4 << 20)
    rng, width, sums = np.random.default_rng(3), 16, 0.0

    def batches():
        nonlocal sums
        for n in (1, 5_000, 0, 60_000, 60_000, 7):
            x = rng.normal(size=(n, width))
            sums = sums + x.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype="int32"), x.ravel())], names=["x"])

    rows, total, most = 0, 0.0, 0
    tracemalloc.start()
    for batch in bounded_kmeans._pack(batches()):
        most = max(most, tracemalloc.get_traced_memory()[0])
        for n, data, low, high in zip(*(c.to_pylist() for c in batch.columns)):
            leaf = np.frombuffer(data).reshape(width, n)
            rows, total = rows + n, total + leaf.sum(axis=1)
            assert (leaf.min(axis=1) == np.frombuffer(low)).all() and (leaf.max(axis=1) == np.frombuffer(high)).all()
    tracemalloc.stop()
    assert rows == 125_008 and np.allclose(total, sums)
    assert most < 32 << 20
