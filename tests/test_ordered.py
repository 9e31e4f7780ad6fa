"""Ranks and running totals with one key holding a third of the rows, against plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablelab.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 50).cast("int").alias("k"),
        (F.col("id") * 7919 % 40).cast("int").alias("a"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 31 % 500).cast("double")).alias("b"),
        F.concat(F.lit("w"), (F.col("id") * 13 % 300).cast("string")).alias("s"),
        "id",
    )
    return df


@pytest.mark.parametrize("order", [["a", "id"], ["-a", "-id"], ["b", "-a", "id"], ["-b", "id"], ["s", "id"], ["-s", "-b", "id"], ["id"]])
@pytest.mark.parametrize("keys", [["k"], []])
def test_positions_equal_window(skewed, keys, order):
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*O.sort_columns(order))
    want = {r["id"]: r["p"] for r in skewed.select("id", F.row_number().over(w).alias("p")).collect()}
    got = {r["id"]: r["pos"] for r in O.row_positions(skewed, keys, order).select("id", "pos").collect()}
    assert got == want


def test_no_slice_holds_a_hot_key(skewed):
    sliced = O.with_slices(skewed, ["a", "id"], slices=16)
    biggest = sliced.groupBy("k", O.SLICE).count().agg(F.max("count")).first()[0]
    hot = skewed.groupBy("k").count().agg(F.max("count")).first()[0]
    assert hot >= 2000 and biggest <= 6000 / 16 * 2


def test_frequent_value_is_divided_by_next_column(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("a"), "id")
    sliced = O.with_slices(df, ["a", "id"], slices=16)
    assert sliced.groupBy(O.SLICE).count().agg(F.max("count")).first()[0] <= 4000 / 16 * 2


def test_texts_with_a_common_prefix_spread(spark):
    df = spark.range(4000).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name"), "id")
    sizes = [r["count"] for r in O.with_slices(df, ["name"], slices=16).groupBy(O.SLICE).count().collect()]
    assert len(sizes) >= 16 and max(sizes) <= 4000 / 16 * 2
    got = O.row_positions(df, [], ["-name"], slices=16)
    assert got.filter(F.col("pos") != 4000 - F.col("id")).count() == 0


def test_many_order_columns_and_slices(spark):
    df = spark.range(300).select(*[(F.col("id") % m).alias(f"c{m}") for m in (1, 2, 3, 5, 7)], "id")
    order = ["c1", "-c2", "c3", "c5", "-c7", "id"]
    w = Window.orderBy(*O.sort_columns(order))
    want = {r["id"]: r["p"] for r in df.select("id", F.row_number().over(w).alias("p")).collect()}
    assert {r["id"]: r["pos"] for r in O.row_positions(df, [], order, slices=10_000).collect()} == want


def test_running_totals(skewed):
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {r["id"]: r["t"] for r in skewed.select("id", F.sum("a").over(w).alias("t")).collect()}
    got = O.running_totals(skewed, ["k"], ["id"], {"t": F.col("a")}, staged=True)
    assert {r["id"]: r["t"] for r in got.collect()} == want


def test_previous_values(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 5)], "k int, n bigint, v int")
    got = {(r["k"], r["n"]): r["before"] for r in O.previous_values(df, ["k"], "n", {"before": "v"}).collect()}
    assert got == {(1, 1): None, (1, 2): 10, (2, 1): None}


def test_top_with_ties_keeps_all_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 4), ("c", 4), ("d", 4), ("e", 1)], "t string, n int")
    assert {r["t"] for r in O.top_with_ties(df, "n", 2).collect()} == {"a", "b", "c", "d"}
    assert {r["t"] for r in O.top_with_ties(df, "n", 1, largest=False).collect()} == {"e"}
    assert O.top_with_ties(df, "n", 99).count() == 5


def test_top_per_group_limits_before_the_shuffle(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type", "user_id").count()
    plan = O.top_with_ties(df, "count", 3, ["event_type"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_kth_largest_with_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "d double")
    assert O.kth_largest(df, "d", 100).first()[0] == 1.0
