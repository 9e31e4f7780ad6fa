"""Distinct values of a profile are counted column by column."""

import datetime

from pyspark.sql import functions as F

from tablelab.operators.relational import profile


def test_profile_expands_and_sorts_no_rows(spark):
    df = spark.range(50).select("id", F.concat(F.lit("name "), "id").alias("name"), (F.col("id") % 3).cast("double").alias("third"))
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Sort [" not in plan


def test_profile_of_odd_columns(spark):
    day = datetime.date(2020, 1, 2)
    rows = [(1, None, 0.0, [1], day), (2, "a", -0.0, [1], None), (3, "a", float("nan"), None, day), (4, "b", float("nan"), [2], day)]
    found = {r["column"]: r for r in profile(spark.createDataFrame(rows, "k int, `a.b` string, x double, l array<int>, d date").withColumnRenamed("a.b", "s")).collect()}
    assert list(found) == ["k", "s", "x", "l", "d"]
    assert [found[c]["distinct"] for c in found] == [4, 2, 2, None, 1]
    assert [found[c]["nulls"] for c in found] == [0, 1, 0, 1, 1]
    assert found["s"]["min"] == "a" and found["k"]["mean"] == 2.5 and found["s"]["mean"] is None
    none = profile(spark.createDataFrame([], "k int"))
    assert [tuple(r) for r in none.collect()] == [("k", "int", 0, 0, 0, None, None, None)]


def test_profile_with_a_sketch(spark):
    assert profile(spark.range(5), approximate_distinct=True).first()["distinct"] == 5
