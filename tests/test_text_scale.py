"""Cleaning of token rows: nothing is shuffled by token, and a frequent word is dealt out where the list is long."""

import pytest
from pyspark.sql import functions as F

from tablelab.operators import text as T


@pytest.fixture(scope="module")
def rows(spark):
    common = spark.range(3000).select(F.col("id"), F.lit(0).alias("pos"), F.when(F.col("id") % 3 == 0, "stopped").otherwise("common").alias("token"))
    others = spark.range(2000).select(F.col("id"), F.lit(1).alias("pos"), F.concat(F.lit("w"), (F.col("id") % 150).cast("string")).alias("token"))
    rare = spark.range(20).select(F.col("id"), F.lit(2).alias("pos"), F.concat(F.lit("rare"), F.col("id").cast("string")).alias("token"))
    return common.union(others).union(rare)


def _cleaned(spark, rows, **options):
    return T.clean_rows(rows, T.word_list(spark, ["stopped"]), T.token_counts(rows), **options)


def _plain(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_do_not_move_for_a_short_list(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _cleaned(spark, rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_long_list_gives_the_same_rows(spark, rows):
    expected = _plain(rows.filter("token <> 'stopped' and token not like 'rare%'"))
    assert _plain(_cleaned(spark, rows)) == expected
    assert _plain(_cleaned(spark, rows, broadcast_rows=0)) == expected


def test_split_at_all_but_ascii_letters_and_digits(spark):
    texts = ["Abc_def-ghi  x1y2 Straße ﬁne naïve", "", "___", "  lead", "trail   \t", "Кот and 猫cat \U0001f600emoji\U0001f600", "KKlvin"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plain = df.select("id", F.posexplode(F.split("text", "[^A-Za-z0-9]+")).alias("pos", "w"))
    plain = plain.filter("char_length(w) >= 3 and not w rlike '[0-9]'").select("id", "pos", F.lower("w"))
    assert _plain(T.token_rows(df, "id", "text")) == _plain(plain)
