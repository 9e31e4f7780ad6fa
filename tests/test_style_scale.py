"""Style counts: the same numbers as each pattern by itself, with few scans of the whole text."""

import random

from pyspark.sql import functions as F

from tablelab.functions import textexpr as E
from tablelab.operators import text


def test_style_steps_match_each_pattern(spark):
    rng = random.Random(3)
    letters = "aabzABIi0_ 9!?.,:;=-)DP\n\t&@#$%*^¿éßΑ一٣  \x01—\U0001f600"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(3000)]
    df = spark.createDataFrame([*rows, (-1, None), (-2, "")], "id long, t string")
    for ascii in (True, False):
        want = df.select("id", *[c.alias(n) for n, c in E.style_counts(F.col("t"), ascii).items()]).withColumns(E.style_ratios())
        got = text.style_features(df, "id", "t", ascii)
        assert got.schema == want.schema
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_long_texts_are_scanned_once(spark):
    df = spark.createDataFrame([(1, "Some words")], "id int, t string")
    lines = text.style_features(df, "id", "t")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    scans = [x.count("(t#") for x in lines]
    assert sum(scans) <= 2  # its length and the shorter text; one for each pattern before
