"""Fewer scans of the text rewrite it as the rules one by one do."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablelab.functions import textexpr as E
from tablelab.functions.scalars import replace_all

PAIRS = [("t he", "the"), ("a nd", "and"), ("c.t", "cat"), ("x", "$1")]


@pytest.mark.parametrize("ascii", [True, False])
def test_one_class_stands_for_the_run_on_every_character(spark, ascii):
    rules = E.cleaning_rules(ascii=ascii)
    quick = E.quick_rules(rules, ascii)
    start = next(i for i, (p, _) in enumerate(rules) if "@" in p) + 1
    run = rules[start : start + 5]
    assert len(quick) == len(rules) - 4
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = spark.createDataFrame([("".join(map(chr, points[i : i + 4096])),) for i in range(0, len(points), 4096)], "t string")
    one = [(p, r) for p, r, is_regex in quick if is_regex and p in ("[^A-Za-z]", r"[^\p{IsAlphabetic}]")]
    assert len(one) == 1
    assert texts.where(replace_all(F.col("t"), run) != replace_all(F.col("t"), one)).count() == 0


@pytest.mark.parametrize("ascii", [True, False])
def test_texts_are_normalised_as_rule_by_rule(spark, ascii):
    draw = random.Random(4)
    pieces = ["what's", "can't", "n't", " t he", "a nd", "c.t", "x", "fu ck", "fu", "li", "ck", "ing", "duc", "k", "\u00a0", "lol", "http://a.b", "@me", "7", "é", "ñ", "\n", "  ", "\U0001f600", "²", "'", "I'm", "source", "_", " ", "١"]
    rows = [("".join(draw.choices(pieces, k=draw.randint(0, 25))),) for _ in range(3000)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    rules = E.cleaning_rules(PAIRS, ascii=ascii)
    quick = E.quick_rules(rules, ascii)
    assert len(quick) == len(rules) - 4 and sum(not r[2] for r in quick) >= 17
    assert df.where(~E.normalise(F.col("t"), PAIRS, ascii=ascii).eqNullSafe(replace_all(F.lower("t"), rules))).count() == 0
