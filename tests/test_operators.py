"""Small-frame checks of single operators, including the corner cases that were decided on purpose."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablelab.functions import scalars as S
from tablelab.functions import spatial as G
from tablelab.functions import textexpr as E
from tablelab.functions.calendar import parse_day, with_calendar
from tablelab.operators import anomaly, basket, evaluate, features, geo, models, raster, recommend, relational, sampling, sensors, text
from tablelab.plans import fixtures as X
from tablelab.session import drop_staged, fresh_path, shared_folder, small_side, stage


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# --- session ---------------------------------------------------------------------------------------


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2.5)
    got = stage(df)
    assert got.dtypes == df.dtypes and sorted(got.collect()) == sorted(df.collect())


def test_drop_staged_forgets_what_it_deleted(spark):
    df = stage(spark.range(3))
    assert df.inputFiles() and drop_staged(spark) > 0 and drop_staged(spark) == 0


def test_small_side_hints_only_what_is_small(spark):
    df = spark.range(100).toDF("id")

    def hinted(d):
        return "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()

    assert hinted(small_side(df))
    assert not hinted(small_side(df, max_rows=50))
    assert not hinted(small_side(df, max_bytes=10))


# --- scalars ---------------------------------------------------------------------------------------


def test_safe_casts(spark):
    assert one(spark, S.safe_int(F.lit("12x"))) is None
    assert one(spark, S.safe_int(F.lit(" 12 "))) == 12
    assert one(spark, S.safe_double(F.lit(""))) is None


def test_first_separator(spark):
    v = F.lit("7\t a\tb ")
    assert one(spark, S.before_first(v, "\t")) == "7" and one(spark, S.after_first(v, "\t")) == "a\tb"
    assert one(spark, S.after_first(F.lit("abc"), "\t")) == ""


def test_ratio_defaults(spark):
    assert one(spark, S.ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, S.ratio(F.lit(1), F.lit(0), None)) is None


def test_later_rule_wins(spark):
    rules = [(F.lit(True), "a"), (F.lit(True), "b"), (F.lit(False), "c")]
    assert one(spark, S.later_rule_wins(rules)) == "b"


def test_index_of_one(spark):
    assert one(spark, S.index_of_one([F.lit(0.0), F.lit(1.0)])) == 1
    assert one(spark, S.index_of_one([F.lit(0.0), F.lit(0.0)])) == -1


def test_literal_count_is_literal(spark):
    assert one(spark, S.count_literal(F.lit("a.b.c"), ".")) == 2
    assert one(spark, S.count_literal(F.lit("    "), "  ")) == 2


def test_calendar(spark):
    df = spark.createDataFrame([("4/6/2014 0:11:05",), ("bad",)], "t string")
    r = with_calendar(df, "t").orderBy(F.col("time").desc_nulls_last()).first()
    assert (r["year"], r["month"], r["dayofmonth"], r["weekday"], r["hour"], r["minute"], r["second"]) == (2014, 4, 6, 1, 0, 11, 5)
    assert df.select(parse_day(F.col("t"))).filter("t = 'bad'").first()[0] is None


# --- relational ------------------------------------------------------------------------------------


def test_lookup_keeps_unmapped(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "item int")
    m = spark.createDataFrame([(2, 9)], "bad int, good int")
    assert sorted((r["item"] or 0) for r in relational.lookup_or_same(df, "item", m, "bad", "good").collect()) == [0, 1, 9]


def test_distinct_counts_null_once(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "x string")
    assert df.agg(relational.distinct_with_null(F.col("x"))).first()[0] == 2


def test_union_by_name_fills_nulls(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    u = relational.union_by_name([a, b])
    assert u.count() == 2 and u.filter("y is null").count() == 1


def test_grouped_strings_default(spark):
    df = spark.createDataFrame([(1, 10, 0.9), (1, 2, 0.5), (2, 7, 0.1)], "order_id int, product_id int, p1 double")
    got = {r["order_id"]: r["products"] for r in basket.basket_strings(df).collect()}
    assert got == {1: "2 10", 2: "None"}


def test_weighted_tally_is_squared(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "w string")
    assert {r["w"]: r["n"] for r in relational.weighted_tally(df, "w").collect()} == {"a": 9, "b": 1}


def test_quantiles_exact_and_sketch(spark):
    df = spark.range(1, 102).toDF("x")
    exact = relational.five_numbers(df, ["x"]).first()
    assert (exact["q1"], exact["median"], exact["q3"], exact["mean"]) == (26.0, 51.0, 76.0, 51.0)
    sketch = relational.five_numbers(df, ["x"], exact=False).first()
    assert abs(sketch["median"] - 51) <= 1


def test_quantiles_of_many_columns_equal_a_full_sort(spark):
    draw = np.random.default_rng(3)
    n = 20_001
    frame = pd.DataFrame({"a": draw.normal(size=n), "b": draw.integers(0, 5, n).astype(float), "c": np.where(np.arange(n) % 3 == 0, 7.0, draw.random(n)), "d": np.arange(n, dtype=float)})
    shares = [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    df = spark.createDataFrame(frame).repartition(7)
    df = df.select(*[F.when(F.col("d") % 11 == 0, None).otherwise(F.col(c)).alias(c) for c in "abc"], "d", F.lit(None).cast("double").alias("none"))
    kept = frame[frame.d % 11 != 0]
    for margin in (0.002, 0.0):  # without a margin most brackets miss their place and are widened
        found = {r["column"]: r for r in relational.quantiles_of(df, ["a", "b", "c", "d", "none"], shares, margin).collect()}
        for name, x in (("a", kept.a), ("b", kept.b), ("c", kept.c), ("d", frame.d)):
            assert np.allclose([found[name][f"q{j}"] for j in range(len(shares))], np.quantile(x, shares)), (name, margin)
        assert found["none"]["q0"] is None and found["none"]["n"] == 0


def test_join_suffixes(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, v int"), spark.createDataFrame([(1, 3)], "k int, v int")
    assert set(relational.join_suffixed(a, b, ["k"], "left").columns) == {"k", "v_x", "v_y"}


# --- basket ----------------------------------------------------------------------------------------


def test_null_strict_means(spark):
    rows = [(1, 1, 1, 5, 0, "p", "a", "d", None, 1), (1, 1, 2, 7, 1, "p", "a", "d", 4, 0)]
    cols = ("user_id int, product_id int, order_number int, order_hour_of_day int, reordered int, product_name string, aisle string, "
            "department string, days_since_prior_order int, orders_ago int")
    fact = spark.createDataFrame(rows, cols)
    assert basket.user_summary(fact).first()["average_days_between_orders"] == 4.0
    assert basket.user_summary(fact, null_strict=True).first()["average_days_between_orders"] is None
    assert basket.user_product_features(fact).first()["reorder_rate"] == 0.5


def test_features_leave_out_what_leaks():
    assert not {"reordered", "add_to_cart_order"} & set(basket.FEATURES)


def test_features_exist_in_both_frames(spark, sf):
    orders = X.numbered_orders(spark, sf)
    lines = X.order_lines(spark, sf, orders)
    fact = basket.fact_table(lines.filter("eval_set = 'prior'").drop("eval_set"), orders, X.products(spark, sf), X.aisles(spark, sf), X.departments(spark, sf))
    train = basket.training_frame(fact, lines.filter("eval_set = 'train'").drop("eval_set"), orders)
    assert set(basket.FEATURES) <= set(train.columns) and set(basket.FEATURES) <= set(basket.scoring_frame(fact, orders).columns)


# --- evaluation ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(5)
    rows = [(1 if i % 3 == 0 else rnd.randrange(20), rnd.randrange(9) / 8, rnd.random() < 0.4) for i in range(900)]
    return rows, spark.createDataFrame(rows, "user int, score double, positive boolean")


def test_user_auc_against_all_pairs(scored):
    rows, df = scored
    want = {}
    for u in {r[0] for r in rows}:
        p = [r[1] for r in rows if r[0] == u and r[2]]
        n = [r[1] for r in rows if r[0] == u and not r[2]]
        if p and n:
            want[u] = sum(a > b for a in p for b in n) / (len(p) * len(n))
    got = {r["user"]: r["auc"] for r in evaluate.user_auc(df, "user", "score", "positive").collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[u], want[u]) for u in want)


def test_auc_of_reversed_scores(scored):
    _, df = scored
    a = evaluate.binary_auc(df, "score", "positive").first()[0]
    b = evaluate.binary_auc(df.withColumn("score", -F.col("score")), "score", "positive").first()[0]
    assert math.isclose(a, 1 - b)


def test_entropy_of_pure_and_mixed_clusters(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b")], "cluster int, label string")
    assert math.isclose(evaluate.cluster_entropy(df).first()[0], 0.5 * math.log(2))


def test_stratified_folds_are_even(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    sizes = models.with_folds(df, "y", "id", 7).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r["y"] == y]
        assert len(n) == 7 and max(n) - min(n) <= 1


def test_more_folds_than_rows(spark):
    df = spark.range(3).select("id", F.lit(1).alias("y"))
    assert {r["fold"] for r in models.with_folds(df, "y", "id", 5).collect()} == {0, 1, 2}


# --- recommendation --------------------------------------------------------------------------------


def test_negatives_are_complete_and_outside_positives(spark):
    rows = [(1, i) for i in range(30)] + [(2, i) for i in (0, 39)] + [(3, i) for i in range(39)] + [(4, i) for i in range(40)]
    pos = spark.createDataFrame(rows, "user int, item int")
    neg = [tuple(r) for r in recommend.negative_items(pos, pos).collect()]
    mine = {}
    for u, i in rows:
        mine.setdefault(u, set()).add(i)
    for u in (1, 2, 3):
        drawn = [i for x, i in neg if x == u]
        assert len(drawn) == len(mine[u]) and not set(drawn) & mine[u]
    assert all(x != 4 for x, _ in neg)  # owns every item


def test_als_beats_chance_on_block_structure(spark):
    rows = [(u, i, 5.0) for u in range(40) for i in range(40) if (u % 2 == i % 2) and (u * 7 + i * 3) % 4]
    train, valid = recommend.hash_split(spark.createDataFrame(rows, "user int, item int, rating double"))
    model = recommend.fit_als(train, rank=4, iterations=5, reg=0.1, alpha=10.0)
    neg = recommend.negative_items(spark.createDataFrame(rows, "user int, item int, rating double"), train)
    assert recommend.auc_of_scorer(valid, neg, recommend.als_scorer(model)).first()["mean_auc"] > 0.7


def test_parse_artists_drops_bad_rows(spark):
    lines = spark.createDataFrame([("1\tA b ",), ("x\tB",), ("3\t",), ("4",)], "value string")
    assert [tuple(r) for r in recommend.parse_artists(lines).collect()] == [(1, "A b")]


# --- space -----------------------------------------------------------------------------------------

SQUARE_WITH_HOLE = ('{"type": "Polygon", "coordinates": [[[0,0],[10,0],[10,10],[0,10],[0,0]],[[4,4],[6,4],[6,6],[4,6],[4,4]]]}')
TWO = ('{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1],[0,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,6],[5,5]]]]}}')


def test_holes_and_parts(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 11.0, 1.0), (4, 5.5, 5.5), (5, 0.5, 0.5)], "id int, x double, y double")
    assert {r["id"] for r in geo.within_area(pts, "x", "y", SQUARE_WITH_HOLE).collect()} == {2, 5}
    assert {r["id"] for r in geo.within_area(pts.filter("id <> 1"), "x", "y", TWO).collect()} == {4, 5}


def test_area_and_complement_are_everything(spark, sf):
    s = X.stations(spark, sf)
    edges, box = geo.area_columns(spark, SQUARE_WITH_HOLE.replace("10", "9.5").replace("6", "9.2"))
    inside = G.contains(edges, box, F.col("lng"), F.col("lat") - 40)
    assert s.filter(inside).count() + s.filter(~inside).count() == s.count()


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(9.19, 45.46), (-179.0, -80.0), (0.0, 0.0)], "x double, y double")
    p = df.withColumn("m", G.to_mercator(F.col("x"), F.col("y"))).withColumn("b", G.from_mercator(F.col("m.x"), F.col("m.y")))
    assert all(abs(r["b"]["x"] - r["x"]) < 1e-9 and abs(r["b"]["y"] - r["y"]) < 1e-9 for r in p.collect())


def test_near_equals_full_scan(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.uniform(-180, 180), rnd.uniform(-89, 89)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    for center in ((9.2, 45.4), (179.5, 10.0), (0.0, 88.5)):
        for reach in (50_000, 900_000):
            d = G.sphere_distance(F.lit(center[0]), F.lit(center[1]), F.col("x"), F.col("y"))
            want = {r["id"] for r in df.filter(d <= reach).collect()}
            assert {r["id"] for r in geo.near(df, "x", "y", center, reach).collect()} == want


def test_zone_tags_against_all_pairs(spark, sf):
    points = X.stations(spark, sf)
    zones = geo.polygon_table(X.zones(spark, sf), "geometry")
    pairs = points.crossJoin(zones.select("NIL", "edges", "box")).filter(G.contains(F.col("edges"), F.col("box"), F.col("lng"), F.col("lat")))
    want = {r["IdSensore"]: r["z"] for r in pairs.groupBy("IdSensore").agg(F.min("NIL").alias("z")).collect()}
    for cells in (1, 4, 20):
        got = {r["IdSensore"]: r["zone"] for r in geo.tag_zones(points, "IdSensore", "lng", "lat", zones, "NIL", cells).collect()}
        assert got == want and want


def test_large_and_small_zones_take_a_few_cells_each(spark):
    rnd = random.Random(8)

    def ring(x, y, r, n):
        turns = [2 * math.pi * i / n for i in range(n)]
        points = [[x + r * (0.6 + 0.4 * rnd.random()) * math.cos(t), y + r * (0.6 + 0.4 * rnd.random()) * math.sin(t)] for t in turns]
        return str([[*points, points[0]]])

    shapes = [("z_big", ring(10.0, 45.0, 20.0, 40))] + [(f"a{i:03d}", ring(rnd.uniform(-10, 30), rnd.uniform(30, 60), 0.05 + rnd.random() / 4, 9)) for i in range(200)]
    # a square with a hole
    shapes.append(("b_hole", str([[[0, 40], [8, 40], [8, 48], [0, 48], [0, 40]], [[2, 42], [6, 42], [6, 46], [2, 46], [2, 42]]])))
    zones = geo.polygon_table(spark.createDataFrame([(n, f'{{"type": "Polygon", "coordinates": {c}}}') for n, c in shapes], "name string, g string"), "g")
    cover = geo.zone_cover(zones.withColumnRenamed("name", "zone"))
    sizes = {r["zone"]: r for r in cover.groupBy("zone").agg(F.count("*").alias("n"), F.count_if("inner").alias("inner"), F.max("level").alias("level")).collect()}
    assert len(sizes) == 202 and max(r["n"] for r in sizes.values()) <= 81
    assert sizes["z_big"]["inner"] > 0 and sizes["z_big"]["level"] < sizes["a000"]["level"]
    rows = [(i, rnd.uniform(-12, 32), rnd.uniform(24, 66)) for i in range(6_000)] + [(6_000 + i, 2.0 * (i % 5), 40.0 + i % 9) for i in range(40)] + [(9_999, None, None)]
    points = spark.createDataFrame(rows, "id int, x double, y double")
    pairs = points.join(zones, G.contains(F.col("edges"), F.col("box"), F.col("x"), F.col("y")))
    want = {r["id"]: r["z"] for r in pairs.groupBy("id").agg(F.min("name").alias("z")).collect()}
    for cells in (1, 4, 16):
        got = {r["id"]: r["zone"] for r in geo.tag_zones(points, "id", "x", "y", zones, "name", cells).collect()}
        assert got == want
    assert len(set(want.values())) > 20


def test_sensor_rules(spark):
    schema = X.SENSOR_SCHEMA
    docs = [
        ("a", ([1.0, 2.0],), ((["temperature"], ([1.0, 3.0],), None, None, None),)),
        ("b", ([1.0, 2.0],), ((["temperature"], ([],), 0.5, 0.0, None),)),
        ("c", ([1.0, 2.0],), ((["x"], ([],), 0.5, 2.0, 9.0),)),
        ("d", ([1.0, 2.0],), ((["x"], ([],), None, None, None),)),
    ]
    typed = sensors.with_sensor_type(spark.createDataFrame(docs, schema))
    assert {r["_id"]: r["sensorType"] for r in typed.collect()} == {"a": "temperature", "b": "rain", "c": "wind", "d": None}
    assert sensors.average_by_type(typed, "temperature").first()["total"] == 2.0
    assert sensors.positive_rain_average(typed).count() == 0


# --- raster ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(c, r, float((c * 31 + r * 17) % 23)) for c in range(16) for r in range(16)]
    return spark.createDataFrame(rows, "col int, row int, value double")


def test_focal_mean_of_constant(spark, cells):
    out = raster.focal_mean(cells.withColumn("value", F.lit(4.0)), 2)
    assert out.count() == 256 and out.filter("value <> 4.0").count() == 0


def test_focal_mean_with_gaps(cells):
    part = cells.filter("(col + row) % 3 <> 0")
    have = {(r["col"], r["row"]): r["value"] for r in part.collect()}
    for r in raster.focal_mean(part, 1).collect():
        near = [have[k] for k in ((r["col"] + i, r["row"] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if k in have]
        assert (r["col"], r["row"]) in have and math.isclose(r["value"], sum(near) / len(near))


def test_pyramid_of_means(cells):
    p = raster.pyramid(cells, 4, "mean")
    assert math.isclose(raster.level(p, 0).first()["value"], cells.agg(F.avg("value")).first()[0])
    assert {r["zoom"]: r["count"] for r in p.groupBy("zoom").count().collect()} == {4: 256, 3: 64, 2: 16, 1: 4, 0: 1}


def test_grid_maximum_against_lookups(spark, cells):
    grid = raster.Grid(-35.0, 60.0, 7.0)
    have = {(r["col"], r["row"]): r["value"] for r in cells.collect()}
    for stride in (3, 10, 20):
        best = (0.0, None, None)
        for x in range(-35, -35 + 16 * 7, stride):
            for y in range(60 - 16 * 7, 60, stride):
                v = have.get((math.floor((x + 35) / 7), math.floor((60 - y) / 7)))
                if v and v > best[0]:
                    best = (v, x, y)
        got = raster.grid_maximum(cells, grid, stride).first()
        assert (got["value"], got["x"], got["y"]) == best


def test_points_outside_are_null(spark, cells):
    pts = spark.createDataFrame([(0.5, -0.5), (99.0, -0.5)], "x double, y double")
    got = {r["x"]: r["value"] for r in raster.point_values(cells, raster.Grid(0, 0, 1.0), pts).collect()}
    assert got == {0.5: 0.0, 99.0: None}


def test_stitch_strips(cells):
    s = raster.stitch(cells, 10).collect()
    assert len(s) == 32 and [len(r["values"]) for r in s[:2]] == [10, 6]


# --- text ------------------------------------------------------------------------------------------


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello, the caffè_bar 12ab is OPEN!"), (2, "")], "id int, t string")
    rows = [(r["id"], r["token"]) for r in text.token_rows(df, "id", "t").orderBy("id", "pos").collect()]
    assert rows == [(1, "hello"), (1, "the"), (1, "caff"), (1, "bar"), (1, "open")]
    wide = [r["token"] for r in text.token_rows(df, "id", "t", ascii=False).orderBy("id", "pos").collect()]
    assert wide == ["hello", "the", "caffè", "bar", "open"]


def test_clean_rows_equal_anti_joins(spark):
    rows = spark.createDataFrame([(1, i, w) for i, w in enumerate("a a a b b c the the the the".split())], "id int, pos int, token string")
    counts = text.token_counts(rows)
    stop = spark.createDataFrame([("the",)], "token string")
    assert [r["token"] for r in text.clean_rows(rows, stop, counts, below=2).orderBy("pos").collect()] == ["a", "a", "a", "b", "b"]


def test_style_counts(spark):
    df = spark.createDataFrame([(1, "I am  HERE! :-) x\n5%")], "id int, t string")
    r = text.style_features(df, "id", "t").first()
    assert (r["use_cap"], r["use_exl"], r["use_double_space"], r["use_break"], r["use_digit"]) == (5, 1, 1, 1, 1)
    assert (r["use_i"], r["use_emotj"], r["use_symbol"], r["length"]) == (1, 1, 1, 20)
    empty = text.style_features(spark.createDataFrame([(1, "")], "id int, t string"), "id", "t").first()
    assert empty["cap_rate"] == 0 and empty["cap_len"] == 0
    assert len(df.columns) - 2 + len(text.style_features(df, "id", "t").columns) - 1 == 24


def test_normalise(spark):
    def n(t, **k):
        return one(spark, E.normalise(F.lit(t), **k)).strip()

    assert n("What's new? http://a.b/c I can't") == "what cannot"  # "new" falls to the interjection rule
    assert n("please") == "please"
    assert n("f o o bar", repair=True) == "foo bar"
    assert n("wo rd here", pairs=[("wo rd", "word")]) == "word here"
    assert n("caffè nero", ascii=False) == "caffè nero"


def test_stems(spark):
    want = {
        "running": "run", "ponies": "poni", "caresses": "caress", "relational": "relat", "conditional": "condit", "happily": "happili",
        "generously": "generous", "hopefulness": "hope", "national": "nation", "skies": "sky", "dying": "die", "hoping": "hope",
        "hopping": "hop", "agreed": "agre", "sky": "sky", "cats": "cat", "gas": "gas", "kiwis": "kiwi", "consigned": "consign",
        "consistently": "consist", "knightly": "knight", "inning": "inning", "innings": "inning", "community": "communiti",
        "organization": "organ", "triplicate": "triplic", "adjustment": "adjust", "rate": "rate", "roll": "roll", "by": "by",
        "enjoy": "enjoy", "crying": "cri", "tied": "tie", "died": "die", "luxuriated": "luxuri", "bled": "bled", "owed": "owe",
    }
    df = spark.createDataFrame([(w,) for w in want], "token string")
    got = {r["token"]: r["stem"] for r in text.stem_words(df, "token").collect()}
    assert got == want


def test_document_vectors_ignore_unknown_words(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a", "b"] * 5), (2, ["b", "a"] * 5)], "id int, words array<string>")
    model = text.fit_word2vec(docs, size=3, min_count=2, epochs=1)
    rows = spark.createDataFrame([(1, "a"), (1, "zzz")], "id int, token string")
    vec = {r["word"]: r["vector"] for r in model.getVectors().collect()}
    got = text.document_vectors(model, rows, "id", 3).first()
    assert got["known"] == 1 and all(math.isclose(a, b, rel_tol=1e-6) for a, b in zip(got["vector"], vec["a"]))


def test_term_matrix_rows_have_length_one(spark):
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    rows = spark.createDataFrame([(1, 0, "x"), (1, 1, "x"), (1, 2, "y")], "id int, pos int, token string")
    vocab = rows.select("token").distinct()
    long = text.term_matrix(docs, rows, "id", vocab).collect()
    assert math.isclose(sum(r["weight"] ** 2 for r in long if r["id"] == 1), 1.0)
    assert [r["token"] for r in long if r["id"] == 2] == [None]
    vec = {r["id"]: r["dtm"] for r in text.term_vectors(docs, rows, "id", vocab).collect()}
    assert math.isclose(vec[1].norm(2), 1.0) and vec[2].numNonzeros() == 0


# --- features, models ------------------------------------------------------------------------------


def test_frequency_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "t string")
    assert {r["t"]: r["i"] for r in features.frequency_index(df, "t", "i").collect()} == {"b": 0, "a": 1, "c": 2}


def test_nearest_centre(spark):
    rnd = random.Random(1)
    centres = [[rnd.random() for _ in range(4)] for _ in range(60)]
    df = spark.createDataFrame([[rnd.random() for _ in range(4)] for _ in range(200)], "a double, b double, c double, d double")
    cols = [F.col(c) for c in "abcd"]
    big = anomaly.assign_nearest(df, cols, centres).collect()
    for r in big:
        ds = [sum((x - y) ** 2 for x, y in zip((r["a"], r["b"], r["c"], r["d"]), c)) for c in centres]
        assert ds[r["cluster"]] == pytest.approx(min(ds)) and r["sqdist"] == pytest.approx(min(ds))


def test_nearest_centre_of_large_coordinates_does_not_depend_on_their_number(spark):
    df = spark.createDataFrame([(1e8 + 0.9, 1e8)], "a double, b double")
    cols, near = [F.col("a"), F.col("b")], [[1e8, 1e8], [1e8 + 1, 1e8]]
    for centres in (near, near + [[float(i), 0.0] for i in range(400)]):
        r = anomaly.assign_nearest(df, cols, centres).first()
        assert r["cluster"] == 1 and r["sqdist"] == pytest.approx(0.01, rel=1e-6)


def test_term_vectors_hold_any_number_of_terms(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("id"), F.col("id").cast("int").alias("pos"), F.format_string("w%05d", F.col("id") % 50_000).alias("token"))
    docs = spark.range(8)
    vectors = {r["id"]: r["dtm"] for r in text.term_vectors(docs, rows, "id", rows.select("token").distinct()).collect()}
    assert len(vectors) == 8 and all(v.size == 50_000 for v in vectors.values()) and vectors[7].numNonzeros() == 0
    for d in range(7):
        counts = {}
        for i in range(d, 60_000, 7):
            counts[i % 50_000] = counts.get(i % 50_000, 0) + 1
        norm = math.sqrt(sum(n * n for n in counts.values()))
        assert list(vectors[d].indices) == sorted(counts)
        assert all(math.isclose(v, counts[i] / norm) for i, v in zip(vectors[d].indices, vectors[d].values))


def test_split_needs_validation_rows(spark):
    with pytest.raises(ValueError):
        models.search_split(spark.range(1), None, [], None, ratio=1.0)


def test_forest_beats_majority(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 4 == 0).cast("double").alias("label"), F.array((F.col("id") % 4).cast("double"), (F.col("id") % 7).cast("double")).alias("x")
    )
    d = models.with_vector(df, "x")
    model = models.random_forest(numTrees=5, seed=1).fit(d.filter("id % 5 <> 0"))
    assert models.accuracy(model, d.filter("id % 5 = 0")) > 0.75


def test_hashed_split_is_a_partition(spark):
    df = spark.range(5000)
    parts = sampling.hashed_split(df, [(F.col("id"), 7919)], [0.7, 0.3], 4)
    n = [p.count() for p in parts]
    assert sum(n) == 5000 and 3300 < n[0] < 3700


def test_key_sample_is_repeatable(spark):
    df = spark.range(1000).toDF("k")
    a = {r["k"] for r in sampling.key_sample(df, "k", 50).collect()}
    assert len(a) == 50 and a == {r["k"] for r in sampling.key_sample(df.repartition(3), "k", 50).collect()}


@pytest.mark.parametrize("zoom", [4, 6])
def test_tiles_have_no_gaps_and_hold_the_cell_below_their_centre(spark, zoom):
    side = 2.0  # degrees; coarser than the cells of zoom 6
    cells = spark.range(200).select((F.col("id") % 20).cast("int").alias("col"), F.floor(F.col("id") / 20).cast("int").alias("row"))
    cells = cells.withColumns({"value": F.col("row") * 100.0 + F.col("col"), "lon": (F.col("col") + 0.5) * side - 7, "lat": F.lit(60.0) - (F.col("row") + 0.5) * side})
    got = {(r["col"], r["row"]): r["value"] for r in raster.tile_to_layout(cells, "lon", "lat", side, side, zoom).collect()}
    g, want = raster.world_grid(zoom), {}
    for c in range(256 * 2**zoom):
        lon = math.degrees((g.x0 + (c + 0.5) * g.size) / 6_378_137.0)
        if -7 <= lon < 33:
            for r in range(256 * 2**zoom // 2):
                lat = math.degrees(2 * math.atan(math.exp((g.y0 - (r + 0.5) * g.size) / 6_378_137.0)) - math.pi / 2)
                if 40 < lat <= 60:
                    want[c, r] = math.floor((60 - lat) / side) * 100.0 + math.floor((lon + 7) / side)
    assert got == want


def test_zoom_follows_from_the_cell_size():
    size = raster.world_grid(5).size
    assert [raster.layout_zoom(s) for s in (size, size * 0.95, size * 0.8, size * 1.2, 1e9)] == [5, 5, 6, 5, 0]


def test_hash_buckets_are_no_stripes(spark):
    h = S.hash_bucket([(F.col("id"), 7919)], 3, 10).alias("b")
    buckets = [r["b"] for r in spark.range(10_000).orderBy("id").select("id", h).collect()]
    assert all(900 < buckets.count(b) < 1_100 for b in range(10))
    # ids of one last digit fall into all buckets alike
    for digit in range(10):
        part = buckets[digit::10]
        assert all(60 < part.count(b) < 145 for b in range(10))
