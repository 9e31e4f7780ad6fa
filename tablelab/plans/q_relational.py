"""Registered queries: projections, joins, aggregates, windows, sorts, set operations, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.calendar import with_calendar
from ..operators import ordered as O
from ..operators import relational as R
from . import fixtures as X
from .fixtures import load

QUERIES: dict = {}
ORACLES: dict = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# --- calendar --------------------------------------------------------------------------------------

_CAL = """cal AS (SELECT *, strptime(Date_Time, '%m/%d/%Y %H:%M:%S') AS time FROM trips)"""


@register(f"""WITH {X.TRIPS_SQL}, {_CAL} SELECT CAST(dayofweek(time) + 1 AS INTEGER) AS weekday,
  CAST(hour(time) AS INTEGER) AS "hour", count(*) AS n FROM cal GROUP BY 1, 2""")
def trips_by_weekday_hour(spark: SparkSession, sf: str) -> DataFrame:
    t = with_calendar(X.trips(spark, sf), "Date_Time")
    return R.count_by(t, "weekday", "hour").orderBy("weekday", "hour")


@register(f"""WITH {X.TRIPS_SQL}, {_CAL} SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS n
  FROM cal GROUP BY 1""")
def trips_by_day(spark, sf):
    t = with_calendar(X.trips(spark, sf), "Date_Time")
    return R.count_by(t, "day").select(F.col("day").cast("string").alias("day"), "n").orderBy("day")


@register(f"""WITH {X.ORDER_TRIPS_SQL}, {_CAL} SELECT CAST(month(time) AS INTEGER) AS "month",
  CAST(day(time) AS INTEGER) AS dayofmonth, count(*) AS n FROM cal GROUP BY 1, 2""")
def trips_by_month_day(spark, sf):
    t = with_calendar(X.order_trips(spark, sf), "Date_Time")
    return R.count_by(t, "month", "dayofmonth").orderBy("month", "dayofmonth")


@register(f"""WITH {X.ORDER_TRIPS_SQL}, {_CAL} SELECT CAST(month(time) AS INTEGER) AS "month",
  CAST(dayofweek(time) + 1 AS INTEGER) AS weekday, count(*) AS n FROM cal GROUP BY 1, 2""")
def trips_by_month_weekday(spark, sf):
    t = with_calendar(X.order_trips(spark, sf), "Date_Time")
    return R.count_by(t, "month", "weekday").orderBy("month", "weekday")


@register(f"""WITH {X.ORDER_TRIPS_SQL}, {_CAL} SELECT CAST(month(time) AS INTEGER) AS "month", count(*) AS n
  FROM cal GROUP BY 1""")
def trips_by_month(spark, sf):
    t = with_calendar(X.order_trips(spark, sf), "Date_Time")
    return R.count_by(t, "month").orderBy(F.col("n").desc(), "month")


# --- projections, filters --------------------------------------------------------------------------


@register("""SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(floor(o_totalprice) AS BIGINT) AS whole_price,
  CAST(CAST(o_totalprice AS DECIMAL(24, 4)) AS VARCHAR) AS precise, o_totalprice / 1000 AS thousands FROM orders""")
def project_rename_cast(spark, sf):
    o = load(spark, sf, "orders").withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "user_id"})
    return o.select(
        "order_id",
        "user_id",
        F.floor("o_totalprice").cast("bigint").alias("whole_price"),
        F.col("o_totalprice").cast("decimal(24,4)").cast("string").alias("precise"),
        (F.col("o_totalprice") / 1000).alias("thousands"),
    )


@register("""SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def drop_columns(spark, sf):
    gone = ["l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
    return load(spark, sf, "lineitem").drop(*gone)


@register("""SELECT "column" FROM (VALUES ('l_linenumber'), ('l_quantity'), ('l_extendedprice'), ('l_discount'),
  ('l_tax'), ('cluster')) t("column") WHERE (SELECT count(*) FROM lineitem) > 0""")
def feature_column_list(spark, sf):
    """The numeric feature names of the table, taken from the data through a non-empty profile."""
    l = load(spark, sf, "lineitem")
    texts = [f.name for f in l.schema.fields if f.dataType.simpleString() in ("string", "timestamp_ntz", "timestamp")]
    names = R.feature_columns(l, exclude=[*texts, "l_orderkey", "l_partkey", "l_suppkey"], add=["cluster"])
    clustered = l.withColumn("cluster", F.lit(0)).agg(*[F.count(c).alias(c) for c in names])
    return R.long_from_wide(clustered, [], names, "column", "rows").filter("rows > 0").select("column")


@register(f"""WITH {X.COMMENTS_SQL} SELECT id, 'corpus' AS origin, CAST(toxic IS NOT NULL AS INTEGER) AS labelled
  FROM comments""")
def literal_and_flags(spark, sf):
    c = X.comments(spark, sf)
    return c.select("id", F.lit("corpus").alias("origin"), S.flag_present(F.col("toxic")).alias("labelled"))


@register("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def filter_equal(spark, sf):
    return load(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@register(f"""WITH {X.COMMENTS_SQL} SELECT id, toxic FROM comments WHERE toxic IS NULL OR (quality > 0 AND toxic < 1)""")
def filter_range_nulls(spark, sf):
    c = X.comments(spark, sf)
    return c.filter(F.col("toxic").isNull() | ((F.col("quality") > 0) & (F.col("toxic") < 1))).select("id", "toxic")


@register(f"""WITH {X.COMMENTS_SQL} SELECT split, lang, count(*) AS n FROM comments GROUP BY 1, 2""")
def mask_split(spark, sf):
    """Both halves of a frame split by its flag column, each counted."""
    c = X.comments(spark, sf)
    train, test = c.filter("split = 'train'"), c.filter("split = 'test'")
    return R.union_positional([R.count_by(train, "split", "lang"), R.count_by(test, "split", "lang")])


@register("""WITH d AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
  FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, o_orderpriority, CAST(code AS INTEGER) AS code FROM orders JOIN d ON o_orderpriority = v""")
def factor_codes(spark, sf):
    """Alphabetic level numbers of a text column."""
    from ..operators.features import factor_index

    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return factor_index(o, "o_orderpriority", "code")


@register("""SELECT d.doc_id, n_chars, toxic, quality FROM documents d JOIN labels USING (doc_id)""")
def column_bind(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "n_chars")
    return d.join(load(spark, sf, "labels"), "doc_id").select("doc_id", "n_chars", "toxic", "quality")


# --- joins -----------------------------------------------------------------------------------------


@register("""SELECT p_partkey, p_name FROM part WHERE p_partkey = 7""")
def point_lookup(spark, sf):
    return R.point_lookup(load(spark, sf, "part"), "p_partkey", 7).select("p_partkey", "p_name")


_POSNEG = f"""{X.RATINGS_SQL},
pos AS (SELECT "user", item, rating FROM split WHERE valid), neg AS (SELECT "user", item, rating FROM split WHERE NOT valid)"""


def _halves(spark, sf):
    from ..operators.recommend import build_ratings, hash_split

    r = build_ratings(X.raw_listens(spark, sf), X.aliases(spark, sf))
    return hash_split(r)


@register(f"""WITH {_POSNEG}, p AS (SELECT "user", count(*) AS n_pos, CAST(max(rating) AS DOUBLE) AS best_pos FROM pos GROUP BY 1),
n AS (SELECT "user", count(*) AS n_neg, CAST(max(rating) AS DOUBLE) AS best_neg FROM neg GROUP BY 1)
SELECT * FROM p JOIN n USING ("user")""")
def co_join_by_key(spark, sf):
    neg, pos = _halves(spark, sf)
    return R.co_group_summaries(
        pos,
        neg,
        ["user"],
        {"n_pos": F.count("*"), "best_pos": F.max("rating")},
        {"n_neg": F.count("*"), "best_neg": F.max("rating")},
    )


@register(f"""WITH {_POSNEG} SELECT "user", CAST(count(*) FILTER (pos.rating > neg.rating) AS BIGINT) AS correct,
  count(*) AS total FROM pos JOIN neg USING ("user") GROUP BY 1""")
def pair_compare_by_key(spark, sf):
    """Per user, pairs won by the positive side; counted by running totals, no pair is ever formed."""
    from ..operators.evaluate import pair_wins

    neg, pos = _halves(spark, sf)
    scored = pos.withColumn("positive", F.lit(True)).union(neg.withColumn("positive", F.lit(False)))
    return pair_wins(scored, ["user"], "rating", "positive").select("user", "correct", "total")


@register("""SELECT o_custkey AS "key", o_orderkey AS id_x, avg_x, avg_y FROM
  (SELECT o_custkey, o_orderkey, o_totalprice AS avg_x FROM orders) LEFT JOIN
  (SELECT c_custkey, c_acctbal AS avg_y FROM customer) ON o_custkey = c_custkey""")
def suffix_safe_join(spark, sf):
    a = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("avg")
    )
    b = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("id"), F.col("c_acctbal").alias("avg")
    )
    return R.join_suffixed(a, b, ["key"], "left").drop("id_y")


@register("""SELECT o.o_orderkey, o.o_totalprice, c.c_mktsegment, n.n_name FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def left_dimension_joins(spark, sf):
    o, c, n = (load(spark, sf, t) for t in ("orders", "customer", "nation"))
    return (
        o.join(c, o.o_custkey == c.c_custkey, "left")
        .join(n, c.c_nationkey == n.n_nationkey, "left")
        .select("o_orderkey", "o_totalprice", "c_mktsegment", "n_name")
    )


# --- aggregates ------------------------------------------------------------------------------------


@register("""SELECT count(*) AS n FROM lineitem""")
def row_count(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@register("""SELECT l_partkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1""")
def sum_by_key(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total"))


@register("""SELECT CAST(sum(toxic) AS BIGINT) AS toxic, CAST(sum(quality) AS BIGINT) AS quality, count(*) AS total FROM labels""")
def multi_sum(spark, sf):
    l = load(spark, sf, "labels")
    return l.agg(*[F.sum(c).alias(c) for c in ("toxic", "quality")], F.count("*").alias("total"))


@register("""SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1""")
def min_max(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@register("""SELECT l_suppkey, round(avg(l_quantity), 6) AS mean_quantity FROM lineitem GROUP BY 1""")
def avg_by_key(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.avg("l_quantity"), 6).alias("mean_quantity"))


@register("""SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT x) + max(CAST(x IS NULL AS INTEGER)) AS marked
  FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS x FROM orders) GROUP BY 1""")
def distinct_counts(spark, sf):
    o = load(spark, sf, "orders").withColumn("x", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return o.groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"), R.distinct_with_null(F.col("x")).alias("marked")
    )


@register("""SELECT o_custkey, round(count(*) / nullif(count(DISTINCT o_orderstatus), 0), 6) AS per_status FROM orders GROUP BY 1""")
def ratio_of_aggs(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.round(S.ratio(F.count("*"), F.count_distinct("o_orderstatus"), None), 6).alias("per_status")
    )


@register("""SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) AS n FROM lineitem GROUP BY 1""")
def conditional_count(spark, sf):
    l = load(spark, sf, "lineitem")
    return l.groupBy("l_suppkey").agg(
        R.conditional_count(F.col("l_returnflag") == "R").alias("returned"), F.count("*").alias("n")
    )


@register("""SELECT l_suppkey, count(*) AS labels, CAST(max(n) AS BIGINT) AS biggest, CAST(sum(n) AS BIGINT) AS size
  FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def grouped_reduce(spark, sf):
    """Per-group label statistics in two aggregation levels instead of collecting the group."""
    two = R.count_by(load(spark, sf, "lineitem"), "l_suppkey", "l_returnflag")
    return two.groupBy("l_suppkey").agg(
        F.count("*").alias("labels"), F.max("n").alias("biggest"), F.sum("n").alias("size")
    )


@register("""SELECT round(avg(m), 6) AS mean_score FROM (SELECT o_custkey, avg(o_totalprice) AS m FROM orders GROUP BY 1)""")
def mean_of_group_scores(spark, sf):
    m = R.mean_of_groups(load(spark, sf, "orders"), ["o_custkey"], F.avg("o_totalprice"))
    return m.select(F.round("mean_score", 6).alias("mean_score"))


@register("""SELECT value, count(*) AS n FROM (SELECT l_quantity AS value FROM lineitem UNION ALL
  SELECT l_discount FROM lineitem UNION ALL SELECT l_tax FROM lineitem) GROUP BY 1""")
def value_frequency(spark, sf):
    return R.value_frequency(load(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


@register("""SELECT 'o_totalprice' AS "column", round(min(o_totalprice), 6) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
  round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(avg(o_totalprice), 6) AS mean,
  round(quantile_cont(o_totalprice, 0.75), 6) AS q3, round(max(o_totalprice), 6) AS max FROM orders
UNION ALL SELECT 'o_custkey', min(o_custkey), quantile_cont(o_custkey, 0.25), quantile_cont(o_custkey, 0.5),
  round(avg(o_custkey), 6), quantile_cont(o_custkey, 0.75), max(o_custkey) FROM orders""")
def quartiles(spark, sf):
    q = R.five_numbers(load(spark, sf, "orders"), ["o_totalprice", "o_custkey"])
    return q.select("column", *[F.round(c, 6).alias(c) for c in q.columns if c != "column"])


_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
  CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, {m} AS mean FROM customer"""
    for c, t, m in (
        ("c_custkey", "bigint", "round(avg(c_custkey), 6)"),
        ("c_name", "string", "CAST(NULL AS DOUBLE)"),
        ("c_nationkey", "int", "round(avg(c_nationkey), 6)"),
        ("c_acctbal", "double", "round(avg(c_acctbal), 6)"),
        ("c_mktsegment", "string", "CAST(NULL AS DOUBLE)"),
    )
)


@register(_PROFILE)
def profile_table(spark, sf):
    return R.profile(load(spark, sf, "customer")).withColumn("mean", F.round("mean", 6))


# --- windows, sorts, limits ------------------------------------------------------------------------


@register("""SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS wc FROM events""")
def count_on_each_row(spark, sf):
    return R.with_group_count(load(spark, sf, "events"), ["event_type"]).select("event_id", "event_type", "wc")


@register("""SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_number,
  count(*) OVER (PARTITION BY o_custkey) - row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + 1 AS orders_ago FROM orders""")
def orders_ago(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    numbered = O.row_positions(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "order_number")
    return R.with_group_max(numbered, ["o_custkey"], "order_number", "order_max").select(
        "o_orderkey", "o_custkey", "order_number", (F.col("order_max") - F.col("order_number") + 1).alias("orders_ago")
    )


@register("""SELECT * FROM (SELECT l_suppkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS r FROM lineitem GROUP BY 1)
  WHERE r <= 10""".replace("SELECT *", "SELECT l_suppkey, n", 1))
def top_with_ties(spark, sf):
    return O.top_with_ties(R.count_by(load(spark, sf, "lineitem"), "l_suppkey"), "n", 10)


@register("""SELECT l_partkey, n FROM (SELECT l_partkey, count(*) AS n, rank() OVER (ORDER BY count(*)) AS r FROM lineitem GROUP BY 1)
  WHERE r <= 10""")
def bottom_with_ties(spark, sf):
    return O.top_with_ties(R.count_by(load(spark, sf, "lineitem"), "l_partkey"), "n", 10, largest=False)


@register("""SELECT event_type, user_id, n FROM (SELECT event_type, user_id, count(*) AS n,
  rank() OVER (PARTITION BY event_type ORDER BY count(*) DESC) AS r FROM events GROUP BY 1, 2) WHERE r <= 3""")
def top_per_group(spark, sf):
    return O.top_with_ties(R.count_by(load(spark, sf, "events"), "event_type", "user_id"), "n", 3, ["event_type"])


@register("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def limit_total_order(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@register("""SELECT DISTINCT o_custkey FROM orders ORDER BY 1 LIMIT 100""")
def distinct_key_sample(spark, sf):
    return load(spark, sf, "orders").select("o_custkey").distinct().orderBy("o_custkey").limit(100)


@register("""SELECT min(o_totalprice) AS threshold FROM (SELECT o_totalprice FROM orders ORDER BY 1 DESC LIMIT 100)""")
def kth_largest_value(spark, sf):
    return O.kth_largest(load(spark, sf, "orders"), "o_totalprice", 100)


# --- set operations --------------------------------------------------------------------------------


@register("""SELECT CAST(month(o_orderdate) AS INTEGER) AS "month", count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1997)
  AND month(o_orderdate) BETWEEN 4 AND 7 GROUP BY 1""")
def month_union_positional(spark, sf):
    o = load(spark, sf, "orders").withColumn("month", F.month("o_orderdate")).filter(F.year("o_orderdate").isin(1996, 1997))
    months = [o.filter(F.col("month") == m).select("month", "o_orderkey") for m in (4, 5, 6, 7)]
    return R.count_by(R.union_positional(months), "month")


@register("""SELECT 'train' AS split, doc_id, toxic, CAST(NULL AS VARCHAR) AS lang FROM labels
  UNION ALL SELECT 'test', doc_id, NULL, lang FROM documents""")
def train_test_union_by_name(spark, sf):
    train = load(spark, sf, "labels").select("doc_id", "toxic").withColumn("split", F.lit("train"))
    test = load(spark, sf, "documents").select("doc_id", "lang").withColumn("split", F.lit("test"))
    return R.union_by_name([train, test])


_TERMS = """terms AS (SELECT unnest(string_split(lower(p_name), ' ')) AS term FROM part), more AS
  (SELECT unnest(string_split(lower(n_name), ' ')) AS term FROM nation)"""


def _terms(spark, sf):
    parts = load(spark, sf, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("term"))
    nations = load(spark, sf, "nation").select(F.explode(F.split(F.lower("n_name"), " ")).alias("term"))
    return parts, nations


@register(f"""WITH {_TERMS} SELECT term FROM terms UNION SELECT term FROM more""")
def terms_union_distinct(spark, sf):
    a, b = _terms(spark, sf)
    return a.union(b).distinct()


@register(f"""WITH {_TERMS} SELECT term, count(*) AS n FROM (SELECT term FROM terms UNION ALL SELECT term FROM more) GROUP BY 1""")
def terms_bag_concat(spark, sf):
    a, b = _terms(spark, sf)
    return R.count_by(a.union(b), "term")


@register("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def rows_minus_keys(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    seen = load(spark, sf, "events").select("user_id").distinct()
    return R.drop_listed(o, "o_custkey", seen).select("o_orderkey", "o_custkey")


@register("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)""")
def rows_of_listed_keys(spark, sf):
    from ..session import small_side

    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    seen = small_side(load(spark, sf, "events").select("user_id").distinct())
    return R.keep_listed(o, "o_custkey", seen).select("o_orderkey", "o_custkey")


# --- scalars ---------------------------------------------------------------------------------------


@register("""SELECT doc_id, string_split(text, ' ')[1] AS first_word, string_split(text, ' ')[3] AS third_word,
  CASE WHEN instr(text, '.') > 0 THEN trim(substr(text, instr(text, '.') + 1), ' ') ELSE '' END AS rest,
  string_split(text, '.')[1] AS head FROM documents""")
def string_split_parts(spark, sf):
    t = F.col("text")
    first, _, third = S.split_fields(t, " ", "first_word", "second_word", "third_word")
    return load(spark, sf, "documents").select(
        "doc_id", first, third, S.after_first(t, ".").alias("rest"), S.before_first(t, ".").alias("head")
    )


@register("""SELECT doc_id, lower(lang) AS lang, trim(lower(source), ' ') AS source, length(text) AS n FROM documents""")
def string_lower_trim_len(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", F.lower("lang").alias("lang"), F.trim(F.lower("source")).alias("source"),
        F.char_length("text").cast("bigint").alias("n"),
    )


@register("""SELECT doc_id, len(regexp_extract_all(text, '[A-Z]')) AS caps, len(regexp_extract_all(text, '[0-9]')) AS digits,
  len(regexp_extract_all(text, '\\w+')) AS words FROM documents""")
def regex_counts(spark, sf):
    t = F.col("text")
    return load(spark, sf, "documents").select(
        "doc_id",
        *[S.count_regex(t, p).cast("bigint").alias(n) for n, p in (("caps", "[A-Z]"), ("digits", "[0-9]"), ("words", r"\w+"))],
    )


@register("""SELECT doc_id, (length(text) - length(replace(text, '!', ''))) AS bangs,
  (length(text) - length(replace(text, '  ', ''))) // 2 AS doubles, (length(text) - length(replace(text, '?', ''))) AS asks
  FROM documents""")
def literal_counts(spark, sf):
    t = F.col("text")
    return load(spark, sf, "documents").select(
        "doc_id",
        *[S.count_literal(t, p).cast("bigint").alias(n) for n, p in (("bangs", "!"), ("doubles", "  "), ("asks", "?"))],
    )


@register("""SELECT doc_id, regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), 'th', 'TH', 'g') AS text FROM documents""")
def regex_replace_all(spark, sf):
    return load(spark, sf, "documents").select(
        "doc_id", S.replace_all(F.col("text"), [("[0-9]+", "#"), ("th", "TH")]).alias("text")
    )


@register("""SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[0-9]')""")
def regex_not_match(spark, sf):
    return load(spark, sf, "documents").filter(S.lacks_match(F.col("text"), "[0-9]")).select("doc_id")


@register("""SELECT c_custkey, concat_ws('/', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS label,
  '04 ' || CAST(c_nationkey AS VARCHAR) AS tagged FROM customer""")
def string_assembly(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey",
        F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("label"),
        F.concat_ws(" ", F.lit("04"), F.col("c_nationkey").cast("string")).alias("tagged"),
    )


@register("""SELECT p_partkey, round(pow(p_size, 2), 6) AS squared, round(sqrt(p_size), 6) AS root, round(ln(p_retailprice), 6) AS log_price,
  round(p_retailprice / 7, 2) AS rounded, round(coalesce(p_size / nullif(p_partkey, 0), 0), 6) AS safe FROM part""")
def math_functions(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey",
        F.round(F.pow("p_size", F.lit(2)), 6).alias("squared"),
        F.round(F.sqrt("p_size"), 6).alias("root"),
        F.round(F.ln("p_retailprice"), 6).alias("log_price"),
        F.round(F.col("p_retailprice") / 7, 2).alias("rounded"),
        F.round(S.ratio(F.col("p_size"), F.col("p_partkey")), 6).alias("safe"),
    )


@register("""WITH c AS (SELECT list(m ORDER BY i) AS centre FROM (SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m
  FROM embeddings, range(1, 65) r(i) GROUP BY i))
SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: pow(CAST(embedding[i] AS DOUBLE) - centre[i], 2))), 6) AS sqdist
FROM embeddings, c""")
def vector_sqdist(spark, sf):
    """Squared distance of every vector to the mean vector of the table."""
    from ..operators.features import mean_vector

    e = load(spark, sf, "embeddings")
    centre = mean_vector(e, "embedding", 64)
    return e.select("vec_id", F.round(S.squared_distance(F.col("embedding"), centre), 6).alias("sqdist"))


@register("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE -1 END AS idx FROM orders""")
def array_index_of(spark, sf):
    o = load(spark, sf, "orders")
    hot = [(F.col("o_orderstatus") == v).cast("double") for v in ("F", "O")]
    return o.select("o_orderkey", S.index_of_one(hot).alias("idx"))


@register("""SELECT event_id, TRY_CAST(replace(props->>'$.k', '7', 'x') AS INTEGER) AS k FROM events
  WHERE TRY_CAST(replace(props->>'$.k', '7', 'x') AS INTEGER) IS NOT NULL""")
def safe_parse(spark, sf):
    """Numbers from text, every 7 made unreadable first; unreadable rows are dropped."""
    raw = F.replace(F.get_json_object("props", "$.k"), F.lit("7"), F.lit("x"))
    return load(spark, sf, "events").select("event_id", S.safe_int(raw).alias("k")).filter("k is not null")


@register("""SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events""")
def json_props(spark, sf):
    parsed = F.from_json("props", "k int")
    return load(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@register("""SELECT vec_id, i, round(CAST(embedding[i] AS DOUBLE) / 255, 9) AS v FROM embeddings, range(1, 65) r(i)""")
def scale_flatten(spark, sf):
    """Rows of 8 flattened to one array of 64, divided by 255, listed by position."""
    e = load(spark, sf, "embeddings")
    rows = F.array(*[F.slice("embedding", 8 * k + 1, 8) for k in range(8)])
    flat = S.scale_array(F.flatten(rows), 255)
    return e.select("vec_id", F.posexplode(flat).alias("i", "v")).select(
        "vec_id", (F.col("i") + 1).cast("bigint").alias("i"), F.round("v", 9).alias("v")
    )


@register("""SELECT lower(w) AS word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
  WHERE w <> '' GROUP BY 1""")
def word_count(spark, sf):
    from ..operators.text import word_count as count_words

    return count_words(load(spark, sf, "documents").select(F.lower("text").alias("value")), "value")
