"""The analyses' inputs as views over the given tables, each with the same view as SQL text.

All mappings are whole-table and deterministic integer arithmetic, so they grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import previous_values, row_positions
from ..session import dealt, stage


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all task slots when the scan has fewer partitions than there are slots; with
    enough of them (any large table) no shuffle is added."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


# --- trips -----------------------------------------------------------------------------------------


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(
        F.date_format("ts", "M/d/yyyy H:mm:ss").alias("Date_Time"),
        (F.lit(40.5) + (F.col("user_id") * 37 % 1000) / 2000.0).alias("Lat"),
        (F.lit(-74.2) + (F.col("user_id") * 61 % 1000) / 2000.0).alias("Lon"),
        F.col("event_type").alias("Base"),
    )


TRIPS_SQL = """trips AS (SELECT strftime(ts, '%-m/%-d/%Y %-H:%M:%S') AS Date_Time,
  40.5 + (user_id * 37 % 1000) / 2000.0 AS Lat, -74.2 + (user_id * 61 % 1000) / 2000.0 AS Lon,
  event_type AS Base FROM events)"""


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as trip texts: these cover several years, so month-level keys vary."""
    o = load(spark, sf_dir, "orders")
    return o.select(F.date_format("o_orderdate", "M/d/yyyy H:mm:ss").alias("Date_Time"), F.col("o_orderpriority").alias("Base"))


ORDER_TRIPS_SQL = """trips AS (SELECT strftime(o_orderdate, '%-m/%-d/%Y %-H:%M:%S') AS Date_Time,
  o_orderpriority AS Base FROM orders)"""


# --- music ratings ---------------------------------------------------------------------------------


def raw_listens(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        F.col("l_quantity").cast("int").alias("count"),
    )


LISTENS_SQL = """listens AS (SELECT CAST(o_custkey AS INTEGER) AS "user", CAST(l_partkey AS INTEGER) AS item,
  CAST(l_quantity AS INTEGER) AS "count" FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").filter("p_partkey % 10 = 7")
    return p.select(F.col("p_partkey").cast("int").alias("bad_id"), (F.col("p_partkey") - 7).cast("int").alias("good_id"))


ALIASES_SQL = """aliases AS (SELECT CAST(p_partkey AS INTEGER) AS bad_id, CAST(p_partkey - 7 AS INTEGER) AS good_id
  FROM part WHERE p_partkey % 10 = 7)"""


def hash_sql(total: str, modulus: int) -> str:
    """The bucket of a weighted sum of keys: a factor and a square modulo the prime 2**31 - 1."""
    mixed = f"((({total}) % 2147483647) * 1103515245::BIGINT % 2147483647)"
    return f"({mixed} * {mixed} % 2147483647 % {modulus})"


def artist_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("name"))


NAMES_SQL = """names AS (SELECT CAST(p_partkey AS INTEGER) AS id, concat_ws(' ', p_name, p_brand) AS name FROM part)"""

RATINGS_SQL = f"""{LISTENS_SQL}, {ALIASES_SQL},
ratings AS (SELECT "user", coalesce(good_id, item) AS item, CAST(sum("count") AS DOUBLE) AS rating
  FROM listens LEFT JOIN aliases ON item = bad_id GROUP BY 1, 2),
split AS (SELECT *, {hash_sql('"user" * 7919::BIGINT + item * 104729::BIGINT', 10)} >= 7 AS valid FROM ratings)"""


# --- basket ----------------------------------------------------------------------------------------


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("product_id"),
        F.col("s_name").alias("product_name"),
        F.col("s_nationkey").alias("aisle_id"),
        (F.col("s_suppkey") % 5).cast("int").alias("department_id"),
    )


def aisles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("aisle_id"), F.col("n_name").alias("aisle"))


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("department_id"), F.col("r_name").alias("department")
    )


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered per user as a table, with the gap in days to the order before and the evaluation set."""
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("day")
    )
    numbered = row_positions(o, ["user_id"], ["day", "order_id"], "order_number")
    numbered = stage(numbered, "numbered")
    gaps = previous_values(numbered, ["user_id"], "order_number", {"before": "day"})
    last = o.groupBy("user_id").agg(F.count("*").alias("last_number"))
    held = F.when(F.col("user_id") % 3 != 0, "train").otherwise("test")
    out = gaps.join(last, "user_id").select(
        "order_id",
        "user_id",
        F.when(F.col("order_number") == F.col("last_number"), held).otherwise("prior").alias("eval_set"),
        "order_number",
        F.dayofweek("day").alias("order_dow"),
        (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
        F.datediff("day", "before").alias("days_since_prior_order"),
    )
    return stage(out, "orders")


def order_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """One row per order and product, as a table; ``reordered`` marks a product the user had in an earlier order."""
    l = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("product_id"), "l_linenumber"
    )
    n = l.count()
    # lines move twice: by order, for the grouping and the join, and by user and product
    lines = dealt(l.repartition("order_id"), n, "order_id").groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("add_to_cart_order"))
    keyed = lines.join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    pair = Window.partitionBy("user_id", "product_id")  # as many rows as the user has orders of the product
    first = dealt(keyed, n, "user_id", "product_id").withColumn("first_number", F.min("order_number").over(pair))
    out = first.select(
        "order_id",
        "product_id",
        "add_to_cart_order",
        (F.col("order_number") > F.col("first_number")).cast("int").alias("reordered"),
        "eval_set",
    )
    return stage(out, "lines")


BASKET_SQL = """products AS (SELECT s_suppkey AS product_id, s_name AS product_name, s_nationkey AS aisle_id,
  CAST(s_suppkey % 5 AS INTEGER) AS department_id FROM supplier),
ord0 AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS day,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
  count(*) OVER (PARTITION BY o_custkey) AS last_number,
  lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
ord AS (SELECT order_id, user_id, CASE WHEN order_number < last_number THEN 'prior' WHEN user_id % 3 <> 0 THEN 'train'
  ELSE 'test' END AS eval_set, order_number, CAST(dayofweek(day) + 1 AS INTEGER) AS order_dow, CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
  CAST(date_diff('day', before, day) AS INTEGER) AS days_since_prior_order FROM ord0),
lines0 AS (SELECT l_orderkey AS order_id, l_suppkey AS product_id, min(l_linenumber) AS add_to_cart_order
  FROM lineitem GROUP BY 1, 2),
lines1 AS (SELECT lines0.*, eval_set, order_number,
  min(order_number) OVER (PARTITION BY user_id, product_id) AS first_number FROM lines0 JOIN ord USING (order_id)),
lines AS (SELECT order_id, product_id, add_to_cart_order, CAST(order_number > first_number AS INTEGER) AS reordered,
  eval_set FROM lines1),
opp0 AS (SELECT l.order_id, l.product_id, add_to_cart_order, reordered, product_name, n_name AS aisle,
  r_name AS department, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order
  FROM lines l LEFT JOIN products USING (product_id) LEFT JOIN nation ON n_nationkey = aisle_id
  LEFT JOIN region ON r_regionkey = department_id LEFT JOIN ord o ON o.order_id = l.order_id
  WHERE l.eval_set = 'prior'),
opp AS (SELECT *, max(order_number) OVER u AS order_max, count(*) OVER u AS purch_count,
  max(order_number) OVER u - order_number + 1 AS orders_ago FROM opp0 WINDOW u AS (PARTITION BY user_id)),
upl AS (SELECT user_id, product_id, max(order_number) AS last_order_number, count(*) AS purch_count,
  avg(order_hour_of_day) AS avg_hour, count(*) FILTER (reordered = 1) AS reordered_count,
  count(*) FILTER (reordered = 1) / count(*) AS reorder_rate FROM opp GROUP BY 1, 2),
summ AS (SELECT user_id, count(*) AS user_total_products_ordered_hist, count(DISTINCT product_name) AS uniq_prod,
  count(DISTINCT aisle) AS uniq_aisle, count(DISTINCT department) AS uniq_dept, max(order_number) AS prior_orders,
  avg(order_hour_of_day) AS avg_hour, avg(days_since_prior_order) AS average_days_between_orders,
  count(DISTINCT order_number) AS total_order, count(*) / count(DISTINCT order_number) AS average_basket
  FROM opp GROUP BY 1),
recency AS (SELECT user_id, product_id, count(*) AS prior_prod_cnt, min(orders_ago) AS last_purchased_orders_ago,
  max(orders_ago) AS first_purchased_orders_ago, avg(days_since_prior_order) AS average_days_between_ord_prods
  FROM opp GROUP BY 1, 2)"""


# --- comments --------------------------------------------------------------------------------------


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = spread(load(spark, sf_dir, "documents")), load(spark, sf_dir, "labels")
    return d.join(l, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("comment_text"),
        "lang",
        "toxic",
        "quality",
        F.when(F.col("toxic").isNull(), "test").otherwise("train").alias("split"),
    )


COMMENTS_SQL = """comments AS (SELECT d.doc_id AS id, d.text AS comment_text, lang, toxic, quality,
  CASE WHEN toxic IS NULL THEN 'test' ELSE 'train' END AS split FROM documents d LEFT JOIN labels l USING (doc_id))"""


# --- network traffic -------------------------------------------------------------------------------

TRAFFIC_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRAFFIC_STRINGS = ["l_linestatus", "o_orderpriority"]


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = spread(load(spark, sf_dir, "lineitem")), load(spark, sf_dir, "orders")
    j = l.join(o, l.l_orderkey == o.o_orderkey)
    return j.select(*TRAFFIC_NUMERIC, *TRAFFIC_STRINGS, F.col("l_returnflag").alias("label"))


# --- weather stations and sensors ------------------------------------------------------------------


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    kind = F.element_at(F.array(F.lit("Temperatura"), F.lit("Pioggia"), F.lit("Vento")), (F.col("c_custkey") % 3 + 1).cast("int"))
    return c.select(
        F.col("c_custkey").cast("string").alias("IdSensore"),
        F.col("c_name").alias("NomeStazione"),
        kind.alias("Tipologia"),
        (F.lit(8.70) + (F.col("c_custkey") * 37 % 1000) * 0.0016).alias("lng"),
        (F.lit(45.15) + (F.col("c_custkey") * 61 % 1000) * 0.00095).alias("lat"),
    )


STATIONS_SQL = """stations AS (SELECT CAST(c_custkey AS VARCHAR) AS IdSensore, c_name AS NomeStazione,
  (['Temperatura', 'Pioggia', 'Vento'])[c_custkey % 3 + 1] AS Tipologia,
  8.70::DOUBLE + (c_custkey * 37 % 1000) * 0.0016::DOUBLE AS lng,
  45.15::DOUBLE + (c_custkey * 61 % 1000) * 0.00095::DOUBLE AS lat FROM customer)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("IdSensore"),
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("Data"),
        F.col("value").cast("string").alias("Valore"),
    )


READINGS_SQL = """readings AS (SELECT CAST(user_id AS VARCHAR) AS IdSensore,
  strftime(ts, '%d/%m/%Y %H:%M:%S') AS Data, CAST(value AS VARCHAR) AS Valore FROM events)"""

SENSOR_BLOCK = 1024


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested sensor documents. One document holds the readings of one user in one block of
    consecutive event ids, so its value list has at most ``SENSOR_BLOCK`` entries."""
    e, c = load(spark, sf_dir, "events"), load(spark, sf_dir, "customer")
    kind = F.col("user_id") % 3
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("event_id", "value"))), lambda s: s["value"])
    docs = e.groupBy("user_id", F.floor(F.col("event_id") / SENSOR_BLOCK).cast("long").alias("block")).agg(
        pairs.alias("v"), F.sum("value").alias("s"), F.max("value").alias("m")
    )
    place = c.select(
        F.col("c_custkey").alias("user_id"),
        F.array(
            F.lit(8.70) + (F.col("c_custkey") * 37 % 1000) * 0.0016,
            F.lit(45.15) + (F.col("c_custkey") * 61 % 1000) * 0.00095,
        ).alias("location"),
    )
    return docs.join(place, "user_id").select(
        F.concat_ws("-", "user_id", "block").alias("_id"),
        F.struct("location").alias("place"),
        F.struct(
            F.struct(
                F.when(kind == 0, F.array(F.lit("temperature"))).otherwise(F.array(F.lit("other"))).alias("type"),
                F.struct(F.col("v").alias("value")).alias("res"),
                F.when(kind == 1, F.col("m")).alias("rain_60min"),
                F.when(kind == 1, F.col("m") - 20.0).alias("rain_24h"),
                F.when(kind == 2, F.col("m")).alias("wind_strength"),
            ).alias("measures")
        ).alias("measures"),
    )


SENSOR_SCHEMA = (
    "_id string, place struct<location: array<double>>, measures struct<measures: struct<type: array<string>, "
    "res: struct<value: array<double>>, rain_60min: double, rain_24h: double, wind_strength: double>>"
)

SENSORS_SQL = f"""place AS (SELECT c_custkey AS user_id, 8.70::DOUBLE + (c_custkey * 37 % 1000) * 0.0016::DOUBLE AS lng,
  45.15::DOUBLE + (c_custkey * 61 % 1000) * 0.00095::DOUBLE AS lat FROM customer),
docs AS (SELECT user_id, event_id // {SENSOR_BLOCK} AS block, list(value ORDER BY event_id) AS v, max(value) AS m
  FROM events GROUP BY 1, 2),
sensors AS (SELECT user_id || '-' || block AS id, lng, lat, v,
  CASE user_id % 3 WHEN 0 THEN 'temperature' WHEN 1 THEN 'rain' ELSE 'wind' END AS sensor_type,
  CASE WHEN user_id % 3 = 1 THEN m - 20.0 END AS rain_24h FROM docs JOIN place USING (user_id))"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON polygon per nation: overlapping hexagons on a 5 x 5 grid over the station box."""
    n = load(spark, sf_dir, "nation")
    x = F.lit(8.86) + (F.col("n_nationkey") % 5) * 0.32
    y = F.lit(45.245) + F.floor(F.col("n_nationkey") / 5) * 0.19
    shape = [(-0.2, 0.0), (-0.1, -0.11), (0.1, -0.11), (0.2, 0.0), (0.1, 0.11), (-0.1, 0.11), (-0.2, 0.0)]
    ring = F.array(*[F.array(x + dx, y + dy) for dx, dy in shape])
    return n.select(
        F.col("n_name").alias("NIL"),
        F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))).alias("geometry"),
    )


def service_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON area per supplier: a square with a hole, or for every third supplier two triangles."""
    s = load(spark, sf_dir, "supplier")
    x, y = (F.col("s_suppkey") * 53 % 1000) * 0.25, (F.col("s_suppkey") * 29 % 1000) * 0.125

    def ring(*corners):
        return F.array(*[F.array(x + dx, y + dy) for dx, dy in corners])

    square = F.array(ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), ring((1, 1), (2, 1), (2, 2), (1, 2), (1, 1)))
    parts = F.array(F.array(ring((0, 0), (1, 0), (1, 1), (0, 0))), F.array(ring((8, 8), (9, 8), (9, 9), (8, 8))))
    polygon = F.to_json(F.struct(F.lit("Polygon").alias("type"), square.alias("coordinates")))
    multi = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates")))
    return s.select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, multi).otherwise(polygon).alias("geometry"))


AREAS_SQL = """areas AS (SELECT s_name AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
  CASE WHEN s_suppkey % 3 = 0 THEN 6 ELSE 8 END::BIGINT AS edges, (s_suppkey * 53 % 1000) * 0.25::DOUBLE AS xmin,
  (s_suppkey * 53 % 1000) * 0.25::DOUBLE + CASE WHEN s_suppkey % 3 = 0 THEN 9 ELSE 4 END AS xmax,
  (s_suppkey * 29 % 1000) * 0.125::DOUBLE AS ymin,
  (s_suppkey * 29 % 1000) * 0.125::DOUBLE + CASE WHEN s_suppkey % 3 = 0 THEN 9 ELSE 4 END AS ymax FROM supplier)"""


ZONES_SQL = """corner AS (SELECT * FROM (VALUES (0, -0.2, 0.0), (1, -0.1, -0.11), (2, 0.1, -0.11), (3, 0.2, 0.0),
  (4, 0.1, 0.11), (5, -0.1, 0.11), (6, -0.2, 0.0)) t(i, dx, dy)),
ring AS (SELECT n_name AS zone, i, 8.86::DOUBLE + (n_nationkey % 5) * 0.32::DOUBLE + dx::DOUBLE AS x,
  45.245::DOUBLE + (n_nationkey // 5) * 0.19::DOUBLE + dy::DOUBLE AS y FROM nation CROSS JOIN corner),
zone_edges AS (SELECT a.zone, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM ring a JOIN ring b ON a.zone = b.zone AND b.i = a.i + 1)"""


# --- raster ----------------------------------------------------------------------------------------

RASTER_WIDTH = 256


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell per order on a grid that grows downwards with the table."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_orderkey") % RASTER_WIDTH).cast("int").alias("col"),
        F.floor(F.col("o_orderkey") / RASTER_WIDTH).cast("int").alias("row"),
        F.round(F.col("o_totalprice") / 1000.0, 0).alias("value"),
    )


RASTER_SQL = f"""cells AS (SELECT CAST(o_orderkey % {RASTER_WIDTH} AS INTEGER) AS col,
  CAST(o_orderkey // {RASTER_WIDTH} AS INTEGER) AS "row", round(o_totalprice / 1000.0, 0) AS value FROM orders)"""


# --- digits / forest -------------------------------------------------------------------------------


def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 grey images: ``id, label, pixels, valid``."""
    e = load(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("double").alias("label"),
        F.transform("embedding", lambda x: F.round((x.cast("double") + 1.0) * 127.5, 0)).alias("pixels"),
        (F.col("vec_id") % 7 == 0).alias("valid"),
    )
