"""Registered queries: every reader and writer. A whole table is written in the format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources as IO
from ..functions.scalars import safe_double
from ..operators import geo, raster, recommend
from ..session import fresh_path
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


def _lines(spark, df, *columns, sep=" ", name="lines"):
    path = fresh_path(spark, name)
    df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")).write.text(path)
    return path


@register(f"""WITH {X.LISTENS_SQL} SELECT "user", item, "count" FROM listens""")
def scan_text(spark, sf):
    """Blank-separated listen lines parsed into typed columns."""
    path = _lines(spark, X.raw_listens(spark, sf), "user", "item", "count")
    return recommend.parse_listens(IO.read_lines(spark, path))


@register(f"""WITH {X.NAMES_SQL} SELECT id, name FROM names WHERE id % 11 <> 3 AND id % 13 <> 5""")
def scan_artists(spark, sf):
    """Tab lines where some ids are unreadable and some names missing; those rows are dropped."""
    names = X.artist_names(spark, sf)
    bad = F.when(F.col("id") % 11 == 3, F.concat(F.lit("x"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string"))
    dirty = names.select(bad.alias("id"), F.when(F.col("id") % 13 == 5, F.lit(None)).otherwise(F.col("name")).alias("name"))
    text = dirty.select(F.concat_ws("\t", "id", "name").alias("value"))
    path = fresh_path(spark, "artists")
    text.write.text(path)
    return recommend.parse_artists(IO.read_lines(spark, path))


@register(f"""WITH {X.ALIASES_SQL} SELECT bad_id, good_id FROM aliases WHERE bad_id % 3 <> 0""")
def scan_aliases(spark, sf):
    """Alias lines; an empty first field drops the row."""
    a = X.aliases(spark, sf).withColumn("bad_id", F.when(F.col("bad_id") % 3 != 0, F.col("bad_id")))
    return recommend.parse_aliases(IO.read_lines(spark, _lines(spark, a, "bad_id", "good_id", sep="\t")))


@register("""SELECT l_orderkey AS "order", l_quantity AS quantity, l_returnflag AS label FROM lineitem""")
def scan_csv_inferred(spark, sf):
    """No header; types are found by a pass over the file, names are given by position."""
    path = fresh_path(spark, "csv")
    load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").write.csv(path)
    d = IO.read_csv_positional(spark, path, ["order", "quantity", "label"])
    return d.select(F.col("order").cast("bigint").alias("order"), "quantity", "label")


@register("""SELECT l_orderkey AS "order", l_quantity AS quantity, l_returnflag AS label FROM lineitem""")
def scan_csv_positional(spark, sf):
    """No header, given types: no inference pass."""
    path = fresh_path(spark, "csv")
    load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").write.csv(path)
    return IO.read_csv_positional(spark, path, ["order", "quantity", "label"], "a bigint, b double, c string")


@register(f"""WITH {X.TRIPS_SQL} SELECT Date_Time, CAST(Lat AS VARCHAR) AS Lat, Base FROM trips""")
def scan_csv_strings(spark, sf):
    """One file per base with a header, all columns strings, read as one table."""
    t = X.trips(spark, sf).select("Date_Time", "Lat", "Base")
    paths = []
    for base in ("click", "error", "purchase", "signup", "view"):
        paths.append(fresh_path(spark, "trips"))
        IO.write_csv(t.filter(F.col("Base") == base), paths[-1])
    return IO.read_csv_strings(spark, paths)


@register("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def scan_csv_typed(spark, sf):
    path = fresh_path(spark, "csv")
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    IO.write_csv(load(spark, sf, "orders").select(*cols), path)
    return IO.read_csv_typed(spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string")


@register(f"""WITH {X.STATIONS_SQL} SELECT IdSensore, NomeStazione, Tipologia, round(lng, 6) AS lng, round(lat, 6) AS lat FROM stations""")
def scan_tsv(spark, sf):
    path = fresh_path(spark, "tsv")
    X.stations(spark, sf).write.csv(path, sep="\t", header=True)
    d = IO.read_tsv(spark, path)
    return d.withColumns({c: F.round(safe_double(F.col(c)), 6) for c in ("lng", "lat")})


@register(f"""WITH {X.SENSORS_SQL} SELECT id AS "_id", len(v) AS n, round(lng, 6) AS lng, rain_24h FROM sensors""")
def scan_json_nested(spark, sf):
    path = fresh_path(spark, "json")
    X.sensors(spark, sf).write.json(path)
    d = IO.read_json_documents(spark, path, X.SENSOR_SCHEMA)
    return d.select(
        "_id", F.size("measures.measures.res.value").cast("bigint").alias("n"),
        F.round(F.get("place.location", 0), 6).alias("lng"), F.col("measures.measures.rain_24h").alias("rain_24h"),
    )


@register(f"""WITH {X.AREAS_SQL} SELECT name, kind, edges, xmin, ymax FROM areas""")
def scan_polygons(spark, sf):
    """GeoJSON features, one per line, parsed to edges and boxes."""
    path = fresh_path(spark, "areas")
    feature = F.concat(
        F.lit('{"type": "Feature", "properties": {"name": "'), F.col("name"), F.lit('"}, "geometry": '), F.col("geometry"), F.lit("}")
    )
    X.service_areas(spark, sf).select(feature.alias("value")).write.text(path)
    areas = geo.polygon_table(IO.read_areas(spark, path), "geojson")
    return areas.select("name", "kind", F.size("edges").cast("bigint").alias("edges"), "box.xmin", "box.ymax")


@register(f"""WITH {X.RASTER_SQL} SELECT col, "row", value FROM cells""")
def scan_raster_cells(spark, sf):
    path = fresh_path(spark, "cells")
    X.raster(spark, sf).write.parquet(path)
    return IO.read_raster_cells(spark, path)


@register("""SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def temp_view_sql(spark, sf):
    IO.register_view(load(spark, sf, "orders"), "orders_view")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders_view GROUP BY o_orderstatus"
    )


@register("""SELECT o_orderkey, o_orderstatus FROM orders""")
def sink_csv(spark, sf):
    path = fresh_path(spark, "out")
    IO.write_csv(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    return IO.read_csv_typed(spark, path, "o_orderkey bigint, o_orderstatus string")


@register(f"""WITH {X.SENSORS_SQL} SELECT sensor_type AS "sensorType", 2 * count(*) AS n FROM sensors GROUP BY 1""")
def sink_append(spark, sf):
    """Two appends to one collection."""
    from ..operators.sensors import with_sensor_type

    path = fresh_path(spark, "collection")
    docs = with_sensor_type(X.sensors(spark, sf))
    for _ in range(2):
        IO.append_collection(docs, path)
    return spark.read.parquet(path).groupBy("sensorType").agg(F.count("*").alias("n"))


@register(f"""WITH {X.RASTER_SQL} SELECT 8 AS zoom, count(*) AS n FROM cells UNION ALL
  SELECT 7, count(*) FROM (SELECT DISTINCT col // 2, "row" // 2 FROM cells) UNION ALL
  SELECT 6, count(*) FROM (SELECT DISTINCT col // 4, "row" // 4 FROM cells)""")
def sink_raster_levels(spark, sf):
    """Levels written to one folder each; reading some levels prunes the others."""
    path = fresh_path(spark, "layer")
    IO.write_raster_levels(raster.pyramid(X.raster(spark, sf), 8), path, "cropped")
    d = IO.read_raster_cells(spark, path).filter("layer = 'cropped' and zoom >= 6")
    return d.groupBy("zoom").agg(F.count("*").alias("n"))


@register("""SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM embeddings GROUP BY 1""")
def sink_image_matrix(spark, sf):
    """Images as nested rows, written, read back and flattened."""
    path = fresh_path(spark, "images")
    d = X.digits(spark, sf)
    rows = F.array(*[F.slice("pixels", 8 * k + 1, 8) for k in range(8)])
    IO.write_images(d.withColumn("pixels", rows), path)
    return IO.read_images(spark, path, side=8).groupBy("label").agg(F.count("*").alias("n"))
