"""Registered queries: stations, sensors, zones, rasters."""

from __future__ import annotations

import json
import math

from pyspark.sql import functions as F

from ..functions import spatial as G
from ..functions.scalars import safe_double
from ..functions.spatial import MERCATOR_RADIUS
from ..operators import geo, raster, sensors
from ..operators.relational import count_by
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


# Test areas inside the station box: a concave one with a hole, and one of two parts.
CONCAVE = [
    [[8.8, 45.2], [9.6, 45.25], [9.9, 45.7], [9.3, 45.5], [9.0, 45.9], [8.8, 45.2]],
    [[9.0, 45.35], [9.2, 45.35], [9.2, 45.45], [9.0, 45.45], [9.0, 45.35]],
]
TWO_PARTS = [
    [[[8.75, 45.6], [9.05, 45.65], [9.0, 45.95], [8.75, 45.6]]],
    [[[9.7, 45.3], [10.2, 45.35], [10.1, 45.8], [9.75, 45.75], [9.7, 45.3]]],
]
CONCAVE_JSON = json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": CONCAVE}})
TWO_PARTS_JSON = json.dumps({"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": TWO_PARTS}})


def _edges_sql(name: str, ring_list) -> str:
    rows = ", ".join(
        f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for ring in ring_list for a, b in zip(ring, ring[1:])
    )
    return f"{name} AS (SELECT * FROM (VALUES {rows}) v(x1, y1, x2, y2))"


_CROSS = """sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lng < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1"""
_R = 6378137.0
_MX = f"radians(lng) * {_R}::DOUBLE"
_MY = f"ln(tan(pi() / 4 + radians(lat) / 2)) * {_R}::DOUBLE"


def _stations(spark, sf):
    return geo.with_points(X.stations(spark, sf), "lng", "lat")


@register(f"""WITH {X.STATIONS_SQL}, {X.READINGS_SQL} SELECT IdSensore, NomeStazione, Tipologia, Data, Valore FROM stations
  JOIN readings USING (IdSensore)""")
def station_join(spark, sf):
    j = X.stations(spark, sf).join(X.readings(spark, sf), "IdSensore")
    return j.select("IdSensore", "NomeStazione", "Tipologia", "Data", "Valore")


@register(f"""WITH {X.STATIONS_SQL} SELECT IdSensore, round(lng, 9) AS x, round(lat, 9) AS y FROM stations""")
def sensor_points(spark, sf):
    s = _stations(spark, sf)
    return s.select("IdSensore", F.round("sensor_location.x", 9).alias("x"), F.round("sensor_location.y", 9).alias("y"))


@register(f"""WITH {X.STATIONS_SQL} SELECT IdSensore, round({_MX}, 3) AS x, round({_MY}, 3) AS y, round(lng, 6) AS lng, round(lat, 6) AS lat
  FROM stations""")
def reproject_3857(spark, sf):
    """To web mercator and back."""
    s = _stations(spark, sf)
    p = F.col("new_sensor_location")
    back = s.withColumn("back", G.from_mercator(p["x"], p["y"]))
    return back.select(
        "IdSensore", F.round(p["x"], 3).alias("x"), F.round(p["y"], 3).alias("y"),
        F.round("back.x", 6).alias("lng"), F.round("back.y", 6).alias("lat"),
    )


@register(f"""WITH {X.STATIONS_SQL}, {_edges_sql('area', CONCAVE)} SELECT IdSensore, NomeStazione FROM stations, area
  GROUP BY 1, 2, lng, lat HAVING {_CROSS}""")
def area_contains(spark, sf):
    return geo.within_area(X.stations(spark, sf), "lng", "lat", CONCAVE_JSON).select("IdSensore", "NomeStazione")


@register(f"""WITH {X.STATIONS_SQL}, {_edges_sql('area', [r for p in TWO_PARTS for r in p])} SELECT DISTINCT Tipologia FROM
  (SELECT IdSensore, Tipologia FROM stations, area GROUP BY 1, 2, lng, lat HAVING {_CROSS})""")
def area_kinds(spark, sf):
    return geo.within_area(X.stations(spark, sf), "lng", "lat", TWO_PARTS_JSON).select("Tipologia").distinct()


@register(f"""WITH {X.STATIONS_SQL} SELECT IdSensore, round(d, 3) AS distance FROM (SELECT IdSensore,
  2 * 6378100.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.48)) / 2), 2) + cos(radians(45.48)) * cos(radians(lat))
  * pow(sin((radians(lng) - radians(9.23)) / 2), 2))) AS d FROM stations) ORDER BY d, IdSensore LIMIT 15""")
def nearest_k(spark, sf):
    n = geo.nearest(X.stations(spark, sf), "lng", "lat", (9.23, 45.48), 15, "IdSensore")
    return n.select("IdSensore", F.round("distance", 3).alias("distance"))


_PLANAR = f"""sqrt(pow(radians(9.23) * {_R} - {_MX}, 2) + pow(ln(tan(pi() / 4 + radians(45.48) / 2)) * {_R} - {_MY}, 2))"""


@register(f"""WITH {X.STATIONS_SQL}, {X.READINGS_SQL} SELECT NomeStazione, round(avg(CAST(Valore AS DOUBLE)), 6) AS mean_value
  FROM stations JOIN readings USING (IdSensore) WHERE {_PLANAR} < 20000 GROUP BY 1""")
def radius_mean(spark, sf):
    """Mean reading per station within a planar radius of a point."""
    close = geo.distance_from(_stations(spark, sf), "new_sensor_location", 9.23, 45.48).filter("distance < 20000")
    j = close.join(X.readings(spark, sf), "IdSensore")
    return j.groupBy("NomeStazione").agg(F.round(F.avg(safe_double(F.col("Valore"))), 6).alias("mean_value"))


@register(f"""WITH {X.STATIONS_SQL}, {X.READINGS_SQL}, {_edges_sql('area', CONCAVE)}, inside AS (SELECT IdSensore FROM stations, area
  WHERE Tipologia = 'Temperatura' GROUP BY 1, lng, lat HAVING {_CROSS})
SELECT min(CAST(Valore AS DOUBLE)) AS low, max(CAST(Valore AS DOUBLE)) AS high FROM readings JOIN inside USING (IdSensore)""")
def area_min_max(spark, sf):
    inside = geo.within_area(X.stations(spark, sf).filter("Tipologia = 'Temperatura'"), "lng", "lat", CONCAVE_JSON)
    v = safe_double(F.col("Valore"))
    return inside.join(X.readings(spark, sf), "IdSensore").agg(F.min(v).alias("low"), F.max(v).alias("high"))


@register(f"""WITH {X.READINGS_SQL} SELECT DISTINCT substr(Data, 1, 10) AS day FROM readings""")
def distinct_days(spark, sf):
    return X.readings(spark, sf).select(F.substring("Data", 1, 10).alias("day")).distinct()


# --- sensors ---------------------------------------------------------------------------------------


def _docs(spark, sf):
    return sensors.with_sensor_type(X.sensors(spark, sf))


@register(f"""WITH {X.SENSORS_SQL} SELECT sensor_type AS "sensorType", count(*) AS total FROM sensors GROUP BY 1""")
def sensor_typing(spark, sf):
    return count_by(_docs(spark, sf), "sensorType", out="total")


@register(f"""WITH {X.SENSORS_SQL} SELECT sensor_type AS "sensorType", round(avg(x), 6) AS total FROM
  (SELECT sensor_type, unnest(v) AS x FROM sensors WHERE sensor_type = 'temperature') GROUP BY 1""")
def avg_by_sensor_type(spark, sf):
    return sensors.average_by_type(_docs(spark, sf), "temperature").withColumn("total", F.round("total", 6))


@register(f"""WITH {X.SENSORS_SQL} SELECT sensor_type AS "sensorType", round(avg(rain_24h), 6) AS total FROM sensors
  WHERE sensor_type = 'rain' AND rain_24h > 0 GROUP BY 1""")
def rain_positive_avg(spark, sf):
    return sensors.positive_rain_average(_docs(spark, sf)).withColumn("total", F.round("total", 6))


@register(f"""WITH {X.SENSORS_SQL} SELECT id AS "_id", 'Point' AS kind, round(lng, 6) AS x, round(lat, 6) AS y FROM sensors
  WHERE sensor_type = 'rain'""")
def location_layer(spark, sf):
    layer = sensors.location_layer(_docs(spark, sf), "rain")
    return layer.select(
        "_id", F.col("location.type").alias("kind"),
        F.round(F.get("location.coordinates", 0), 6).alias("x"), F.round(F.get("location.coordinates", 1), 6).alias("y"),
    )


_HAV = """2 * 6378100.0::DOUBLE * asin(sqrt(pow(sin((radians(lat) - radians(45.480525)) / 2), 2)
  + cos(radians(45.480525)) * cos(radians(lat)) * pow(sin((radians(lng) - radians(9.231507)) / 2), 2)))"""


def _near(spark, sf):
    docs = _docs(spark, sf).filter("sensorType = 'temperature'")
    placed = docs.withColumns({"lng": F.get("place.location", 0), "lat": F.get("place.location", 1)})
    return geo.near(placed, "lng", "lat", (9.231507, 45.480525), 30_000, "distance")


@register(f"""WITH {X.SENSORS_SQL} SELECT id AS "_id", round({_HAV}, 3) AS distance FROM sensors
  WHERE sensor_type = 'temperature' AND {_HAV} <= 30000""")
def near_sphere(spark, sf):
    return _near(spark, sf).select("_id", F.round("distance", 3).alias("distance"))


@register(f"""WITH {X.SENSORS_SQL} SELECT sensor_type AS "sensorType", round(avg(x), 6) AS total FROM
  (SELECT sensor_type, unnest(v) AS x FROM sensors WHERE sensor_type = 'temperature' AND {_HAV} <= 30000) GROUP BY 1""")
def geo_near_avg(spark, sf):
    n = sensors.unwind_values(_near(spark, sf))
    return n.groupBy("sensorType").agg(F.round(F.avg("value"), 6).alias("total"))


_TAGS = f"""{X.SENSORS_SQL}, {X.ZONES_SQL}, hit AS (SELECT id, zone FROM sensors, zone_edges GROUP BY id, zone, lng, lat HAVING {_CROSS}),
tags AS (SELECT id, min(zone) AS zone FROM hit GROUP BY 1)"""


def _tags(spark, sf):
    docs = _docs(spark, sf).withColumns({"lng": F.get("place.location", 0), "lat": F.get("place.location", 1)})
    zones = geo.polygon_table(X.zones(spark, sf), "geometry")
    return docs, geo.tag_zones(docs, "_id", "lng", "lat", zones, "NIL")


@register(f"""WITH {_TAGS} SELECT id AS "_id", zone FROM tags""")
def first_match_per_row(spark, sf):
    """First containing zone of every sensor document."""
    return _tags(spark, sf)[1]


@register(f"""WITH {_TAGS} SELECT zone, round(avg(x), 6) AS mean_value, count(*) AS n FROM
  (SELECT zone, unnest(v) AS x FROM sensors JOIN tags USING (id)) GROUP BY 1""")
def zone_tag_avg(spark, sf):
    docs, tags = _tags(spark, sf)
    return geo.zone_averages(docs, tags, "_id", "measures.measures.res.value").withColumn("mean_value", F.round("mean_value", 6))


@register(f"""WITH {X.STATIONS_SQL} SELECT CAST(floor(lng / 0.05) AS BIGINT) AS cx, CAST(floor(lat / 0.05) AS BIGINT) AS cy, count(*) AS n
  FROM stations GROUP BY 1, 2""")
def cell_keys(spark, sf):
    s = X.stations(spark, sf)
    return count_by(s.select(G.cell(F.col("lng"), 0.05).alias("cx"), G.cell(F.col("lat"), 0.05).alias("cy")), "cx", "cy")


@register(f"""WITH {X.AREAS_SQL} SELECT name, edges, xmin, xmax, ymin, ymax FROM areas""")
def polygon_parse(spark, sf):
    """Polygons with holes and multi-part polygons to edges and boxes."""
    z = geo.polygon_table(X.service_areas(spark, sf), "geometry")
    return z.select("name", F.size("edges").cast("bigint").alias("edges"), "box.*")


# --- rasters ---------------------------------------------------------------------------------------

GRID = raster.Grid(0.0, 0.0, 10_000.0)
_CELL = 0.002  # degrees
_STRIP = 50_000  # rows from 60 degrees north downwards; the rows after them lie further east
_ZOOM = raster.layout_zoom(math.radians(_CELL) * MERCATOR_RADIUS)
_WORLD = raster.world_grid(_ZOOM)
_C0 = math.floor((math.radians(8.0) * MERCATOR_RADIUS - _WORLD.x0) / _WORLD.size)
_R0 = math.floor((_WORLD.y0 - math.log(math.tan(math.pi / 4 + math.radians(60.0) / 2)) * MERCATOR_RADIUS) / _WORLD.size)


def _lonlat(spark, sf):
    """The raster as degrees, in strips side by side, so that it grows with its table."""
    east, down = F.col("col") + X.RASTER_WIDTH * F.floor(F.col("row") / _STRIP), F.col("row") % _STRIP
    return X.raster(spark, sf).withColumns({"lng": F.lit(8.0) + (east + 0.5) * _CELL, "lat": F.lit(60.0) - (down + 0.5) * _CELL})


# From the target grid: the centre of each column and row of the layout is looked up in the source.
@register(f"""WITH {X.RASTER_SQL}, g AS (SELECT col + {X.RASTER_WIDTH} * ("row" // {_STRIP}) AS sc, "row" % {_STRIP} AS sr, value FROM cells),
b AS (SELECT max(sc) + 1 AS nc, max(sr) + 1 AS nr FROM g),
tc AS (SELECT c, CAST(floor((degrees(({_WORLD.x0}::DOUBLE + (c + 0.5::DOUBLE) * {_WORLD.size}::DOUBLE) / {MERCATOR_RADIUS}::DOUBLE) - 8) / {_CELL}::DOUBLE) AS BIGINT) AS sc
  FROM (SELECT unnest(range({_C0}, CAST({_C0} + nc * 2 + 2 AS BIGINT))) AS c FROM b)),
tr AS (SELECT r, CAST(floor((60 - degrees(2 * atan(exp(({_WORLD.y0}::DOUBLE - (r + 0.5::DOUBLE) * {_WORLD.size}::DOUBLE) / {MERCATOR_RADIUS}::DOUBLE)) - pi() / 2)) / {_CELL}::DOUBLE) AS BIGINT) AS sr
  FROM (SELECT unnest(range({_R0}, CAST({_R0} + nr * 4 + 4 AS BIGINT))) AS r FROM b))
SELECT CAST({_ZOOM} AS INTEGER) AS zoom, CAST(c // 256 AS INTEGER) AS tile_col, CAST(r // 256 AS INTEGER) AS tile_row,
  CAST(c AS INTEGER) AS col, CAST(r AS INTEGER) AS "row", value FROM g JOIN tc USING (sc) JOIN tr USING (sr)""")
def raster_tiles(spark, sf):
    return raster.tile_to_layout(_lonlat(spark, sf), "lng", "lat", _CELL, _CELL, _ZOOM)


def _pyramid_sql(agg: str) -> str:
    ctes = [X.RASTER_SQL, """l8 AS (SELECT 8 AS zoom, col, "row", value FROM cells)"""]
    for z in range(7, -1, -1):
        ctes.append(
            f"""l{z} AS (SELECT {z} AS zoom, col // 2 AS col, "row" // 2 AS "row", {agg} AS value FROM l{z + 1} GROUP BY col // 2, "row" // 2)"""
        )
    body = " UNION ALL ".join(f"SELECT zoom, col, \"row\", round(value, 6) AS value FROM l{z}" for z in range(8, -1, -1))
    return f"WITH {', '.join(ctes)} {body}"


@register(_pyramid_sql('arg_min(value, "row" * 1000000::BIGINT + col)'))
def raster_pyramid(spark, sf):
    return raster.pyramid(X.raster(spark, sf), 8).withColumn("value", F.round("value", 6))


@register(_pyramid_sql("avg(value)"))
def raster_pyramid_mean(spark, sf):
    return raster.pyramid(X.raster(spark, sf), 8, "mean").withColumn("value", F.round("value", 6))


@register(_pyramid_sql('arg_min(value, "row" * 1000000::BIGINT + col)').replace("SELECT zoom, col", "SELECT * FROM (SELECT zoom, col", 1) + ") WHERE zoom = 5")
def raster_level(spark, sf):
    return raster.level(raster.pyramid(X.raster(spark, sf), 8), 5).withColumn("value", F.round("value", 6))


@register(f"""WITH {X.RASTER_SQL} SELECT "row", CAST(col // 100 AS INTEGER) AS strip, min(col) AS first_col,
  string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY col) AS "values" FROM cells GROUP BY 1, 2""")
def raster_stitch(spark, sf):
    s = raster.stitch(X.raster(spark, sf), 100)
    text = F.array_join(F.transform("values", lambda v: v.cast("bigint").cast("string")), ",")
    return s.withColumn("values", text)


@register(f"""WITH {X.RASTER_SQL} SELECT *, xmin + (xmax - xmin) / 2 AS xmid, ymin + (ymax - ymin) / 2 AS ymid FROM
  (SELECT min(col) * 10000.0::DOUBLE AS xmin, (max(col) + 1) * 10000.0::DOUBLE AS xmax, -(max("row") + 1) * 10000.0::DOUBLE AS ymin,
  0 - min("row") * 10000.0::DOUBLE AS ymax FROM cells)""")
def raster_extent(spark, sf):
    return raster.extent(X.raster(spark, sf), GRID)


@register(f"""WITH {X.RASTER_SQL} SELECT col, "row", round(value / 2013, 9) AS value FROM cells""")
def raster_divide(spark, sf):
    return raster.divide(X.raster(spark, sf), 2013).withColumn("value", F.round("value", 9))


def _focal_sql(n: int) -> str:
    return f"""WITH {X.RASTER_SQL} SELECT a.col, a."row", round(avg(b.value), 6) AS value FROM cells a
  JOIN (SELECT col + dx AS col, "row" + dy AS "row", value FROM cells, range({-n}, {n + 1}) x(dx), range({-n}, {n + 1}) y(dy)) b
  ON a.col = b.col AND a."row" = b."row" GROUP BY 1, 2"""


@register(_focal_sql(1))
def raster_focal_mean(spark, sf):
    return raster.focal_mean(X.raster(spark, sf), 1).withColumn("value", F.round("value", 6))


@register(_focal_sql(3))
def neighbourhood_mean(spark, sf):
    return raster.focal_mean(X.raster(spark, sf), 3).withColumn("value", F.round("value", 6))


@register(f"""WITH {X.RASTER_SQL}, p AS (SELECT c_custkey AS id, (c_custkey * 7919 % 2600000)::DOUBLE AS x,
  -(c_custkey * 104729 % 800000)::DOUBLE AS y FROM customer)
SELECT id, value FROM p LEFT JOIN cells ON col = floor(x / 10000) AND "row" = floor((0 - y) / 10000)""")
def raster_points(spark, sf):
    c = F.col("c_custkey")
    p = load(spark, sf, "customer").select(
        c.alias("id"), (c * 7919 % 2_600_000).cast("double").alias("x"), (-(c * 104_729 % 800_000)).cast("double").alias("y")
    )
    return raster.point_values(X.raster(spark, sf), GRID, p).select("id", "value")


@register(f"""WITH {X.RASTER_SQL}, e AS (SELECT (max(col) + 1) * 10000 AS xmax, -(max("row") + 1) * 10000 AS ymin, 0 AS ymax FROM cells),
g AS (SELECT x, y FROM e, range(0, 4000000, 30000) a(x), range(-100000000, 1, 10000) b(y)
  WHERE x < xmax AND y < ymax AND y >= ymin AND (y - ymin) % 30000 = 0)
SELECT x::DOUBLE AS x, y::DOUBLE AS y, value FROM g JOIN cells ON col = x // 10000 AND "row" = (0 - y) // 10000
  ORDER BY value DESC, x, y LIMIT 1""")
def raster_grid_max(spark, sf):
    return raster.grid_maximum(X.raster(spark, sf), GRID, 30_000.0)
