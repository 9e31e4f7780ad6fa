"""Spatial operators: area filters, near search, zone tagging, station reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spatial as G
from ..session import stage


def polygon_table(df: DataFrame, geojson: str) -> DataFrame:
    """Add ``edges`` and ``box`` parsed from a GeoJSON column."""
    with_edges = df.withColumn("edges", G.edges(G.rings(F.col(geojson))))
    return with_edges.withColumn("box", G.bounds(F.col("edges")))


def with_points(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """High-precision point ``sensor_location`` and its web-mercator image ``new_sensor_location``."""
    x, y = F.col(lon).cast("decimal(24,20)"), F.col(lat).cast("decimal(24,20)")
    placed = df.withColumn("sensor_location", G.point(x, y))
    loc = F.col("sensor_location")
    return placed.withColumn("new_sensor_location", G.to_mercator(loc["x"], loc["y"]))


def area_columns(spark, geojson: str) -> tuple[Column, Column]:
    """Edges and box of one area given as GeoJSON text, parsed once, as constants."""
    text = spark.createDataFrame([(geojson,)], "g string")
    area = polygon_table(text, "g").select("edges", "box").first()
    edge_list = F.array(*[F.struct(*[F.lit(e[n]).alias(n) for n in ("x1", "y1", "x2", "y2")]) for e in area["edges"]])
    box = F.struct(*[F.lit(area["box"][n]).alias(n) for n in ("xmin", "xmax", "ymin", "ymax")])
    return edge_list, box


def within_area(df: DataFrame, lon: str, lat: str, geojson: str) -> DataFrame:
    """Rows inside one area given as GeoJSON text. The area's box is a plain range on the
    coordinates, so over stored coordinates it reaches the scan."""
    edge_list, box = area_columns(df.sparkSession, geojson)
    return df.filter(G.contains(edge_list, box, F.col(lon), F.col(lat)))


def distance_from(df: DataFrame, location: str, lon: float, lat: float, out: str = "distance") -> DataFrame:
    """Planar distance in web-mercator metres from a lon/lat point to a projected location column."""
    return df.withColumn(out, G.planar_distance(G.to_mercator(F.lit(lon), F.lit(lat)), F.col(location)))


def near(df: DataFrame, lon: str, lat: str, center: tuple[float, float], max_distance: float, out: str = "distance") -> DataFrame:
    """Rows within ``max_distance`` metres of a point with their distance, nearest first.

    A latitude/longitude range runs first; over a stored table it reaches the scan.
    """
    x0, y0 = center
    reach = math.degrees(max_distance / G.SPHERE_RADIUS) * (1 + 1e-9) + 1e-9
    out_df = df.filter(F.col(lat).between(y0 - reach, y0 + reach))
    if abs(y0) + reach < 89.9:
        # Widest longitude difference of the circle, reached between centre and pole.
        wide = math.degrees(math.asin(min(1.0, math.sin(math.radians(reach)) / math.cos(math.radians(y0))))) + 1e-9
        if -180 < x0 - wide and x0 + wide < 180:
            out_df = out_df.filter(F.col(lon).between(x0 - wide, x0 + wide))
    d = G.sphere_distance(F.lit(x0), F.lit(y0), F.col(lon), F.col(lat))
    return out_df.withColumn(out, d).filter(F.col(out) <= max_distance).orderBy(out)


def nearest(df: DataFrame, lon: str, lat: str, center: tuple[float, float], k: int, key: str, out: str = "distance") -> DataFrame:
    """The k nearest rows; every task keeps only k of its own."""
    d = G.sphere_distance(F.lit(center[0]), F.lit(center[1]), F.col(lon), F.col(lat))
    return df.withColumn(out, d).orderBy(out, key).limit(k)


#: Side of the cells of level 0 in degrees; each level halves it. Powers of two, so that a point's cell is exact.
TOP_CELL = 512.0
LEVELS = 40


def _cell_side(level: Column) -> Column:
    return F.lit(TOP_CELL) * F.pow(F.lit(2.0), -level)


def _meets(e: Column, left: Column, right: Column, low: Column, high: Column) -> Column:
    """Whether an edge may meet a cell: their boxes overlap and the cell is not clearly on one side of the edge's line."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    boxes = (F.greatest(e["x1"], e["x2"]) >= left) & (F.least(e["x1"], e["x2"]) <= right) & (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high)
    sides = [dx * (y - e["y1"]) - dy * (x - e["x1"]) for x in (left, right) for y in (low, high)]
    clear = F.lit(1e-9) * (F.abs(dx) + F.abs(dy))
    return boxes & ~((F.least(*sides) > clear) | (F.greatest(*sides) < -clear))


def zone_cover(zones: DataFrame, cells: int = 8) -> DataFrame:
    """``zone, level, cx, cy, inner, near, box``: every zone as cells of a level of its own, at most ``cells`` + 1 each way.

    An ``inner`` cell lies in the zone as a whole. All others meet its border and carry in ``near`` the edges that
    decide on their points: those in the cell's rows that do not end left of it. Cells outside are left out.
    """
    b = F.col("box")
    wide = F.greatest(b["xmax"] - b["xmin"], b["ymax"] - b["ymin"])
    level = F.when(wide > 0, F.floor(F.log2(F.lit(TOP_CELL * cells) / wide))).otherwise(LEVELS)
    placed = zones.where(F.size("edges") > 0).withColumn("level", F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS)).cast("int"))
    side = _cell_side(F.col("level"))
    spread = placed.withColumn("cx", F.explode(F.sequence(G.cell(b["xmin"], side), G.cell(b["xmax"], side))))
    spread = spread.withColumn("cy", F.explode(F.sequence(G.cell(b["ymin"], side), G.cell(b["ymax"], side))))
    left, low = F.col("cx") * side, F.col("cy") * side
    right, high = left + side, low + side
    border = F.exists("edges", lambda e: _meets(e, left, right, low, high))
    near = F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["x1"], e["x2"]) >= left))
    inner = ~border & G.contains(F.col("edges"), b, left + side / 2, low + side / 2)
    kept = spread.select("zone", "level", "cx", "cy", "box", border.alias("border"), inner.alias("inner"), near.alias("near")).where("border or inner")
    return kept.select("zone", "level", "cx", "cy", "inner", F.when(F.col("border"), F.col("near")).alias("near"), "box")


def tag_zones(df: DataFrame, key: str, lon: str, lat: str, zones: DataFrame, name: str, cells: int = 8) -> DataFrame:
    """``key, zone``: the first zone by name that contains each point; points outside all zones drop out.

    Large and small zones give a few cells each, at levels of their own; a point is looked up once in every level that
    has zones (``LEVELS`` + 1 at most). The exact test runs at the borders only, and the first match is a map-side
    minimum. The cover is stored, so the planner knows its true size; a crowded cell is split by the planner's skew
    handling when the cover is too large to broadcast.
    """
    cover = stage(zone_cover(zones.select(F.col(name).alias("zone"), "edges", "box"), cells), "cover")
    levels = sorted(r["level"] for r in cover.select("level").distinct().collect())
    found = df.select(key, F.col(lon).alias("__x"), F.col(lat).alias("__y"), F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")).alias("level"))
    side = _cell_side(F.col("level"))
    points = found.withColumns({"cx": G.cell(F.col("__x"), side), "cy": G.cell(F.col("__y"), side)})
    inside = F.col("inner") | G.contains(F.col("near"), F.col("box"), F.col("__x"), F.col("__y"))
    hits = points.join(cover, ["level", "cx", "cy"]).filter(inside)
    return hits.groupBy(key).agg(F.min("zone").alias("zone"))


def zone_averages(df: DataFrame, tags: DataFrame, key: str, values: str) -> DataFrame:
    """Mean of the array entries of all rows tagged with a zone."""
    unwound = df.join(tags, key).select("zone", F.explode(values).alias("v"))
    return unwound.groupBy("zone").agg(F.avg("v").alias("mean_value"), F.count("v").alias("n"))
