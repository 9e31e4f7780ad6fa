"""Spatial expressions: points, projections, distances, polygons as edge arrays. Longitude comes first."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MERCATOR_RADIUS = 6_378_137.0
SPHERE_RADIUS = 6_378_100.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geojson_point(coordinates: Column) -> Column:
    """``{type: Point, coordinates: [lon, lat]}``."""
    return F.struct(F.lit("Point").alias("type"), coordinates.alias("coordinates"))


def to_mercator(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees → EPSG:3857 metres."""
    return F.struct(
        (F.radians(lon) * MERCATOR_RADIUS).alias("x"),
        (F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS).alias("y"),
    )


def from_mercator(x: Column, y: Column) -> Column:
    """EPSG:3857 metres → EPSG:4326 degrees."""
    return F.struct(
        F.degrees(x / MERCATOR_RADIUS).alias("x"),
        F.degrees(F.lit(2.0) * F.atan(F.exp(y / MERCATOR_RADIUS)) - math.pi / 2).alias("y"),
    )


def planar_distance(a: Column, b: Column) -> Column:
    dx, dy = a["x"] - b["x"], a["y"] - b["y"]
    return F.sqrt(dx * dx + dy * dy)


def sphere_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    s1, s2 = F.sin((p2 - p1) / 2), F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    return F.lit(2 * SPHERE_RADIUS) * F.asin(F.sqrt(s1 * s1 + F.cos(p1) * F.cos(p2) * s2 * s2))


def _geometry_part(text: Column, name: str) -> Column:
    """The member of a GeoJSON geometry, or of the geometry inside a feature."""
    return F.coalesce(F.get_json_object(text, f"$.geometry.{name}"), F.get_json_object(text, f"$.{name}"))


def rings(geojson: Column) -> Column:
    """All rings of all parts of a Polygon or MultiPolygon as arrays of [lon, lat]."""
    coords = _geometry_part(geojson, "coordinates")
    many = F.flatten(F.from_json(coords, "array<array<array<array<double>>>>"))
    # The type member of a feature is "Feature", so the geometry's own type is looked up first.
    kind = F.coalesce(F.get_json_object(geojson, "$.geometry.type"), F.get_json_object(geojson, "$.type"))
    return F.when(kind == "MultiPolygon", many).otherwise(F.from_json(coords, "array<array<array<double>>>"))


def edges(ring_array: Column) -> Column:
    """Edges ``{x1, y1, x2, y2}`` between consecutive points of every ring, in one array."""

    def of_ring(ring):
        ends = F.arrays_zip(
            F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))).alias("a"),
            F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))).alias("b"),
        )
        return F.transform(
            ends,
            lambda e: F.struct(
                e["a"][0].alias("x1"), e["a"][1].alias("y1"), e["b"][0].alias("x2"), e["b"][1].alias("y2")
            ),
        )

    return F.flatten(F.transform(ring_array, of_ring))


def bounds(edge_array: Column) -> Column:
    def xs(e):
        return e["x1"]

    def ys(e):
        return e["y1"]

    return F.struct(
        F.array_min(F.transform(edge_array, xs)).alias("xmin"),
        F.array_max(F.transform(edge_array, xs)).alias("xmax"),
        F.array_min(F.transform(edge_array, ys)).alias("ymin"),
        F.array_max(F.transform(edge_array, ys)).alias("ymax"),
    )


def contains(edge_array: Column, box: Column, x: Column, y: Column) -> Column:
    """Even-odd test: an odd number of edges to the right of the point. Holes and separate parts work
    by themselves. A point exactly on an edge may fall either way."""
    crossings = F.aggregate(
        edge_array,
        F.lit(0),
        lambda n, e: n
        + F.when(
            ((e["y1"] > y) != (e["y2"] > y))
            & (x < F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]),
            1,
        ).otherwise(0),
    )
    inside_box = x.between(box["xmin"], box["xmax"]) & y.between(box["ymin"], box["ymax"])
    return inside_box & (crossings % 2 == 1)


def cell(v: Column, size: float | Column) -> Column:
    return F.floor(v / size).cast("bigint")
