"""Nested sensor documents: typing, averages per type, map layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import later_rule_wins
from ..functions.spatial import geojson_point

M = "measures.measures"


def with_sensor_type(docs: DataFrame) -> DataFrame:
    """Temperature, rain or wind from the fields a document has; of several rules the last wins."""
    rules = [
        (F.get(F.col(f"{M}.type"), F.lit(0)) == "temperature", "temperature"),
        (F.col(f"{M}.rain_60min").isNotNull(), "rain"),
        (F.col(f"{M}.wind_strength").isNotNull(), "wind"),
    ]
    return docs.withColumn("sensorType", later_rule_wins(rules, F.lit(None).cast("string")))


def unwind_values(docs: DataFrame) -> DataFrame:
    """One row per reading: ``_id, sensorType, value``."""
    return docs.select("_id", "sensorType", F.explode(f"{M}.res.value").alias("value"))


def average_by_type(docs: DataFrame, sensor_type: str) -> DataFrame:
    typed = docs.filter(F.col("sensorType") == sensor_type)
    return unwind_values(typed).groupBy("sensorType").agg(F.avg("value").alias("total"))


def positive_rain_average(docs: DataFrame) -> DataFrame:
    wet = docs.filter((F.col("sensorType") == "rain") & (F.col(f"{M}.rain_24h") > 0))
    return wet.groupBy("sensorType").agg(F.avg(f"{M}.rain_24h").alias("total"))


def location_layer(docs: DataFrame, sensor_type: str) -> DataFrame:
    """Documents of one type with a GeoJSON point ``location``, ready to append to a map collection."""
    return docs.filter(F.col("sensorType") == sensor_type).withColumn("location", geojson_point(F.col("place.location")))
