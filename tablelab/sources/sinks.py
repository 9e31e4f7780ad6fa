"""Writers. Every one is a single distributed write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["write_csv", "append_collection", "write_raster_levels", "write_images"]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files, each with the header and no row names."""
    df.write.option("header", True).csv(path)


def append_collection(df: DataFrame, path: str) -> None:
    """Append all rows of ``df`` to the named collection in one job."""
    df.write.mode("append").parquet(path)


def write_raster_levels(levels: DataFrame, path: str, layer: str) -> None:
    """One folder per layer and zoom, so reading a level touches only that level."""
    levels.withColumn("layer", F.lit(layer)).write.partitionBy("layer", "zoom").mode("append").parquet(path)


def write_images(df: DataFrame, path: str) -> None:
    df.select("label", "pixels").write.parquet(path)
