"""Readers for the file formats the analyses start from. Schemas are explicit, so no extra pass infers them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "read_lines",
    "read_csv_positional",
    "read_csv_strings",
    "read_csv_typed",
    "read_tsv",
    "read_json_documents",
    "read_areas",
    "read_raster_cells",
    "read_images",
    "register_view",
]


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per text line in ``value``."""
    return spark.read.text(path)


def read_csv_positional(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV without a header. ``schema`` saves the inference pass; without it types are inferred."""
    reader = spark.read.option("header", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path).toDF(*names)


def read_csv_strings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header, every column a string. Several paths (one file per month) read as one table."""
    return spark.read.csv(path, header=True, multiLine=False)


def read_csv_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """CSV with a header and given types."""
    return spark.read.csv(path, header=True, schema=schema)


def read_tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Tab-separated file with a header; strings unless a schema is given."""
    return spark.read.csv(path, header=True, sep="\t", schema=schema)


def read_json_documents(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """JSON lines with nested objects and arrays; an absent field becomes NULL."""
    return spark.read.schema(schema).json(path)


def read_areas(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """GeoJSON features, one per line → ``name, kind, geojson``; feed it to ``polygon_edges``."""
    lines = spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.properties.name").alias("name"),
        F.get_json_object("value", "$.geometry.type").alias("kind"),
        F.col("value").alias("geojson"),
    )


def read_raster_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cell table ``col, row, value`` (plus partition columns such as layer and zoom)."""
    return spark.read.parquet(path)


def read_images(spark: SparkSession, path: str, side: int = 28) -> DataFrame:
    """``label, pixels`` where pixels may be nested rows; they come back flat, ``side * side`` long."""
    df = spark.read.parquet(path)
    kind = df.schema["pixels"].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        df = df.withColumn("pixels", F.flatten("pixels"))
    return df.filter(F.size("pixels") == side * side)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make the frame available to SQL text under ``name``."""
    df.createOrReplaceTempView(name)
    return df
