"""Feature transforms: string indexes, one-hot groups, scaling, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import index_of_one
from .ordered import row_positions


def factor_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """0-based level number of each value in alphabetic order."""
    levels = row_positions(df.select(column).distinct(), [], [column], "__level")
    return df.join(levels, column, "left").withColumn(out, (F.col("__level") - 1).cast("int")).drop("__level")


def frequency_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """0-based index of each value by falling frequency, ties in alphabetic order."""
    counts = df.groupBy(column).agg(F.count("*").alias("__n"))
    levels = row_positions(counts, [], ["-__n", column], "__level").drop("__n")
    return df.join(levels, column, "left").withColumn(out, (F.col("__level") - 1).cast("int")).drop("__level")


def one_hot(index: Column, size: int, drop_last: bool = True) -> Column:
    """Indicator array of an index column; the last category is all zeros when dropped."""
    width = size - 1 if drop_last else size
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (i == index).cast("double"))


def merge_one_hot(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each group of 0/1 columns by one index column."""
    gone = [c for cols in groups.values() for c in cols]
    return df.withColumns({g: index_of_one([F.col(c) for c in cols]) for g, cols in groups.items()}).drop(*gone)


def scale_by_stdev(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Divide each column by its sample standard deviation (0 where that is 0); no centring."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    scale = {c: (0.0 if not row[c] else 1.0 / row[c]) for c in columns}
    return df.withColumns({c: F.col(c) * F.lit(scale[c]) for c in columns})


def mean_vector(df: DataFrame, column: str, size: int) -> Column:
    """Element-wise mean of an array column as a constant array (``size`` numbers reach the driver)."""
    row = df.agg(*[F.avg(F.get(column, i).cast("double")).alias(f"m{i}") for i in range(size)]).first()
    return F.array(*[F.lit(row[f"m{i}"]) for i in range(size)])


def project(df: DataFrame, columns: Sequence[str], matrix: Sequence[Sequence[float]], names: Sequence[str]) -> DataFrame:
    """``data x matrix``: one dot-product column per matrix column."""
    outs = {}
    for j, n in enumerate(names):
        dot = F.lit(0.0)
        for i, c in enumerate(columns):
            dot = dot + F.col(c) * F.lit(float(matrix[i][j]))
        outs[n] = dot
    return df.withColumns(outs)


def projection_matrix(rows: int, dims: int = 3, seed: int = 42) -> list[list[float]]:
    """Seeded normal draws, each row divided by its length."""
    import numpy as np

    m = np.random.default_rng(seed).normal(size=(rows, dims))
    return (m / np.sqrt((m**2).sum(axis=1, keepdims=True))).tolist()
