"""Repeatable samples and splits. Hash variants give the same rows on any cluster and in any engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hash_bucket


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def hashed_split(df: DataFrame, keys: Sequence[tuple[Column, int]], shares: Sequence[float], seed: int = 0) -> list[DataFrame]:
    """Split by hashed key into parts of the given shares (in thousandths); no row is drawn twice."""
    bucket = hash_bucket(keys, seed, 1000)
    parts, low = [], 0
    total = sum(shares)
    for i, s in enumerate(shares):
        high = 1000 if i == len(shares) - 1 else low + round(1000 * s / total)
        parts.append(df.filter((bucket >= low) & (bucket < high)))
        low = high
    return parts


def bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(False, fraction, seed)


def key_sample(df: DataFrame, key: str, n: int, seed: int = 2222) -> DataFrame:
    """n distinct keys, the same ones on every run; each task keeps only its n smallest hashes."""
    keys = df.select(key).distinct()
    h = hash_bucket([(F.col(key), 7919)], seed, 1_000_003)
    return keys.orderBy(h, key).limit(n)


def holdout(df: DataFrame, key: str, sampled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows outside the sampled keys, rows of the sampled keys)."""
    return df.join(sampled, key, "left_anti"), df.join(sampled, key, "left_semi")


def random_draws(df: DataFrame, seed: int) -> DataFrame:
    """A 0/1 draw and a normal draw per row."""
    return df.withColumns({"coin": (F.rand(seed) < 0.5).cast("int"), "gauss": F.randn(seed + 1)})
