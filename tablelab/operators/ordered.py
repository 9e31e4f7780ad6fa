"""Ranks, running totals and top-n that stay spread out when one key owns most of the rows.

A plain window sorts each key in one task. Here every key is cut into slices of its order columns.
The cut points are quantiles over the whole table, so a slice holds about ``rows / slices`` rows
whatever the key distribution. Totals of earlier slices are added by a join on (keys, slice).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

SLICE = "__slice"


def _parse(order: Sequence[str]) -> list[tuple[str, bool]]:
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``["a", "-b"]`` → ``[a asc, b desc]``."""
    return [F.col(c).desc() if down else F.col(c).asc() for c, down in _parse(order)]


def _code(df: DataFrame, name: str) -> tuple[Column, bool]:
    """A double that never decreases when the column grows, and whether equal codes mean equal values."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double"), True
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double"), True
    if isinstance(kind, T.TimestampNTZType):
        # Wall-clock microseconds, free of any session time zone.
        whole = F.unix_date(F.to_date(col)) * F.lit(86_400) + F.hour(col) * 3600 + F.minute(col) * 60
        micros = (F.date_part(F.lit("SECOND"), col) * 1_000_000).cast("long")
        return (whole.cast("long") * 1_000_000 + micros).cast("double"), True
    if isinstance(kind, T.DecimalType):
        return col.cast("double"), False
    return col.cast("double"), True


def _filler(kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(kind)
    return F.lit("").cast(kind) if isinstance(kind, T.StringType) else F.lit(0).cast(kind)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _text_cuts(df: DataFrame, name: str, slices: int, per_slice: int = 40) -> list[str]:
    """Cut points of a text column, as whole values: quantiles of the ``per_slice * slices`` rows with the
    smallest hashes. The sample only places the cuts; every row is sliced."""
    mark = F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))])
    drawn = df.select(name, mark.alias("__mark")).filter(F.col(name).isNotNull()).orderBy("__mark").limit(per_slice * slices)
    # UTF-8 bytes sort as Spark sorts texts
    values = sorted((r[0] for r in drawn.select(name).collect()), key=lambda v: v.encode("utf-8", "surrogatepass"))
    picked = [values[len(values) * i // slices] for i in range(1, slices)] if values else []
    return list(dict.fromkeys(picked))


def _text_bin(col: Column, points: Sequence[str]) -> tuple[Column, Column]:
    """Number of a text's bin (odd: a cut value alone, -1: NULL) and whether it is such a bin."""
    if not points:
        return F.when(col.isNull(), -1).otherwise(0), F.lit(False)
    step = max(1, math.isqrt(len(points)))
    all_points, coarse = (F.array(*[F.lit(p) for p in ps]) for ps in (points, points[step - 1 :: step]))
    # blocks of cuts first, then the cuts of one block: two short searches for each row
    start = F.size(F.filter(coarse, lambda p: p < col)) * step
    below = start + F.size(F.filter(F.slice(all_points, start + 1, F.lit(step)), lambda p: p < col))
    single = F.coalesce(F.get(all_points, below) == col, F.lit(False))
    return F.when(col.isNull(), -1).otherwise(2 * below + single.cast("int")), single


def quantile_cuts(df: DataFrame, columns: Sequence[str], slices: int) -> dict[str, list]:
    """At most ``slices - 1`` cut points per column: one mergeable sketch pass for all columns but texts."""
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    coded = [c for c in columns if not _is_text(df, c)]
    found: dict[str, list] = {c: _text_cuts(df, c, slices) for c in columns if _is_text(df, c)}
    if coded:
        accuracy = F.lit(max(10_000, 10 * slices))
        row = df.agg(*[F.percentile_approx(_code(df, c)[0], shares, accuracy).alias(f"q{i}") for i, c in enumerate(coded)]).first()
        for i, c in enumerate(coded):
            found[c] = sorted({v for v in (row[f"q{i}"] or []) if not math.isnan(v) and not math.isinf(v)})
    return found


def default_slices(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions, so they grow with the cluster's setting."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_slices(
    df: DataFrame,
    order: Sequence[str],
    slices: int | None = None,
    cuts: dict[str, list] | None = None,
) -> DataFrame:
    """Add the slice (bin numbers of the order columns); sorting by (slice, order columns) equals sorting by
    the order columns, for any number of them.

    A cut value gets a slice of its own, so a value so frequent that it is a cut holds nothing but
    itself there, and that slice is divided again by the next order column.
    """
    slices = slices or default_slices(df)
    parsed = _parse(order)
    cuts = cuts or quantile_cuts(df, [c for c, _ in parsed], slices)
    out, numbers, alone = df, [], F.lit(True)
    for i, (name, down) in enumerate(parsed):
        points = cuts.get(name, [])
        if _is_text(df, name):
            number, single = _text_bin(F.col(name), points)
            numbers.append(F.when(alone, -number if down else number).otherwise(0))
            alone = alone & single
            continue
        code, exact = _code(df, name)
        splits = [-math.inf]
        for p in points:
            if p > splits[-1]:
                splits += [p, math.nextafter(p, math.inf)]
        splits.append(math.inf)
        raw, bin_ = f"__code{i}", f"__bin{i}"
        out = out.withColumn(raw, code)
        if len(splits) > 2:
            out = Bucketizer(splits=splits, inputCol=raw, outputCol=bin_, handleInvalid="keep").transform(out)
            number = F.when(F.col(raw).isNull(), -1).otherwise(F.col(bin_)).cast("long")
        else:
            number = F.when(F.col(raw).isNull(), -1).otherwise(0).cast("long")
        numbers.append(F.when(alone, -number if down else number).otherwise(0))
        if exact and len(splits) > 2:
            # Odd bins hold a cut value alone; beyond 2^53 two whole numbers may share a code.
            alone = alone & (F.coalesce(F.col(bin_), F.lit(0.0)) % 2 == 1) & (F.abs(F.col(raw)) < 2.0**53)
        else:
            alone = F.lit(False)
    return out.withColumn(SLICE, F.array(*[n.cast("long") for n in numbers])).select(*df.columns, SLICE)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    slices: int | None = None,
    cuts: dict[str, list[float]] | None = None,
    staged: bool = False,
) -> DataFrame:
    """Inclusive running sum of each expression in ``sums``, per key, in the given order.

    Rows of one key must differ in the order columns, else the order among equals is arbitrary.
    The input is read three times (cut points, slice totals, rows). ``staged=True`` writes it to the
    shared folder first, which pays off whenever it is more than a scan.
    """
    if staged:
        df = stage(df, "running")
    names = list(sums)
    # NULL-free stand-ins of the keys: the window and the join then hash the same columns.
    stand_ins: dict[str, Column] = {}
    for i, k in enumerate(keys):
        stand_ins[f"__k{i}"] = F.coalesce(F.col(k), _filler(df.schema[k].dataType))
        stand_ins[f"__n{i}"] = F.col(k).isNull()
    sliced = with_slices(df, order, slices, cuts).withColumns({**stand_ins, **{f"__v_{n}": sums[n] for n in names}})
    part = [*stand_ins, SLICE]
    per_slice = sliced.groupBy(*part).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in names])
    # One row per (key, slice): few rows per key, however many rows the key has.
    before = Window.partitionBy(*(list(stand_ins) or [F.lit(0)])).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    base = per_slice.select(*part, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in names])
    inside = Window.partitionBy(*part).orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({f"__l_{n}": F.sum(f"__v_{n}").over(inside) for n in names})
    kept = [c for c in df.columns if c not in names]
    return local.join(base, part, "inner").select(*kept, *[(F.col(f"__l_{n}") + F.col(f"__b_{n}")).alias(n) for n in names])


def row_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    slices: int | None = None,
    cuts: dict[str, list[float]] | None = None,
    staged: bool = False,
) -> DataFrame:
    """1-based row number per key; ``keys=[]`` numbers the whole table without a single-task sort."""
    return running_totals(df, keys, order, {out: F.lit(1).cast("long")}, slices, cuts, staged)


def previous_values(
    df: DataFrame, keys: Sequence[str], position: str, values: dict[str, str]
) -> DataFrame:
    """Columns of the row before under new names, found by its position number; NULL on the first row."""
    prior = df.select(
        *keys, (F.col(position) + 1).alias(position), *[F.col(c).alias(n) for n, c in values.items()]
    )
    return df.join(prior, [*keys, position], "left")


def keep_group_value(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Attach group aggregates to every row: map-side aggregation, then a join back on the keys."""
    return df.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]), list(keys), "inner")


def top_with_ties(df: DataFrame, score: str, k: int, keys: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """The k best rows of the table, or of each key, plus every row equal to the k-th.

    Only k rows per task travel to find the k-th score; the rows themselves are then filtered in
    place, so any number of ties stays distributed.
    """
    best = F.col(score).desc_nulls_last() if largest else F.col(score).asc_nulls_last()
    edge = F.min(score) if largest else F.max(score)
    if not keys:
        cut = df.select(score).orderBy(best).limit(k).agg(edge.alias("cut")).scalar()
        return df.filter(F.col(score) >= cut if largest else F.col(score) <= cut)
    w = Window.partitionBy(*keys).orderBy(best)
    cuts = (
        df.select(*keys, score)
        .withColumn("__r", F.row_number().over(w))
        .filter(F.col("__r") <= k)
        .groupBy(*keys)
        .agg(edge.alias("__cut"))
    )
    kept = df.join(cuts, list(keys), "inner")
    return kept.filter(F.col(score) >= F.col("__cut") if largest else F.col(score) <= F.col("__cut")).drop("__cut")


def kth_largest(df: DataFrame, score: str, k: int) -> DataFrame:
    """One row holding the k-th largest score (the smallest one when there are fewer rows)."""
    return df.select(score).orderBy(F.col(score).desc()).limit(k).agg(F.min(score).alias("threshold"))
