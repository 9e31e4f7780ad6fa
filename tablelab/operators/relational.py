"""Relational helpers: joins, grouped statistics, set operations, reshaping, profiling."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import keep_group_value, running_totals


def feature_columns(df: DataFrame, exclude: Iterable[str] = (), add: Iterable[str] = ()) -> list[str]:
    """Columns of ``df`` minus ``exclude`` plus ``add``, in table order."""
    gone = set(exclude)
    kept = [c for c in df.columns if c not in gone]
    return kept + [c for c in add if c not in kept]


def union_positional(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Columns one side lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lookup_or_same(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """Replace ``column`` by its mapped value; values without a mapping stay as they are.

    The planner broadcasts the mapping while it is below the session's size threshold and shuffles it
    beyond that.
    """
    m = mapping.select(F.col(source).alias("__from"), F.col(target).alias("__to"))
    joined = df.join(m, F.col(column) == F.col("__from"), "left")
    return joined.withColumn(column, F.coalesce("__to", column)).drop("__from", "__to")


def keep_listed(df: DataFrame, column: str, listing: DataFrame) -> DataFrame:
    """Rows whose value is in the one-column table ``listing``."""
    return df.join(listing.toDF(column), column, "left_semi")


def drop_listed(df: DataFrame, column: str, listing: DataFrame) -> DataFrame:
    """Rows whose value is not in ``listing``; rows with NULL stay."""
    return df.join(listing.toDF(column), column, "left_anti")


def join_suffixed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, suffixes=("_x", "_y")) -> DataFrame:
    """Join where non-key columns present on both sides get a suffix instead of clashing."""
    clash = set(left.columns) & set(right.columns) - set(keys)
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return a.join(b, list(keys), how)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key; the filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def co_group_summaries(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_aggs: dict[str, Column], right_aggs: dict[str, Column]
) -> DataFrame:
    """Both sides reduced per key, then joined one row to one row, so no pairs are formed."""
    a = left.groupBy(*keys).agg(*[c.alias(n) for n, c in left_aggs.items()])
    b = right.groupBy(*keys).agg(*[c.alias(n) for n, c in right_aggs.items()])
    return a.join(b, list(keys), "inner")


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def weighted_tally(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Sum over the rows of a key of that key's own count, which is the count squared."""
    n = F.count("*")
    return df.groupBy(key).agg((n * n).alias(out))


def conditional_count(condition: Column) -> Column:
    """Number of rows where the condition holds, in the same pass as other aggregates."""
    return F.count_if(condition)


def distinct_with_null(col: Column) -> Column:
    """Distinct values, NULL counted as one of them."""
    return F.count_distinct(col) + F.max(col.isNull().cast("int"))


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """count, mean, population standard deviation, min, max in one pass."""
    c = F.col(column)
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_pop(c).alias("stdev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def share_of_total(df: DataFrame, count: str, total_of: DataFrame, out: str = "perc", digits: int = 2) -> DataFrame:
    """``count`` as a percentage of the number of rows of ``total_of``."""
    total = total_of.agg(F.count("*").alias("t")).scalar()
    return df.withColumn(out, F.round(F.lit(100.0) * F.col(count) / total, digits))


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts with one column per given value, 0 where a combination is absent."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0)


def with_group_count(df: DataFrame, keys: Sequence[str], out: str = "wc") -> DataFrame:
    return keep_group_value(df, keys, {out: F.count("*")})


def with_group_max(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    return keep_group_value(df, keys, {out: F.max(column)})


def long_from_wide(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def value_frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value occurs anywhere in the listed columns."""
    values = F.explode(F.array(*[F.col(c).cast("double") for c in columns])).alias("value")
    return df.select(values).groupBy("value").agg(F.count("*").alias("n"))


def mean_of_groups(df: DataFrame, keys: Sequence[str], score: Column, out: str = "mean_score") -> DataFrame:
    """Mean over groups of a per-group score."""
    return df.groupBy(*keys).agg(score.alias("__s")).agg(F.avg("__s").alias(out))


def grouped_strings(df: DataFrame, key: str, item: str, keep: Column, out: str, empty: str = "None") -> DataFrame:
    """Kept items of each key in ascending order, joined by spaces; ``empty`` where nothing is kept.

    Items that are not kept are dropped before the shuffle. The text of a key is one result cell.
    """
    from ..functions.scalars import default_if_empty

    kept = F.when(keep, F.col(item))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda v: v.cast("string")), " ")
    return df.groupBy(key).agg(default_if_empty(text, empty).alias(out))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> DataFrame:
    """Interpolated quantiles ``q0, q1, ...`` of one column as one row.

    Values are counted first, then numbered by running totals, so neither one task nor one
    aggregation buffer ever holds the column.
    """
    x = df.select(F.col(column).cast("double").alias("x")).filter("x is not null")
    counts = x.groupBy("x").agg(F.count("*").alias("n"))
    ranked = running_totals(counts, [], ["x"], {"upto": F.col("n")})
    total = x.agg(F.count("*").alias("t")).scalar()
    ranked = ranked.withColumn("t", total)
    picks = []
    for i, q in enumerate(shares):
        spot = (F.col("t") - 1) * F.lit(float(q))
        low = F.min(F.when(F.col("upto") > F.floor(spot), F.col("x")))
        high = F.min(F.when(F.col("upto") > F.ceil(spot), F.col("x")))
        part = F.max(spot - F.floor(spot))
        picks.append((low + (high - low) * part).alias(f"q{i}"))
    return ranked.agg(*picks)


def _brackets(df: DataFrame, columns: Sequence[str], shares: Sequence[float], margin: float) -> tuple[dict, dict]:
    """One pass: count, ends and mean of each column, and values a little below and above each wanted place."""
    places = [p for q in shares for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    picks = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        near = F.percentile_approx(x, F.array(*[F.lit(float(p)) for p in places]), F.lit(10_000))
        picks.append(F.struct(F.count(x).alias("n"), F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max"), near.alias("near")).alias(f"c{i}"))
    row = df.agg(*picks).first()
    return {i: row[f"c{i}"] for i in range(len(columns))}, {(i, j): (row[f"c{i}"]["near"] or [None] * len(places))[2 * j : 2 * j + 2] for i in range(len(columns)) for j in range(len(shares))}


def quantiles_of(df: DataFrame, columns: Sequence[str], shares: Sequence[float], margin: float = 0.002) -> DataFrame:
    """Exact interpolated quantiles of many columns in three scans: ``column, n, min, mean, max, q0, q1, ...``.

    The first scan brackets every wanted place between two values by a sketch, the second counts the values below and
    inside each bracket, the third numbers the values inside, equal ones together. A bracket that misses its place
    is widened to the whole column, so the result is exact whatever the sketch returns. ``df`` must give the same rows
    in each scan. NULLs are left out; a column without values has NULL quantiles; NaN is the largest value.
    """
    stats, near = _brackets(df, columns, shares, margin)
    near = {at: ends for at, ends in near.items() if stats[at[0]]["n"]}
    sums = []
    for (i, j), (low, high) in near.items():
        x = F.col(columns[i]).cast("double")
        sums += [F.count_if(x < low).alias(f"below_{i}_{j}"), F.count_if(x <= high).alias(f"upto_{i}_{j}")]
    counted = df.agg(*sums).first() if sums else {}
    targets, members = [], []
    for (i, j), (low, high) in near.items():
        n, x = stats[i]["n"], F.col(columns[i]).cast("double")
        spot = (n - 1) * float(shares[j])
        first, second, below = math.floor(spot), math.ceil(spot), counted[f"below_{i}_{j}"]
        hit = below <= first and second < counted[f"upto_{i}_{j}"]
        inside = (x >= low) & (x <= high) if hit else x.isNotNull()
        targets.append((i, j, first - below if hit else first, second - below if hit else second, spot - first))
        members.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), x.alias("x"))))
    spark = df.sparkSession
    kept = [(i, c, int(s["n"]), s["min"], s["mean"], s["max"]) for i, c in enumerate(columns) for s in [stats[i]]]
    out = spark.createDataFrame(kept, "i int, column string, n long, min double, mean double, max double")
    if not targets:
        return out.select("column", "n", "min", "mean", "max", *[F.lit(None).cast("double").alias(f"q{j}") for j in range(len(shares))])
    values = df.select(F.explode(F.array_compact(F.array(*members))).alias("m")).groupBy("m.i", "m.j", "m.x").agg(F.count("*").alias("n"))
    ranked = running_totals(values, ["i", "j"], ["x"], {"upto": F.col("n")}, staged=True)
    wanted = spark.createDataFrame(targets, "i int, j int, first long, second long, part double")
    found = ranked.join(wanted, ["i", "j"]).groupBy("i", "j").agg(
        F.min(F.when(F.col("upto") > F.col("first"), F.col("x"))).alias("low"),
        F.min(F.when(F.col("upto") > F.col("second"), F.col("x"))).alias("high"), F.max("part").alias("part"))
    value = F.when(F.col("part") == 0, F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part"))
    wide = found.groupBy("i").agg(*[F.max(F.when(F.col("j") == j, value)).alias(f"q{j}") for j in range(len(shares))])
    return out.join(wide, "i", "left").select("column", "n", "min", "mean", "max", *[f"q{j}" for j in range(len(shares))])


def five_numbers(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """min, quartiles, mean and max per column, one row per column.

    ``exact=False`` takes the quartiles from a mergeable sketch in one single pass.
    """
    shares = [0.25, 0.5, 0.75]
    if exact:
        found = quantiles_of(df, columns, shares)
    else:
        rows = []
        for c in columns:
            x = F.col(c).cast("double")
            sketch = F.percentile_approx(x, F.array(*[F.lit(s) for s in shares]))
            rows.append(F.struct(F.lit(c).alias("column"), F.min(x).alias("min"), F.avg(x).alias("mean"), F.max(x).alias("max"),
                                 *[F.get(sketch, i).alias(f"q{i}") for i in range(3)]))
        found = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    return found.select("column", "min", F.col("q0").alias("q1"), F.col("q1").alias("median"), "mean", F.col("q2").alias("q3"), "max")


def profile(df: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, min, max, and mean where numeric.

    Exact distinct values are counted column by column: each one is a scan of that column alone, whose values meet without
    those of the others, so no task sorts rows that carry all columns. ``df`` must give the same rows in each scan.
    """

    rows, parts = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        numeric = isinstance(f.dataType, T.NumericType)
        plain = isinstance(f.dataType, T.AtomicType)
        text = c.cast("string")
        rows.append(
            F.struct(
                F.count("*").alias("rows"),
                F.count_if(c.isNull()).alias("nulls"),
                (F.approx_count_distinct(c) if plain and approximate_distinct else F.lit(None)).cast("bigint").alias("distinct"),
                (F.min(c).cast("string") if plain else F.min(text)).alias("min"),
                (F.max(c).cast("string") if plain else F.max(text)).alias("max"),
                (F.avg(c) if numeric else F.lit(None)).cast("double").alias("mean"),
            ).alias(f"c{i}")
        )
        found = {n: F.col(f"c{i}.{n}") for n in ("rows", "nulls", "distinct", "min", "max", "mean")}
        if plain and not approximate_distinct:
            found["distinct"] = df.select(c.alias("value")).distinct().agg(F.count("value")).scalar()
        parts.append(F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), *[x.alias(n) for n, x in found.items()]))
    return df.agg(*rows).select(F.inline(F.array(*parts)))
