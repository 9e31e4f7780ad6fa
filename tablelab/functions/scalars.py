"""Scalar helpers on Columns. All are built-in expressions; none raises under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(col: Column) -> Column:
    """NULL instead of an error for malformed numbers."""
    return F.trim(col).try_cast("int")


def safe_long(col: Column) -> Column:
    return F.trim(col).try_cast("bigint")


def safe_double(col: Column) -> Column:
    return F.trim(col).try_cast("double")


def split_fields(col: Column, delimiter: str, *names: str) -> list[Column]:
    """Split on a regular expression and name the parts; a missing part is NULL."""
    parts = F.split(col, delimiter)
    return [F.get(parts, i).alias(n) for i, n in enumerate(names)]


def before_first(col: Column, separator: str) -> Column:
    """Text before the first separator, all of it when there is none."""
    return F.substring_index(col, separator, 1)


def after_first(col: Column, separator: str) -> Column:
    """Text from the first separator on (separator included), trimmed; empty when there is none."""
    at = F.instr(col, separator)
    return F.when(at > 0, F.trim(F.substr(col, at + len(separator)))).otherwise("")


def ratio(a: Column, b: Column, default: float | None = 0.0) -> Column:
    """``a / b``; the default where it is undefined."""
    r = F.try_divide(a.cast("double"), b.cast("double"))
    return r if default is None else F.coalesce(r, F.lit(default))


def default_if_empty(col: Column, default: str) -> Column:
    return F.when(col.isNull() | (col == ""), F.lit(default)).otherwise(col)


def flag_present(col: Column) -> Column:
    return col.isNotNull().cast("int")


def later_rule_wins(rules: Sequence[tuple[Column, object]], default: Column | None = None) -> Column:
    """Ordered conditional updates of one field: of several matching rules the last one decides."""
    out = default if default is not None else F.lit(None)
    for condition, value in rules:
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two numeric arrays."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, v: s + v
    )


def scale_array(col: Column, divisor: float) -> Column:
    return F.transform(col, lambda v: v / F.lit(float(divisor)))


def index_of_one(cols: Sequence[Column]) -> Column:
    """Position of the 1 in a one-hot group, counted from 0; -1 if there is none."""
    return (F.array_position(F.array(*[c.cast("double") for c in cols]), 1.0) - 1).cast("int")


def count_regex(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern))


def count_literal(col: Column, text: str) -> Column:
    """Number of non-overlapping occurrences of a fixed text."""
    return F.regexp_count(col, F.lit("\\Q" + text + "\\E"))


def replace_all(col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) pairs in order."""
    return reduce(lambda c, r: F.regexp_replace(c, r[0], r[1]), rules, col)


def lacks_match(col: Column, pattern: str) -> Column:
    return ~col.rlike(pattern)


HASH_PRIME = (1 << 31) - 1
HASH_FACTOR = 1_103_515_245


def hash_bucket(keys: Sequence[tuple[Column, int]], seed: int, modulus: int) -> Column:
    """Plain integer arithmetic on keys: the same number in any engine and on every run.

    The weighted sum of the keys is squared modulo a prime, so that neighbouring keys do not fall into stripes.
    """
    total = F.lit(seed * 104_729).cast("bigint")
    for col, factor in keys:
        total = total + col.cast("bigint") * factor
    prime = F.lit(HASH_PRIME).cast("bigint")
    mixed = F.pmod(total, prime) * F.lit(HASH_FACTOR).cast("bigint") % prime
    return mixed * mixed % prime % F.lit(modulus).cast("bigint")
