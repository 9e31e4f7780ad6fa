"""Sampling documents so that token shares meet target marginals, in DataFrame functions only.

Tokens are counted in cells (one for each combination of the marginal columns). Iterative proportional fitting
rakes the cells' shares of the sample: each step brings every level of one column to its target share, one column after
another, until the largest miss of a margin is small. A cell cannot give more tokens than it has: cells at that bound
stay there and the others of a level take what is left of its target, so the bound is part of the fit and not cut off
afterwards. A cell's share of the budget over its own tokens is its rate; each document is kept if a number drawn from its id
falls below its cell's rate. ``attained`` puts the expected shares next to the wanted ones; a level misses its target
only if all its tokens are not enough, or no sample meets all margins at once.

Cells stay a table, however many sources there are. Levels without a target share what the named levels
leave, in proportion to their tokens; targets of levels that have no tokens are left out and the others
scaled up. If the named levels leave nothing, the others keep the share of tokens they have and the named ones are
scaled to the rest, so no level is lost because it was not named.

Defined cases: null levels are a level of their own; null and empty texts have 0 tokens and go with their cell's
rate; cells without tokens have rate 1; repeated rows are drawn alike; rows with a null id are drawn by the
empty id; the empty table gives the empty table. Columns n_tokens, rate and kept of the input are replaced; other names never
clash, as names used inside are made new.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab import session

NONE = "(none)"


def tokens(text: str = "text") -> Column:
    """Number of blank-separated words."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1).cast("long")


def _shares(cells: DataFrame, column: str, targets: dict[str, float]) -> DataFrame:
    """Target share of each level that has tokens: column, share (sum 1)."""
    levels = cells.groupBy(column).agg(F.sum("n").alias("n")).where("n > 0")
    named = F.lit(None).cast("double")
    for level, share in targets.items():
        named = F.when(F.col(column) == level, F.lit(float(share))).otherwise(named)
    levels = levels.withColumn("named", named)
    given, rest, n = levels.agg(F.coalesce(F.sum("named"), F.lit(0.0)), F.coalesce(F.sum(F.when(F.col("named").isNull(), F.col("n"))), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    left = max(0.0, 1.0 - given) if rest else 0.0
    if rest and left < 1e-9:  # sums of decimal shares may miss 1 by rounding
        left = given * rest / (n - rest)
    total = (given + left) or 1.0
    share = F.coalesce("named", F.lit(left) * F.col("n") / F.lit(max(rest, 1))) / F.lit(total)
    return levels.select(column, share.alias("share"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], budget: float, rounds: int = 40, miss: float = 1e-4) -> DataFrame:
    """Cells (the columns of ``targets``, n) with w, the share of the sample, and rate, the share of its tokens kept; stored.

    Stops when no margin misses its target by more than ``miss``, or no longer comes closer.
    """
    columns = list(targets)
    wanted = {c: session.stage(_shares(cells, c, targets[c]), "shares") for c in columns}
    total = cells.agg(F.sum("n")).first()[0] or 1
    size = F.lit(float(total) * budget)
    out = session.stage(cells.where("n > 0").withColumns({"w": F.col("n") / F.lit(float(total)), "most": F.col("n") / size}), "raked")
    before = None
    for _ in range(rounds):
        for c in columns:
            out = _fit(out, c, wanted[c])
        out = session.stage(out, "raked")  # the plan of a round starts at a table
        now = max(_miss(out, c, wanted[c]) for c in columns)
        if now <= miss or (before is not None and before - now <= miss / 100):
            break
        before = now
    return out.withColumn("rate", F.least(F.lit(1.0), F.col("w") * size / F.col("n"))).drop("most")


def _fit(cells: DataFrame, c: str, wanted: DataFrame) -> DataFrame:
    """Bring the levels of one column to their shares; cells at their bound stay unless the level has too much."""
    full = F.col("w") >= F.col("most")
    now = cells.groupBy(c).agg(F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("full"), F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0.0)).alias("free"))
    now = now.join(wanted, c).select(c, (F.col("full") + F.col("free") > F.col("share")).alias("less"), "share", "full", "free")
    all_, rest = F.col("share") / (F.col("full") + F.col("free")), (F.col("share") - F.col("full")) / F.col("free")
    now = now.select(c, "less", F.when(F.col("less"), all_).when(F.col("free") > 0, rest).otherwise(1.0).alias("factor"))
    own = F.least("w", "most")
    w = F.when(full & ~F.col("less"), F.col("most")).otherwise(F.least("most", own * F.col("factor")))
    return cells.join(now, c).withColumn("w", w).drop("less", "factor")


def _miss(cells: DataFrame, c: str, wanted: DataFrame) -> float:
    both = cells.groupBy(c).agg(F.sum("w").alias("now")).join(wanted, c)
    return both.agg(F.coalesce(F.max(F.abs(F.col("now") - F.col("share"))), F.lit(0.0))).first()[0]


def attained(raked: DataFrame, targets: dict[str, dict[str, float]]) -> DataFrame:
    """column, level, wanted, attained: target shares and the expected shares of the sample's tokens."""
    out = None
    for c, named in targets.items():
        total = raked.agg(F.sum(F.col("n") * F.col("rate"))).first()[0] or 1.0
        own = raked.groupBy(F.col(c).alias("level")).agg((F.sum(F.col("n") * F.col("rate")) / F.lit(float(total))).alias("attained"))
        own = own.join(_shares(raked, c, named).withColumnRenamed(c, "level"), "level").select(F.lit(c).alias("column"), "level", F.col("share").alias("wanted"), "attained")
        out = own if out is None else out.unionByName(own)
    return out


def draw(doc_id: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id only."""
    digest = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def count_cells(rows: DataFrame, columns: list[str], n: Column) -> DataFrame:
    """Tokens ``n`` of each combination of levels; stored."""
    level = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c) for c in columns]
    return session.stage(rows.groupBy(*level).agg(F.sum(n).alias("n")), "cells")


def mix(documents: DataFrame, targets: dict[str, dict[str, float]], budget: float = 0.5, rounds: int = 40, seed: int = 7, counted: str | None = None) -> DataFrame:
    """All rows with their columns and n_tokens, rate (chance to be kept) and kept.

    ``targets``: for each marginal column of ``documents`` the target shares of its levels. ``counted``: a column that has the
    number of tokens already; else ``text`` is counted, once for the cells and once for the rows. Columns of the names that are added are
    replaced.
    """
    columns = list(targets)
    n = F.col(counted) if counted else tokens()
    table = session.stage(rake(count_cells(documents, columns, n), targets, budget, rounds), "rates")
    mark = uuid.uuid4().hex  # no column of the input has such a name
    table = table.select(*[F.col(c).alias(f"{c}_{mark}") for c in columns], F.col("rate").alias(f"rate_{mark}"))
    keys = [F.coalesce(documents[c].cast("string"), F.lit(NONE)) == table[f"{c}_{mark}"] for c in columns]
    rate = F.coalesce(f"rate_{mark}", F.lit(1.0))
    out = documents.join(table, keys, "left")
    names = [c for c in documents.columns if c not in ("n_tokens", "rate", "kept")]
    return out.select(*names, n.alias("n_tokens"), rate.alias("rate"), (draw("doc_id", seed) < rate).alias("kept"))
