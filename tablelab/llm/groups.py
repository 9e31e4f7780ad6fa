"""Links between sets that meet in a group, enough to tie all components that the group's links tie.

A group may be of any size. Rows of its largest component so far only meet the rows of other components: the
former are cut into blocks, the latter go to every block, so a large group of copies costs one pass over its rows.
Inside a cell, sizes and parity bitmaps (some bits a member) leave out nearly all pairs below the bound. Of the others only
a few of every two components are asked for, surest first; then the two count as tied. Whole sets decide. A group in
which they refuse what counted as tied is compared again, with more pairs of two components, until none is left: no
link is lost, and candidates stay in proportion to the rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm.components import components

U64 = np.uint64
SIDE_MAIN, SIDE_OTHER, SIDE_ALL = 0, 1, 2


def _width(n: int) -> int:
    """Bits of the bitmap of a set of n members; sets of similar size have this width, or half or twice it."""
    return max(256, 1 << int(8 * n - 1).bit_length())


def parity(members: np.ndarray) -> bytes:
    """Bit i is the parity of the number of members that fall on i."""
    bits = _width(len(members))
    return np.packbits((np.bincount((members >> U64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def bitmaps(sets: DataFrame) -> DataFrame:
    """sig, n, bits of ``sets`` (sig, n, members); stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [parity(np.frombuffer(m.as_buffer(), U64)) for m in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["sig", "n", "bits"])

    return session.stage(sets.select("sig", "n", "members").mapInArrow(run, "sig long, n long, bits binary"), "bitmaps")


def mixed(members: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (group, sig, component) of groups with several components, and the sizes of these groups; stored.

    Of groups with the same members one stays. ``sizes``: group, n, top (rows of the largest component), main (that component).
    """
    rows = members.select("group", "sig").join(label, "sig", "left").select("group", "sig", F.coalesce("component", "sig").alias("component"))
    rows = session.stage(rows, "members")
    by = rows.groupBy("group", "component").agg(F.count("*").alias("k"), F.bit_xor("sig").alias("x"), F.bit_xor(F.xxhash64("sig")).alias("y"))
    sizes = by.groupBy("group").agg(
        F.sum("k").alias("n"), F.max("k").alias("top"), F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("parts"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    once = sizes.where("parts > 1").groupBy("x", "y", "n").agg(F.min_by(F.struct("group", "top", "main"), "group").alias("g"))
    sizes = session.stage(once.select("g.group", "n", "g.top", "g.main"), "sizes")
    return rows.join(sizes.select("group"), "group", "left_semi"), sizes


def cells(rows: DataFrame, sizes: DataFrame, limit: int) -> DataFrame:
    """group, cell, side, sig, component: rows as they are to be compared, a cell at a time."""
    rows = rows.join(sizes, "group")
    main = F.col("component") == F.col("main")
    p, q = F.ceil(F.col("top") / limit), F.ceil((F.col("n") - F.col("top")) / limit)
    own = F.pmod(F.xxhash64("sig", F.lit(3)), F.when(main, p).otherwise(q))
    upto = lambda k: F.sequence(F.lit(0).cast("long"), k - 1)
    cell = lambda *x: F.xxhash64("group", *x)
    entry = lambda side, name: F.struct(F.lit(side).alias("side"), name.alias("cell"))
    whole = F.array(entry(SIDE_ALL, cell(F.lit("all"))))
    of_main = F.transform(upto(q), lambda j: entry(SIDE_MAIN, cell(F.lit("main"), own, j)))
    of_other = F.concat(
        F.transform(upto(p), lambda i: entry(SIDE_OTHER, cell(F.lit("main"), i, own))),
        F.transform(upto(q), lambda k: entry(SIDE_ALL, cell(F.lit("other"), F.least(k, own), F.greatest(k, own)))),
    )
    where = F.when(F.col("n") <= limit, whole).when(main, of_main).otherwise(of_other)
    return rows.select("group", "sig", "component", F.explode(where).alias("e")).select("group", "e.cell", "e.side", "sig", "component")


def _sift(cell: pd.DataFrame, root: Callable[[int], int], bounds, step: int = 64) -> Iterator[tuple[int, int]]:
    """Pairs (places in the cell) of different components that may be linked, surest first in each block of rows."""
    n, comp, side = (cell[c].to_numpy(np.int64) for c in ("n", "component", "side"))
    order = np.argsort(n, kind="stable")
    n, comp, side = n[order], comp[order], side[order]
    maps = [cell["bits"].iloc[i] for i in order]
    lengths = np.array([len(m) for m in maps])
    for width in np.unique(lengths):  # a partner's bitmap has this width, or folds to it
        base, wide = np.flatnonzero(lengths == width), np.flatnonzero(lengths == 2 * width)
        grid = np.frombuffer(b"".join(maps[i] for i in base), np.uint8).reshape(len(base), width)
        more = np.frombuffer(b"".join(maps[i] for i in wide), np.uint8).reshape(len(wide), 2 * width)
        both = np.concatenate([grid, more[:, :width] ^ more[:, width:]]).view(U64)
        index = np.concatenate([base, wide])
        size, sides = n[index], side[index]
        for lo in range(0, len(base), step):
            hi = min(lo + step, len(base))
            to = int(np.searchsorted(size, size[hi - 1] * 100 // bounds.percent, side="right"))
            who = np.array([root(int(c)) for c in comp[index[:to]]], np.int64)
            ok = who[lo:hi, None] != who[None, :]
            ok &= (sides[lo:hi, None] != sides[None, :to]) | (sides[lo:hi, None] == SIDE_ALL)
            ok &= bounds.percent * size[None, :to] <= 100 * size[lo:hi, None]
            ok &= np.arange(lo, hi)[:, None] < np.arange(to)[None, :]
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            x += lo
            differ = np.concatenate([np.bitwise_count(both[x[i : i + 4096]] ^ both[y[i : i + 4096]]).sum(1, dtype=np.int64) for i in range(0, len(x), 4096)])
            most = bounds.most_different(size[x], size[y])
            near = np.flatnonzero(differ <= most)
            for k in near[np.argsort(differ[near] / most[near].clip(1), kind="stable")]:
                yield int(order[index[x[k]]]), int(order[index[y[k]]])


def _pairs(rows: DataFrame, maps: DataFrame, bounds, each: int, rows_per_task: int = 20_000) -> DataFrame:
    """Candidates (group, a, b, tie) of the cells ``rows``; stored. ``tie``: from here on the two components counted as tied."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out, up, asked = [], {}, Counter()

        def root(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for _, cell in frame.sample(frac=1, random_state=each).groupby("cell", sort=False):
            sig, group, comp = (cell[c].to_numpy() for c in ("sig", "group", "component"))
            for i, j in _sift(cell, root, bounds):
                low, high = sorted((root(int(comp[i])), root(int(comp[j]))))
                if low == high:
                    continue
                asked[low, high] += 1
                tie = asked[low, high] >= each
                out.append((int(group[i]), *sorted((int(sig[i]), int(sig[j]))), tie))
                if tie:
                    up[high] = low
        return pd.DataFrame(out, columns=["group", "a", "b", "tie"]).astype({"group": np.int64, "a": np.int64, "b": np.int64, "tie": bool})

    rows = session.stage(rows, "cells")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // rows_per_task)
    # a set meets its bitmap once, whatever the number of its cells
    listed = rows.groupBy("sig").agg(F.collect_list(F.struct("group", "cell", "side", "component")).alias("e"))
    rows = listed.join(maps, "sig").select("sig", "n", "bits", F.inline("e")).withColumn("task", F.pmod("cell", F.lit(tasks)))
    return session.stage(rows.groupBy("task").applyInPandas(run, "group long, a long, b long, tie boolean"), "pairs")


def tie(members: DataFrame, label: DataFrame, sets: DataFrame | None, bounds, verified: Callable[[DataFrame], DataFrame], limit: int = 1024, maps: DataFrame | None = None) -> DataFrame:
    """Links (a, b) between rows of one group (columns group, sig of ``members``), beyond those in ``label`` (sig, component); stored.

    ``maps``: sig, n, bits of these rows at least, where they are known; ``sets`` may then be None.
    """
    links, each = None, 1
    while True:
        rows, sizes = mixed(members, label)
        if maps is None:  # only of sets that are compared
            maps = bitmaps(sets.join(rows.select("sig").distinct(), "sig", "left_semi"))
        pairs = _pairs(cells(rows, sizes, limit), maps, bounds, each)
        asked = pairs.select("a", "b").distinct()
        more = session.stage(verified(session.stage(asked, "asked")).select("a", "b"), "near")
        links = more if links is None else links.unionByName(more)
        # groups in which two components that counted as tied are not
        names = label if more.isEmpty() else label_of(label, more)
        ends = pairs.where("tie").join(names.select(F.col("sig").alias("a"), F.col("component").alias("x")), "a", "left").join(names.select(F.col("sig").alias("b"), F.col("component").alias("y")), "b", "left")
        wrong = session.stage(ends.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("group").distinct(), "wrong")
        if wrong.isEmpty():
            return links.distinct()
        members, label, each = rows.join(wrong, "group", "left_semi").select("group", "sig"), names, 16 * each


def label_of(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (sig, component) with the components that ``links`` (a, b) between rows tie together; stored."""
    both = links.select("a", "b")
    for c in ("a", "b"):
        own = label.select(F.col("sig").alias(c), F.col("component").alias(f"of_{c}"))
        both = both.join(own, c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
    both = session.stage(both.select("a", "b", "of_a", "of_b"), "ends")
    joined = components(both, "of_a", "of_b")
    known = label.unionByName(both.select(F.explode(F.array(F.struct(F.col("a").alias("sig"), F.col("of_a").alias("component")), F.struct(F.col("b").alias("sig"), F.col("of_b").alias("component")))).alias("e")).select("e.*")).distinct()
    named = known.join(joined.withColumnRenamed("component", "least"), known["component"] == joined["id"], "left")
    return session.stage(named.select("sig", F.coalesce("least", "component").alias("component")), "label")
