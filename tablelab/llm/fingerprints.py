"""SimHash fingerprints of texts and the search for near ones, in DataFrame functions only.

Terms are runs of five words (fewer words: the whole sequence); a term votes once for each time it occurs, so its
weight is its frequency. Each term's 64-bit hash votes +1 or -1 on every bit; the signs of the sums are
the fingerprint. Votes are counted packed: a sum of ``(hash >> k) & 0x0000000100000001`` counts bits k and k + 32
at once, so 32 sums are all that leaves a partition for a text.

``near_pairs`` finds all fingerprints within a Hamming radius r: the 64 bits are cut into r + 3 blocks, and for
every choice of three blocks a table keyed by them is joined; two fingerprints that differ in at most r bits
agree in at least three blocks.

Defined cases: null texts are empty; texts without words have the fingerprint of no votes (all bits 0); equal
texts have equal fingerprints; rows equal in key and text come back once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
_BLANKS = "[\\x20\\x09-\\x0D]+"
_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BLANKS), lambda w: w != "")


def fingerprints(texts: DataFrame, key: list[str], size: int = 5) -> DataFrame:
    """Columns ``key`` with fingerprint (long) of each row's text (column ``text``)."""
    rows = texts.select(*key, words_of(F.coalesce("text", F.lit(""))).alias("w"))
    n = F.size("w")
    rows = rows.select(*key, "w", n.alias("n"), F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))))).alias("i"))
    term = F.when(F.col("i").isNull(), None).otherwise(F.xxhash64(*[F.get("w", F.col("i") + k) for k in range(size)]))
    rows = rows.select(*key, term.alias("h"))
    sums = [F.sum(F.shiftright("h", k).bitwiseAND(F.lit(_LANES))).alias(f"v{k}") for k in range(BITS // 2)]
    voted = rows.groupBy(*key).agg(F.count("h").alias("n"), *sums)
    bits = []
    for k in range(BITS // 2):
        low, high = F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{k}", 32)
        for bit, votes in ((k, low), (k + 32, high)):
            one = 1 << bit if bit < 63 else -(1 << 63)
            bits.append(F.when(2 * votes > F.col("n"), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
    value = bits[0]
    for b in bits[1:]:
        value = value.bitwiseOR(b)
    return voted.select(*key, value.alias("fingerprint"))


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _block_bounds(radius: int) -> list[tuple[int, int]]:
    n = radius + 3
    return [(BITS * i // n, BITS * (i + 1) // n) for i in range(n)]


def block_keys(fingerprint: Column, radius: int) -> Column:
    """Keys of all block tables: array of (table, key)."""
    tables = []
    for t, chosen in enumerate(combinations(range(radius + 3), 3)):
        mask = 0
        for b in chosen:
            lo, hi = _block_bounds(radius)[b]
            mask |= ((1 << (hi - lo)) - 1) << lo
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        tables.append(F.struct(F.lit(t).cast("byte").alias("table"), fingerprint.bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    return F.array(*tables)


def near_pairs(queries: DataFrame, all_prints: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct pairs (query, near, distance) of fingerprints within ``radius`` bits, the equal one included.

    Both inputs have a column fingerprint; copies are looked up once. A pair is reported by the first table that
    holds it, so no pair is formed twice.
    """
    keys = list(combinations(range(radius + 3), 3))
    masks = []
    for chosen in keys:
        mask = 0
        for b in chosen:
            lo, hi = _block_bounds(radius)[b]
            mask |= ((1 << (hi - lo)) - 1) << lo
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    spread = lambda df, name: df.select("fingerprint").distinct().select(F.col("fingerprint").alias(name), F.inline(block_keys(F.col("fingerprint"), radius)))
    a, b = spread(queries, "query"), spread(all_prints, "near")
    differ = F.col("query").bitwiseXOR(F.col("near"))
    first = F.array_position(F.array(*[differ.bitwiseAND(F.lit(m).cast("long")) == 0 for m in masks]), True) - 1
    joined = a.join(b, (a["table"] == b["table"]) & (a["key"] == b["key"]) & (F.bit_count(differ) <= radius) & (first == a["table"]))
    return joined.select("query", "near", F.bit_count(differ).alias("distance"))
