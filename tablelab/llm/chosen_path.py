"""Near copies by a chosen-path set similarity join: trees that branch documents by selected minwise tokens.

Every set of word n-grams has ``TOKENS`` minwise tokens; two sets agree in each of them with a chance equal to their
Jaccard similarity. A node of a tree selects a few token positions at random and sends each document to one child for each
of them, named by the token there, so linked documents stay together along at least one path with good chance while
others part. All trees start at the whole table with positions of their own. Nodes of one document end. Small nodes are compared
exhaustively; larger ones branch again, unless links found so far have tied all their documents together. Trees are independent, so the
chance to miss a link falls with their number: at similarity 0.85 it is below 1e-6 for a node that is small after
its first branching; a path goes on with one child on average.

Equal sets are one vertex from the start, and every set is first verified against one centre, that it
shares most nodes with; this ties large groups of copies by a number of pairs that grows with their rows. What is still
large at the last depth is compared too (``groups.tie``), by bitmaps of the sets. All links are confirmed on whole sets; only sets of
pairs to be confirmed are stored whole.

Defined cases: null texts and texts without words are empty sets, linked with nothing and kept; shorter ones than an
n-gram are one n-gram; repeated rows and documents of one id are rows of their own; a null id is never the id of a component
unless all its ids are null; the empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab import session
from tablelab.llm import groups, jaccard, words
from tablelab.llm.components import components

U64 = np.uint64
TOKENS = 64
_RANDOM = random.Random(20)
_SEED = np.array([_RANDOM.getrandbits(64) for _ in range(TOKENS)], U64)
_FACTOR = np.array([_RANDOM.getrandbits(64) | 1 for _ in range(TOKENS)], U64)


def minwise(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each set (members ``h[at[i]:at[i + 1]]``, none empty) the smallest hash under each of ``TOKENS`` hash functions."""
    out = np.empty((len(at) - 1, TOKENS), np.uint32)
    step = 1 << 18  # sets at a time, so that intermediate arrays stay small
    cuts = np.unique(np.minimum(np.append(np.searchsorted(at, np.arange(0, at[-1], step)), len(at)), len(at) - 1))
    for i, j in zip(cuts[:-1], cuts[1:]):
        own = h[at[i] : at[j]]
        for t in range(TOKENS):
            out[i:j, t] = np.minimum.reduceat(((own ^ _SEED[t]) * _FACTOR[t]) >> U64(32), at[i:j] - at[i])
    return out


def token_rows(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, sig (null: empty set) of each row, and the tokens at its first copy in a block; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in words.blocks(batches, "text", jaccard.BLOCK_BYTES):
            h, at, sig = jaccard._sets(block.column(1), size)
            _, first = np.unique(sig, return_index=True)
            first = np.sort(first[sig[first] != 0])
            own = np.concatenate([[0], np.cumsum(np.diff(at)[first])])
            members = h[np.repeat(at[first] - own[:-1], np.diff(own)) + np.arange(own[-1])]
            tokens: list[bytes | None] = [None] * block.num_rows
            for i, row in zip(first, minwise(members, own) if len(first) else []):
                tokens[i] = row.tobytes()
            columns = [block.column(0), pa.array(np.diff(at), pa.int64()), pa.array(sig.view(np.int64), mask=sig == 0), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "sig", "tokens"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return session.stage(rows.mapInArrow(run, "doc_id long, n_shingles long, sig long, tokens binary"), "tokens")


def _child(node: Column, position: Column, tokens: str) -> Column:
    return F.xxhash64(node, position, F.substring(tokens, position * 4 + 1, F.lit(4)))


def first_nodes(prints: DataFrame, trees: int, branching: int) -> DataFrame:
    """node, sig: the children of all trees' roots."""
    rng = random.Random(trees)
    chosen = sorted({p for _ in range(trees) for p in rng.sample(range(TOKENS), branching)})
    children = F.array(*[_child(F.lit(-1), F.lit(p), "tokens") for p in chosen])
    return prints.select("sig", F.explode(children).alias("node"))


def next_nodes(rows: DataFrame, nodes: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """node, sig: the children of ``nodes``. A node selects every position with a chance that keeps linked documents together in one child on average."""
    pick = F.filter(F.sequence(F.lit(0), F.lit(TOKENS - 1)), lambda j: F.pmod(F.xxhash64("node", j), F.lit(percent * TOKENS)) < 100)
    chosen = nodes.select("node", F.explode(pick).alias("position"))
    # a document meets its tokens once, whatever the number of its nodes
    listed = rows.join(chosen, "node").groupBy("sig").agg(F.collect_list(F.struct("node", "position")).alias("e"))
    each = listed.join(prints.select("sig", "tokens"), "sig").select("sig", "tokens", F.inline("e"))
    return each.select(_child(F.col("node"), F.col("position"), "tokens").alias("node"), "sig")


def shared(rows: DataFrame) -> DataFrame:
    """node, sig, centre of nodes with several documents; stored. The centre is the vertex of smallest hash with the node."""
    rows = rows.repartition("node")  # moved once for both reads
    sizes = rows.groupBy("node").agg(F.count("*").alias("k"), F.min_by("sig", F.xxhash64("node", "sig")).alias("centre")).where("k > 1")
    return session.stage(rows.join(sizes, "node").select("node", "sig", "centre"), "level")


def centre_pairs(rows: DataFrame, least: int) -> DataFrame:
    """a, b: each set with the centre it shares most nodes with, ``least`` at least."""
    pairs = rows.where("sig != centre").groupBy(F.col("sig").alias("a"), F.col("centre").alias("b")).agg(F.count("*").alias("k")).where(F.col("k") >= least)
    return pairs.groupBy("a").agg(F.max_by("b", F.struct("k", "b")).alias("b"))


def ends(pairs: DataFrame) -> DataFrame:
    """sig of the sets in ``pairs`` (a, b)."""
    return pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()


def leaves(level: DataFrame, label: DataFrame, prints: DataFrame, percent: int, small: int, depth: int) -> DataFrame:
    """group, sig of the nodes left to compare. Nodes of one component end, small ones are left to compare, larger ones branch."""
    left = None
    for at in range(1, depth + 1):
        named = level.select("node", "sig").join(label, "sig", "left").select("node", "sig", F.coalesce("component", "sig").alias("component"))
        sizes = named.groupBy("node").agg(F.count("*").alias("k"), F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("node", "k")
        sizes = session.stage(sizes, "nodes")
        done = sizes if at == depth else sizes.where(F.col("k") <= small)
        leaf = level.join(done.select("node"), "node", "left_semi").select(F.col("node").alias("group"), "sig")
        left = leaf if left is None else left.unionByName(leaf)
        large = sizes.where(F.col("k") > small).select("node")
        if at == depth or large.isEmpty():
            break
        level = shared(next_nodes(level.select("node", "sig"), large, prints, percent))
    return left


def links(documents: DataFrame, size: int, percent: int, trees: int, branching: int, small: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``token_rows`` and the verified links (a, b) between vertices, enough to tie every component."""
    bounds = jaccard.Bounds(percent)
    rows = token_rows(documents, size)
    prints = rows.where("tokens is not null").groupBy("sig").agg(F.first("tokens").alias("tokens"))
    level = shared(first_nodes(prints, trees, branching))
    prints = rows.where("tokens is not null").select("sig", "tokens").join(level.select("sig").distinct(), "sig", "left_semi").dropDuplicates(["sig"])
    prints = session.stage(prints, "prints")
    owners = rows.select("doc_id", "sig")
    centres = session.stage(centre_pairs(level, max(1, trees * branching // 3)), "centres")
    sets = jaccard.whole_sets(documents, owners, ends(centres), size, mapped=prints)
    near = session.stage(jaccard.verified(centres, sets.where("members is not null").select("sig", "n", "members"), bounds).select("a", "b"), "near")
    label = components(near, "a", "b").select(F.col("id").alias("sig"), "component")
    left = leaves(level, label, prints, percent, small, depth)
    verified = lambda pairs: jaccard.verified(pairs, jaccard.whole_sets(documents, owners, ends(pairs), size), bounds)
    return rows, near.unionByName(groups.tie(left, label, None, bounds, verified, maps=sets.select("sig", "n", "bits")))


def join_groups(documents: DataFrame, size: int = 5, percent: int = 85, trees: int = 12, branching: int = 2, small: int = 256, depth: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), kept of each row."""
    rows, near = links(documents, size, percent, trees, branching, small, depth)
    named = jaccard.named_rows(rows.select("doc_id", "n_shingles", "sig"), near)
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
