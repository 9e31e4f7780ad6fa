"""The prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

Conversations are sequences of turns; a turn is the digest of its role and text, so a sequence is a string of
16 bytes a turn. Equal sequences are one row from the start. Rows are dealt out in the order of sequences. Each
task then joins neighbours, deepest common prefix first: a union-find holds the components, and the components that
edges of one depth join become a branching node. What may still grow past the first or last row of the task
stays open: it is contracted to one edge per depth, with the sums over the subtrees that are complete. The tasks' contracted
forests are rows themselves; runs of them are merged by the same step, fewer tasks each round, until one is left.

A node of the trie that does not branch has the members of the next node below it that does, or ends
there: it is written from the edge above that node. A child of an open node knows its parent by the digest of the
parent's prefix only; those rows get the parent's smallest conversation by a join at the end.

Defined cases: rows with a null conv_id are left out; null role or text is empty; turns are ordered by turn, null
first, equal ones by the digest of role and text; repeated rows are turns of their own; a conversation of no turns
is a member of the root only; the empty table gives no rows. Memory: a task holds its sequences, 16 bytes a turn; one
conversation is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab import session

WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
SUMS = "n long, low long, saved long, leaves long, children long, ends string"
ITEM = f"struct<depth:int, {SUMS.replace(' ', ':').replace(',:', ', ')}, bytes:array<long>, mark:binary>"
EDGE = f"struct<depth:int, {SUMS.replace(' ', ':').replace(',:', ', ')}, mark:binary>"
RUN = f"first binary, last binary, items array<{ITEM}>, edges array<{EDGE}>"
NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, mark binary, parent_mark binary"
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
RUN_COLUMNS = ["first", "last", "items", "edges"]


@dataclass
class Part:
    """A subtree (as an item) or what is known of an open node (as an edge): sums over its complete children."""

    depth: int
    n: int = 0
    low: int | None = None
    saved: int = 0  # below ``depth``
    leaves: int = 0
    children: int = 0
    ends: str | None = None
    bytes: list[int] = field(default_factory=list)  # of the first 0, 1, .. ``depth`` turns
    mark: bytes | None = None  # digest of the prefix, where a row above or below needs it

    def saved_from(self, depth: int) -> int:
        """Summed over the nodes from ``depth`` down."""
        return self.saved + (self.n - 1) * (self.bytes[self.depth] - self.bytes[max(depth - 1, 0)])

    def take(self, n: int, low: int | None) -> None:
        self.n += n
        self.low = low if self.low is None else self.low if low is None else min(self.low, low)

    def add_edge(self, other: Part) -> None:
        self.take(other.n, other.low)
        self.saved += other.saved
        self.leaves += other.leaves
        self.children += other.children
        self.ends = self.ends or other.ends
        self.mark = self.mark or other.mark

    def add_item(self, item: Part) -> bool:
        """True if the item is a child, and not what ends at this node."""
        self.take(item.n, item.low)
        if item.depth == self.depth:
            self.ends = item.ends
            return False
        self.saved += item.saved_from(self.depth + 1)
        self.leaves += item.leaves
        self.children += 1
        return True


def common_turns(a: bytes, b: bytes) -> int:
    """Number of first turns that two sequences share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * WIDTH] == b[: mid * WIDTH] else (low, mid - 1)
    return low


class Forest:
    """Contracts an ordered row of items, joined by edges; ``nodes`` gets the rows of all edges that are complete."""

    def __init__(self, closed: bool):
        self.closed = closed
        self.first = self.last = None
        self.items: list[Part | None] = []
        self.edges: list[Part] = []
        self.nodes: list[tuple] = []

    def append(self, first: bytes, last: bytes, items: list[Part | None], edges: list[Part]) -> None:
        if self.items:
            self.edges.append(Part(common_turns(self.last, first)))
        else:
            self.first = first
        self.items += items
        self.edges += edges
        self.last = last

    def write(self, child: Part, above: int, parent: int | None, parent_mark: bytes | None) -> None:
        """Rows of the nodes on the edge from depth ``above`` down to ``child``."""
        for depth in range(above + 1, child.depth + 1):
            end, top = depth == child.depth, depth == above + 1
            self.nodes.append((
                child.low, depth, parent if top else child.low, child.n, child.children if end else 1, child.leaves, child.saved_from(depth),
                (child.ends if end else None) or NO_ENDS, child.mark if end else None, parent_mark if top else None,
            ))

    def _join(self, depth: int, parts: list[Part | None], edges: list[Part], mark: bytes | None) -> Part:
        """The node that joins ``parts``; with a mark it is open and ``parts`` are its complete children only."""
        node, children = Part(depth), []
        for e in edges:
            node.add_edge(e)
        for part in parts:
            if part is not None:
                if not node.bytes:
                    node.bytes = part.bytes[: depth + 1]
                if node.add_item(part):
                    children.append(part)
        if mark is not None:
            node.mark, node.bytes = mark, []
        for child in children:
            self.write(child, depth, None if mark else node.low, mark)
        return node

    def contract(self) -> tuple[Part | None, list[Part]]:
        """The whole tree if closed, else the edges that stay open, in the order of the row."""
        m = len(self.items)
        up, right = list(range(m)), list(range(m))  # a component's root is its first place
        part: list[Part | None] = list(self.items)

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        left_side, middle, right_side = [], [], []
        order = sorted(range(m - 1), key=lambda e: (-self.edges[e].depth, e))
        at = 0
        while at < len(order):
            # edges of one depth that follow each other, over components joined before
            depth, chain = self.edges[order[at]].depth, [order[at]]
            at += 1
            while at < len(order) and self.edges[order[at]].depth == depth and right[root(chain[-1] + 1)] == order[at]:
                chain.append(order[at])
                at += 1
            parts = [root(chain[0]), *[root(e + 1) for e in chain]]
            first, last = parts[0], right[parts[-1]]
            open_left, open_right = first == 0 and not self.closed, last == m - 1 and not self.closed
            edges = [self.edges[e] for e in chain]
            if open_left or open_right:
                prefix = (self.first if open_left else self.last)[: depth * WIDTH]
                inner = [part[p] for p in parts[open_left : len(parts) - open_right]]
                node = self._join(depth, inner, edges, hashlib.md5(prefix).digest())
                (middle if open_left and open_right else left_side if open_left else right_side).append(node)
                node = None
            else:
                node = self._join(depth, [part[p] for p in parts], edges, None)
            for p in parts[1:]:
                up[p] = first
            right[first] = last
            part[first] = node
        return part[0] if m else None, left_side + middle + right_side[::-1]

    def close(self) -> None:
        """All rows that are left, from the root down."""
        tree, _ = self.contract()
        if tree is None:
            return
        top = tree if tree.depth == 0 else self._join(0, [tree], [], None)
        self.nodes.append((top.low, 0, None, top.n, top.children, top.leaves, top.saved, top.ends or NO_ENDS, top.mark, None))


def _part(x: dict | None) -> Part | None:
    return None if x is None else Part(**(x | {"bytes": x.get("bytes") or []}))


def _edge(x: Part) -> dict:
    return {k: v for k, v in x.__dict__.items() if k != "bytes"}


def _merge_task(schema: pa.Schema, closed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(closed)
        for batch in batches:
            for row in batch.to_pylist():
                forest.append(row["first"], row["last"], [_part(x) for x in row["items"]], [_part(x) for x in row["edges"]])
        own = []
        if closed:
            forest.close()
        elif forest.items:
            _, edges = forest.contract()
            ends = [forest.items[0], forest.items[-1]] if len(forest.items) > 1 else forest.items
            items = ends[:1] + [None] * (len(edges) - 1) + ends[1:]
            own = [{"first": forest.first, "last": forest.last, "items": [x and x.__dict__ for x in items], "edges": [_edge(x) for x in edges]}]
        for start in range(0, len(forest.nodes), 10_000):
            rows = [dict(zip(NODE_COLUMNS, r)) for r in forest.nodes[start : start + 10_000]]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        yield pa.RecordBatch.from_pylist(own, schema=schema)

    return run


def _merge(runs: DataFrame, parts: int, closed: bool) -> tuple[DataFrame, DataFrame]:
    """Rows of nodes and the contracted runs, one a task, of runs in the order of their first sequence; stored."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    dealt = runs.repartitionByRange(parts, "first") if parts > 1 else runs.coalesce(1)
    kind = _parse_datatype_string(f"{NODE}, {RUN}")
    done = session.stage(dealt.sortWithinPartitions("first").mapInArrow(_merge_task(to_arrow_schema(kind), closed), kind), "trie")
    return done.where("first is null").select(*NODE_COLUMNS), done.where("first is not null").select(*RUN_COLUMNS)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation's turns in order, as (turn, key, bytes)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct("turn", key.alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    return conversations.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def sequences(rows: DataFrame, ids_per_slice: int = 4096) -> DataFrame:
    """seq, n, low, ends, bytes of each different sequence of ``rows`` (conv_id, turns); stored.

    The ids of equal conversations are joined to text in slices of the id range; one pass over the slices in order feeds
    the digest, so no task holds all of them.
    """
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    rows = rows.select("conv_id", seq.alias("seq"), F.transform("turns", lambda t: t["bytes"]).alias("bytes"), F.floor(F.col("conv_id") / ids_per_slice).alias("slice"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    slices = rows.groupBy("seq", "slice").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"), ids.alias("ids"), F.first("bytes").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def flush() -> pa.RecordBatch:
            out = [[r[0] for r in done], [r[1] for r in done], [r[2] for r in done], [r[3].hexdigest() for r in done], [r[4] for r in done]]
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["seq", "n", "low", "ends", "bytes"])

        for batch in batches:
            for row in batch.to_pylist():
                if now and now[0] == row["seq"]:
                    now[1] += row["n"]
                    now[3].update(b",")
                else:
                    if now:
                        done.append(now)
                    now = [row["seq"], row["n"], row["low"], hashlib.sha256(), row["bytes"]]
                now[3].update(row["ids"].encode())
            if len(done) >= 10_000:
                yield flush()
                done = []
        if now:
            done.append(now)
        yield flush()

    # equal sequences are together and their slices in order; only slices of ids travel
    ordered = slices.repartition("seq").sortWithinPartitions("seq", "slice").select("seq", "n", "low", "ids", "bytes")
    return session.stage(ordered.mapInArrow(run, "seq binary, n long, low long, ends string, bytes array<long>"), "sequences")


def _running(lengths: Column) -> Column:
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(lengths, start, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))


def build(rows: DataFrame, rows_per_task: int = 100_000, fan_in: int = 32) -> DataFrame:
    """All nodes of the trie of ``rows`` (conv_id, turns as of ``turn_rows``)."""
    found = sequences(rows)
    n = found.count()
    item = F.struct(
        (F.octet_length("seq") / WIDTH).cast("int").alias("depth"), F.col("n"), F.col("low"), F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("children"), F.col("ends"), _running(F.col("bytes")).alias("bytes"), F.lit(None).cast("binary").alias("mark"),
    )
    runs = found.select(F.col("seq").alias("first"), F.col("seq").alias("last"), F.array(item).alias("items"), F.array().cast(f"array<{EDGE}>").alias("edges"))
    parts = max(n // rows_per_task, min(n // 1000, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))) + 1
    nodes = None
    while True:
        more, runs = _merge(runs, parts, closed=parts == 1)
        nodes = more if nodes is None else nodes.unionByName(more)
        if parts == 1:
            break
        parts = 1 + (parts - 1) // fan_in
    known = nodes.where("mark is not null").select(F.col("mark").alias("parent_mark"), F.col("conv_id").alias("parent"))
    whole = nodes.where("parent_mark is null").drop("mark", "parent_mark")
    named = nodes.where("parent_mark is not null").drop("mark", "parent_conv_id").join(known, "parent_mark").withColumnRenamed("parent", "parent_conv_id")
    return whole.unionByName(named.select(*whole.columns)).withColumn("depth", F.col("depth").cast("long"))


def with_shared_heads(rows: DataFrame, group: int = 5, modulus: int = 9) -> DataFrame:
    """Conversations whose first h turns are those of the first of their ``group``; h = crc32(conv_id) % ``modulus``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(modulus)).cast("int")
    head = rows.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, modulus - 1).alias("head"))
    own = rows.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h})
    none = F.slice("turns", 1, 0)
    rest = F.when(F.size("turns") > F.col("h"), F.slice("turns", F.col("h") + 1, F.size("turns"))).otherwise(none)
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), rest)
    return own.join(head, "base", "left").select("conv_id", turns.alias("turns"))
