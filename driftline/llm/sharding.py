"""Sharding by a k-d tree over document metadata, balanced in bytes.

A node covers a run of shards and all rows that reached it.  It is split across
its widest metadata dimension (extent on the scale of the whole table) at the
weighted median: the rows in order of (position on that dimension, hash of id and
text, row number) up to the share of bytes that the left half of its shards
takes.  Splitting ends when every leaf is one shard, so leaves reach the target
bytes.

The medians are found for all nodes of a level at once.  A round sums the bytes
of ``BUCKETS`` equal ranges per node and keeps the range that holds the median;
the next round cuts that range again, first of positions, then of hashes where
one position is too heavy, then of row numbers where one id and text is.  A hot
value is therefore split like any other.  The driver sees at most
``BUCKETS * shards`` sums a round, never rows.

Law ``bytes``: every cut is the nearest row to its share, or within ``tolerance``
of a shard's bytes, so a shard is off the mean by less than its largest document plus
twice the tolerance.

Inputs and edge cases: a null text counts as empty (its size is 1); null ids and
null metadata are values of their own, below all others; equal texts are not
kept together (they would unbalance the shards), but lie near each other when
their metadata is equal; repeated rows are dealt by their row number; fewer
rows than shards leave shards empty; an empty table gives an empty result; other
columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import written
from driftline.llm.packing import ranked

BUCKETS = 1024
MOST_SHARDS = 4096
POSITIONS = 1 << 30   # steps of one dimension
HASHES = 1 << 62
KEYS = ("at", "tie", "row")


def default_dimensions(documents: DataFrame) -> dict[str, Column]:
    """Metadata of a document table: names are placed by a hash, numbers by value."""
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1
    named = {c: F.when(F.col(c).isNotNull(), F.pmod(F.xxhash64(c), F.lit(1 << 52)).cast("double"))
             for c in ("source", "lang") if c in documents.columns}
    return {**named, "size": F.log2(size.cast("double")), "doc_id": F.col("doc_id").cast("double")}


@dataclass
class Node:
    """Shards ``first`` .. ``first + shards - 1`` and the search for the cut of its rows."""

    first: int
    shards: int
    weight: int
    dimension: int = 0
    need: float = 0.0               # bytes still to go left, within the current range
    gone: int = 0                   # bytes that go left for sure
    stage: int = 0                  # which of KEYS is being searched
    low: int = 0
    high: int = POSITIONS
    cut: list[int] = field(default_factory=list)
    done: bool = False

    def narrow(self, ranges: list[tuple[int, int, int]], tolerance: float) -> None:
        """``ranges``: (least key, largest key, bytes) of the node's buckets, in order."""
        before = 0
        for least, most, weight in ranges:
            if before + weight >= self.need or (least, most, weight) == ranges[-1]:
                break
            before += weight
        inside = self.need - before
        single = least == most
        if weight <= tolerance or (single and self.stage == len(KEYS) - 1):
            left = inside * 2 >= weight  # the nearer end of the range
            self.cut.append(most if left else least - 1)
            self.gone += before + (weight if left else 0)
            self.done = True
            return
        self.gone += before
        self.need = inside
        if single:  # one value holds the median: go on among its rows
            self.cut.append(least)
            self.stage += 1
            self.low, self.high = (0, HASHES) if KEYS[self.stage] == "tie" else (0, (1 << 63) - 1)
        else:
            self.low, self.high = least, most


def _nodes(rows: DataFrame, nodes: list[Node], columns: str, values) -> DataFrame:
    """A few numbers per node, joined to the rows; at most ``MOST_SHARDS`` nodes."""
    table = rows.sparkSession.createDataFrame([values(n) for n in nodes], columns)
    return rows.join(F.broadcast(table), "shard")


def _search(rows: DataFrame, nodes: list[Node], tolerance: float) -> None:
    """Find the cut of every node."""
    buckets = max(16, min(BUCKETS, BUCKETS * 64 // max(1, len(nodes))))
    while open_ := [n for n in nodes if not n.done]:
        width = "shard int, axis int, stage int, first_cut long, second_cut long, low long, high long, step long"
        asked = _nodes(rows, open_, width, lambda n: (
            n.first, n.dimension, n.stage, *(n.cut + [0, 0])[:2], n.low, n.high, (n.high - n.low) // buckets + 1))
        at = F.element_at("position", F.col("axis") + 1)
        key = (F.when(F.col("stage") == 0, at).when(F.col("stage") == 1, F.col("tie")).otherwise(F.col("row")))
        inside = (((F.col("stage") < 1) | (at == F.col("first_cut"))) & ((F.col("stage") < 2) | (F.col("tie") == F.col("second_cut"))))
        sums = (asked.where(inside).withColumn("key", key).where(F.col("key").between(F.col("low"), F.col("high")))
                .groupBy("shard", F.floor((F.col("key") - F.col("low")) / F.col("step")).alias("bucket"))
                .agg(F.min("key").alias("least"), F.max("key").alias("most"), F.sum("size").alias("bytes")).collect())
        by_node: dict[int, list] = {}
        for r in sorted(sums, key=lambda r: (r["shard"], r["least"])):
            by_node.setdefault(r["shard"], []).append((r["least"], r["most"], r["bytes"]))
        for n in open_:
            n.narrow(by_node[n.first], tolerance)


def _children(node: Node) -> list[Node]:
    half = node.shards // 2
    return [Node(node.first, half, node.gone), Node(node.first + half, node.shards - half, node.weight - node.gone)]


def assign(documents: DataFrame, shards: int | None = None, target_bytes: int | None = None,
           dimensions: dict[str, Column] | None = None, tolerance: float = 0.001,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, size, text_crc32, shard, slot.

    Either the number of ``shards`` is given or the ``target_bytes`` of one (the number
    is then the total by the target, rounded up).  ``tolerance`` is a share of a shard."""
    if (shards is None) == (target_bytes is None):
        raise ValueError("give the number of shards or the target bytes of one")
    dims = list((dimensions or default_dimensions(documents)).values())
    if not dims:
        raise ValueError("a k-d tree needs a dimension")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # ``position`` holds raw numbers until the extent of the table is known
    rows = documents.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.array(*[d.cast("double") for d in dims]).alias("raw"),
        F.shiftrightunsigned(F.xxhash64(F.xxhash64(F.col(id_col)), F.xxhash64(text)), 2).alias("tie"),
        F.monotonically_increasing_id().alias("row"), F.lit(0).alias("shard"))
    rows = written(rows, "sharding-rows")
    extent = rows.agg(F.sum("size").alias("total"), *[f(F.when(~F.isnan(F.col("raw")[i]), F.col("raw")[i])).alias(f"{name}{i}")
                                                      for i in range(len(dims)) for name, f in (("min", F.min), ("max", F.max))]).first()
    total = extent["total"] or 0
    shards = shards or max(1, -(-total // target_bytes))
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"{shards} shards: split into at most {MOST_SHARDS} at a time")
    placed = []
    for i in range(len(dims)):
        low, high = extent[f"min{i}"], extent[f"max{i}"]
        unit = (F.col("raw")[i] - F.lit(low or 0.0)) / F.lit((high - low) if low is not None and high > low else 1.0)
        known = F.col("raw")[i].isNotNull() & ~F.isnan(F.col("raw")[i])
        placed.append(F.when(known, 1 + F.floor(unit * F.lit(float(POSITIONS - 2)))).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("position", F.array(*placed)).drop("raw")

    nodes = [Node(0, shards, total)] if total else []
    while splitting := [n for n in nodes if n.shards > 1 and n.weight > 0]:
        rows = _split(rows, splitting, len(dims), tolerance * total / shards)
        nodes = [c for n in splitting for c in _children(n)]
    return ranked(rows.select("doc_id", "size", "text_crc32", "shard", "row"), "shard", ["text_crc32", "doc_id", "row"], "slot").drop("row")


def _split(rows: DataFrame, nodes: list[Node], dims: int, tolerance: float) -> DataFrame:
    """Split every node once; the rows of right halves move to their first shard."""
    asked = _nodes(rows, nodes, "shard int, many int", lambda n: (n.first, n.shards))
    spans = asked.groupBy("shard").agg(F.array(*[F.max(F.col("position")[i]) - F.min(F.col("position")[i])
                                                 for i in range(dims)]).alias("span")).collect()
    spans = {r["shard"]: r["span"] for r in spans}
    for n in nodes:
        n.dimension = max(range(dims), key=lambda i: (spans[n.first][i], -i))
        n.need = n.weight * (n.shards // 2) / n.shards
    _search(rows, nodes, tolerance)
    full = (1 << 63) - 1
    table = rows.sparkSession.createDataFrame(
        [(n.first, n.dimension, n.shards // 2, *(n.cut + [full, full])[:3]) for n in nodes],
        "shard int, axis int, half int, cut_at long, cut_tie long, cut_row long")
    at = F.element_at("position", F.col("axis") + 1)
    right = F.struct(at, F.col("tie"), F.col("row")) > F.struct("cut_at", "cut_tie", "cut_row")
    moved = rows.join(F.broadcast(table), "shard", "left").withColumn(
        "shard", F.when(F.col("axis").isNotNull() & right, F.col("shard") + F.col("half")).otherwise(F.col("shard")))
    return written(moved.select(*rows.columns), "sharding-level")
