"""SimHash near-duplicates by a segment-popcount embedding and a grid range join.

* Fingerprint: A-Z are lower-cased, words are runs without ASCII white space, a
  bit is 1 if it is set in over half of the XXH64 values (seed 42) of the word
  shingles, repeats included.  Fewer words than a shingle: the whole sequence is
  the one shingle.  No word: fingerprint 0, linked like any other.
* Embedding: the 64 bits are cut into ``SEGMENTS`` segments, and a fingerprint
  becomes the vector of their bit counts.  The Manhattan distance of two vectors
  is never above the bit distance of the fingerprints, so it is a lower bound.
* Grid range join: the axes are dealt to ``bits + 1`` blocks.  If the Manhattan
  distance is at most ``bits``, one block at least has distance 0, so each pair
  to be found meets in a grid cell of that block.  Within a cell the
  fingerprints are sorted by their total bit count and compared only over the
  range of counts within ``bits`` (again Manhattan, on the sums).
* Verification: the exact bit distance of every pair left.

Exact copies are merged before the join (one row per distinct fingerprint).  A
cell with many fingerprints is split by a hash into parts and the parts are
paired, so no task holds more than two parts.  A task returns a spanning forest
of the links that it found and not the links themselves; the components of the
forests' union are those of all links, and are found by alternating large-star
and small-star steps on written tables.

Inputs and edge cases: null texts are empty; null ids get a fingerprint and
never name a component (null, if no id is left in it), and ``keep_one`` keeps a row without
an id only where its group has none, one per group; rows that share an id
are one document, and it represents its group if any of its rows does; an empty
table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from driftline.llm.common import written

SEGMENTS = 32
PART_ROWS = 16_384      # fingerprints of a cell that one side of a task holds, about
BUCKET_ROWS = 65_536    # rows that one task of the grid join gets, about
BROADCAST_CELLS = 200_000
SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit SimHash of one whole text."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends.tolist()
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        some = range(k, min(n, k + 65_536))
        h = np.fromiter((xxh64_intdigest(line[starts[i]:ends[i + size - 1]], SEED) for i in some), "<u8", len(some))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    """The fingerprint of every text as a signed 64-bit number."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return run(F.coalesce(text, F.lit("")))


def counts_column(value: Column, first: int, last: int) -> Column:
    """The bit counts of segments first..last-1, two decimal digits each."""
    width = 64 // SEGMENTS
    mask = F.lit((1 << width) - 1).cast("long")
    parts = [F.lpad(F.bit_count(F.shiftrightunsigned(value, s * width).bitwiseAND(mask)).cast("string"), 2, "0")
             for s in range(first, last)]
    return F.concat(*parts)


def cells(fingerprints: DataFrame, bits: int) -> DataFrame:
    """(cell, fp): each fingerprint in its grid cell of every block of axes."""
    edges = [round(k * SEGMENTS / (bits + 1)) for k in range(bits + 2)]
    keys = [F.xxhash64(F.lit(k), counts_column(F.col("fp"), a, b)) for k, (a, b) in enumerate(pairwise(edges))]
    return fingerprints.select("fp", F.explode(F.array(*keys)).alias("cell"))


def _hook(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the classes of u[k] and v[k] for every k; a root is the least member."""
    while len(u):
        ru, rv = root[u], root[v]
        apart = ru != rv
        u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
        np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def forest(values: np.ndarray, side: np.ndarray, cross: bool, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links among distinct fingerprints of one cell.

    ``cross``: only pairs with one fingerprint on either side count."""
    order = np.argsort(np.bitwise_count(values), kind="stable")
    value, part = values[order], side[order]
    total = np.bitwise_count(value).astype(np.int64)
    root = np.arange(len(value))
    upto = np.searchsorted(total, total + bits, side="right")
    step = 256
    for a in range(0, len(value), step):
        b = min(len(value), a + step)
        z = upto[b - 1]
        near = np.bitwise_count(value[a:b, None] ^ value[None, a:z]) <= bits
        if cross:
            near &= part[a:b, None] != part[None, a:z]
        u, v = np.nonzero(near)
        later = v > u
        if later.any():
            _hook(root, u[later] + a, v[later] + a)
    child = np.flatnonzero(root != np.arange(len(root)))
    return value[child], value[root[child]]


def links(fingerprints: DataFrame, bits: int) -> DataFrame:
    """(a, b): forests of the links between distinct fingerprints, cell by cell."""
    spark = fingerprints.sparkSession
    placed = cells(fingerprints, bits)
    # the grid bounds this table, not the corpus: for 4 bits (bits + 1) * 3 ** 7 cells at most
    load = placed.groupBy("cell").agg(F.count("*").alias("n"))
    load = written(load.withColumn("parts", F.ceil(F.col("n") / PART_ROWS)), "simhash-cells")
    size = load.agg(F.sum(F.col("n") * F.col("parts")).alias("rows"), F.count("*").alias("cells")).first()
    rows, known = int(size["rows"] or 0), load.select("cell", "parts")
    known = F.broadcast(known) if size["cells"] <= BROADCAST_CELLS else known  # fewer bits, larger blocks of axes
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // BUCKET_ROWS)
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    paired = (placed.join(known, "cell").withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
              .select("fp", "own", "cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
              .withColumn("bucket", F.pmod(F.xxhash64("cell", "lo", "hi"), F.lit(buckets))))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["cell", "lo", "hi"], kind="stable")
        key = frame["cell"].to_numpy(), frame["lo"].to_numpy(), frame["hi"].to_numpy()
        change = np.ones(len(frame), bool)
        change[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
        value = frame["fp"].to_numpy(np.int64).view(np.uint64)
        side, starts = frame["own"].to_numpy(), [*np.flatnonzero(change), len(frame)]
        found = [forest(value[a:b], side[a:b], key[1][a] != key[2][a], bits) for a, b in pairwise(starts) if b - a > 1]
        a = np.concatenate([np.zeros(0, np.uint64), *(f[0] for f in found)]).view(np.int64)
        b = np.concatenate([np.zeros(0, np.uint64), *(f[1] for f in found)]).view(np.int64)
        return pd.DataFrame({"a": a, "b": b})

    return paired.groupBy("bucket").applyInPandas(compare, "a long, b long")


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least of u and all of u's neighbours.

    The minimum is combined before the shuffle, and the join back is one that
    Spark may split, so a hub does not land in one task."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return (edges.join(least, F.col("u") == F.col("w"))
            .select("u", "v", F.least("u", "m").alias("m")))


def _mark(edges: DataFrame) -> tuple:
    """Size and checksum of a set of edges; equal for equal sets."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(h % 1_000_003)).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) for the nodes of an edge table (a, b); the root is the least node."""
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u > v").distinct(), "large-star")
        small = _least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        small = written(small, "small-star")
        if _mark(small) == _mark(now):
            break
        now = small
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(documents: DataFrame, shingle: int = 4, bits: int = 4,
            id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of every row, and (fp, root, component_id) of every fingerprint; the root is a
    fingerprint of the class."""
    prints = written(documents.select(F.col(id_col).alias("doc_id"),
                                      fingerprint_column(F.col(text_col), shingle).alias("fp")), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    members = written(components(links(distinct.select("fp"), bits)).withColumnRenamed("node", "fp"), "simhash-members")
    least = (members.join(distinct, "fp").groupBy("root").agg(F.min("first").alias("component_id")))
    named = members.join(least, "root").select("fp", "root", "component_id")
    known = (distinct.join(named, "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id")))
    # written, so that a join with it reads two plain shuffles and Spark may split a frequent fingerprint
    return prints, written(known, "simhash-known")


def near_duplicates(documents: DataFrame, shingle: int = 4, bits: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, fp (signed), component_id."""
    prints, known = classes(documents, shingle, bits, id_col, text_col)
    return prints.join(known, "fp").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """The rows of ``documents`` that represent their group of near-duplicates: those of its
    smallest id, or one row if no row of the group has an id."""
    prints, known = classes(documents, shingle, bits)
    judged = prints.join(known, "fp").where(F.col("doc_id").isNotNull())
    gone = judged.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays")).where("NOT stays")
    named = (documents.where(F.col("doc_id").isNotNull()).join(gone.select("doc_id"), "doc_id", "left_anti")
             .select(*documents.columns))
    # rows without an id get a number when they are written, to tell equal ones apart
    loose = written(documents.where(F.col("doc_id").isNull()).withColumn("row_", F.monotonically_increasing_id()), "simhash-loose")
    place = loose.select("row_", fingerprint_column(F.col("text"), shingle).alias("fp")).join(known.where("component_id IS NULL"), "fp")
    first = place.groupBy("root").agg(F.min("row_").alias("row_"))
    return named.unionByName(loose.join(first.select("row_"), "row_", "left_semi").select(*documents.columns))
