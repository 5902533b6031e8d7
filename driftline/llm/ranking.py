"""Ranked lexical search over impact vectors in buckets of equal length (norm).

A document's impact vector has one coordinate per term of the queries: the term's
weight times its saturated frequency, all in 64-bit integers.  A query's vector
holds its term counts, and a score is their inner product.

1. One pass over the texts keeps each document's length and the frequencies of the
   query terms; document frequencies, the number of documents and of terms follow
   from that table.
2. Documents are ordered by the norm of their vectors (range partitioning; equal
   norms are dealt out further by hash and row number) and cut into buckets.
3. For a query and a bucket, with the query's tenth best score so far as threshold:

   * Cauchy-Schwarz on whole vectors prunes the bucket: |q| * (largest norm) < threshold;
   * coordinate bounds filter inside: coordinates are taken in descending order of
     q_f * (largest d_f in the bucket) until the rest of these sums to less than the
     threshold, so a document without any of them is out.  A document with some has
     their exact sum, and for the rest the lesser of the rest's sum and Cauchy-Schwarz
     on the rest of both vectors;
   * survivors are rescored exactly in integers.

   Bounds are in doubles with a margin far above their rounding and cut strictly
   below the threshold only, so no tie is lost.
4. A first search over the longest vectors gives every query its starting threshold.
   Each task returns at most ``top`` rows per query; a window with a group limit
   ranks them.

Queries are taken in blocks of ``BLOCK_BYTES`` of text, which bounds what is broadcast
(terms, weights, query vectors); each block is one pass over the documents.

Inputs and edge cases: a null or term-free text is no document and gives no rows, a
term-free item gives no rows; fewer matching documents than ``top`` give fewer rows;
repeated rows are documents each, null ids rank behind all others of equal score;
of items that share an id the smallest text counts, items without an id are left
out; an empty table on either side gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import written

TOP = 10
BUCKET_ROWS = 2048
HEAD_ROWS = 4096           # documents of the search for the starting thresholds, about
BLOCK_BYTES = 16_000_000   # text of the items of one block, about
NO_ID = np.iinfo(np.int64).max
MARGIN = 1 + 1e-9

# ASCII letters are lower-cased, other ASCII but digits separates, all else belongs to terms
_LETTERS = b"abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).translate(
    bytes.maketrans(_LETTERS.upper(), _LETTERS))

_VECTORS = "doc_id long, n long, term array<int>, tf array<int>"


def terms(text: str) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_PLAIN).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Queries:
    """The query vectors of a block: ids, coordinates (ascending) and counts of each item."""

    ids: list[int]
    at: list[np.ndarray]
    counts: list[np.ndarray]
    norms: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.norms = np.array([math.sqrt(float((c * c).sum())) for c in self.counts])


def _queries(items: list, vocabulary: dict[bytes, int]) -> Queries:
    """Read items into vectors; new terms get the next coordinate."""
    ids, at, counts = [], [], []
    for item_id, text in items:
        found = sorted((vocabulary.setdefault(t, len(vocabulary)), n) for t, n in Counter(terms(text)).items())
        if found:
            ids.append(item_id)
            at.append(np.array([t for t, _ in found], np.int64))
            counts.append(np.array([n for _, n in found], np.int64))
    return Queries(ids, at, counts)


def vectors(documents: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms with repeats), and the frequencies of the vocabulary's terms of every
    document that has a term."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch in batches:
            ids, sizes, ends, at, tf = [], [], [0], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                for t, n in Counter(found).items():
                    k = known(t)
                    if k is not None:
                        at.append(k)
                        tf.append(n)
                ids.append(doc_id)
                sizes.append(len(found))
                ends.append(len(at))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))],
                ["doc_id", "n", "term", "tf"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, _VECTORS)


@dataclass
class Collection:
    """What a document's impacts depend on besides itself."""

    documents: int
    total: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, many: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """n: length of every document, many: its coordinates; term, tf: those coordinates."""
        m = 25 + (75 * n * self.documents) // self.total
        tf = tf.astype(np.int64)
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, many)))


def _unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """doc_id (null: ``NO_ID``), n, bounds of the coordinates, term, tf."""
    term, tf = batch["term"], batch["tf"]
    ids = batch["doc_id"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
    offsets = term.offsets.to_numpy().astype(np.int64)
    return ids, batch["n"].to_numpy(), offsets - offsets[0], term.flatten().to_numpy(), tf.flatten().to_numpy()


def by_norm(rows: DataFrame, about: Collection) -> DataFrame:
    """The vectors in descending order of their norms over all partitions."""
    shared = rows.sparkSession.sparkContext.broadcast(about)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, n, ends, term, tf = _unpack(batch)
            squares = np.concatenate([[0.0], np.cumsum(shared.value.impacts(n, np.diff(ends), term, tf).astype(float) ** 2)])
            norm = np.sqrt(np.maximum(squares[ends[1:]] - squares[ends[:-1]], 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm)], [*batch.schema.names, "norm"])

    scored = rows.mapInArrow(run, _VECTORS + ", norm double").where("norm > 0")
    # equal norms, copies above all, may be many: hash and row number deal them out as well
    order = [F.col("norm").desc(), F.xxhash64("doc_id", "n"), F.monotonically_increasing_id()]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scored.select("*", *[c.alias(f"o{k}") for k, c in enumerate(order[1:])]).repartitionByRange(
        parts, F.col("norm").desc(), "o0", "o1").sortWithinPartitions(F.col("norm").desc(), "o0", "o1").drop("o0", "o1")


class Search:
    """The best documents of every query among the buckets seen so far."""

    def __init__(self, queries: Queries, about: Collection, top: int, start: np.ndarray) -> None:
        self.queries, self.about, self.top = queries, about, top
        self.threshold = start.astype(float)    # a score that ``top`` documents reach
        none = np.zeros(0, np.int64)
        self.best = [(none, none) for _ in queries.ids]
        self.pruned = self.filtered = self.rescored = 0  # buckets; documents; documents

    def bucket(self, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        many = np.diff(ends)
        impact = self.about.impacts(n, many, term, tf)
        square = np.concatenate([[0.0], np.cumsum(impact.astype(float) ** 2)])
        square = (square[ends[1:]] - square[ends[:-1]]) * MARGIN
        longest = math.sqrt(square.max(initial=0))
        active = np.flatnonzero(self.queries.norms * longest * MARGIN >= np.maximum(self.threshold, 1))
        self.pruned += len(self.queries.ids) - len(active)
        if not len(active):
            return
        # the bucket by coordinate
        order = np.argsort(term, kind="stable")
        present, first = np.unique(term[order], return_index=True)
        doc = np.repeat(np.arange(len(ids)), many)[order]
        value = impact[order]
        highest = np.maximum.reduceat(value, first)
        first = np.append(first, len(order))
        lookup = np.zeros(len(self.about.weights), np.int64)   # a query's counts by coordinate
        for q in active:
            self._one(q, ids, ends, term, impact, square, present, first, doc, value, highest, lookup)

    def _one(self, q, ids, ends, term, impact, square, present, first, doc, value, highest, lookup) -> None:
        at, count = self.queries.at[q], self.queries.counts[q]
        k = np.searchsorted(present, at)
        k[k == len(present)] = 0
        here = present[k] == at
        if not here.any():
            return
        k, count_here = k[here], count[here].astype(float)
        most = count_here * highest[k]
        down = np.argsort(-most, kind="stable")
        k, count_here, most = k[down], count_here[down], most[down]
        rest = np.append(most[::-1].cumsum()[::-1], 0.0)     # rest[j]: of the coordinates from j on
        need = max(self.threshold[q], 1.0)
        if rest[0] * MARGIN < need:
            self.pruned += 1
            return
        focus = int(np.argmax(rest * MARGIN < need))
        total, seen = np.zeros(len(ids)), np.zeros(len(ids))
        for j in range(focus):
            a, b = first[k[j]], first[k[j] + 1]
            total[doc[a:b]] += count_here[j] * value[a:b]     # a document holds a coordinate once
            seen[doc[a:b]] += value[a:b].astype(float) ** 2
        left = math.sqrt(float((count_here[focus:] ** 2).sum()))
        bound = total + np.minimum(rest[focus], left * np.sqrt(np.maximum(square - seen, 0)))
        alive = np.flatnonzero((seen > 0) & (bound * MARGIN >= need))
        self.filtered += len(ids) - len(alive)
        if not len(alive):
            return
        self.rescored += len(alive)
        lookup[at] = count
        sizes = ends[alive + 1] - ends[alive]
        pick = np.repeat(ends[alive] - np.append(0, sizes.cumsum()[:-1]), sizes) + np.arange(sizes.sum())
        sums = np.concatenate([[0], np.cumsum(lookup[term[pick]] * impact[pick])])
        upto = sizes.cumsum()
        score = sums[upto] - sums[upto - sizes]
        lookup[at] = 0
        good = score >= need
        self._keep(q, score[good], ids[alive[good]])

    def _keep(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.best[q][0], score]), np.concatenate([self.best[q][1], ids])
        first = np.lexsort((ids, -score))[:self.top]
        self.best[q] = score[first], ids[first]
        if len(first) == self.top:
            self.threshold[q] = max(self.threshold[q], float(score[first[-1]]))


def _search(rows: DataFrame, queries: Queries, about: Collection, top: int, start: np.ndarray) -> DataFrame:
    """(query, doc_id, score): each task's best documents of every query."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((queries, about, start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, about, start = shared.value
        search = Search(queries, about, top, start)
        for batch in batches:
            ids, n, ends, term, tf = _unpack(batch)
            cuts = [*range(0, len(ids), BUCKET_ROWS), len(ids)]
            for a, b in pairwise(cuts):
                search.bucket(ids[a:b], n[a:b], ends[a:b + 1] - ends[a], term[ends[a]:ends[b]], tf[ends[a]:ends[b]])
        query = np.concatenate([np.zeros(0, np.int32), *(np.full(len(s), q, np.int32) for q, (s, _) in enumerate(search.best))])
        score = np.concatenate([np.zeros(0, np.int64), *(s for s, _ in search.best)])
        ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i in search.best)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.astype(np.int32)), pa.array(ids, mask=ids == NO_ID), pa.array(score)], ["query", "doc_id", "score"])

    return rows.select("doc_id", "n", "term", "tf").mapInArrow(run, "query int, doc_id long, score long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def _block(documents: DataFrame, items: list, top: int, id_col: str, text_col: str) -> DataFrame | None:
    """Ranks of one block of items."""
    spark = documents.sparkSession
    vocabulary: dict[bytes, int] = {}
    queries = _queries(items, vocabulary)
    if not queries.ids:
        return None
    rows = written(vectors(documents, vocabulary, id_col, text_col), "ranking-vectors")
    size = rows.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    if not size["documents"]:
        return None
    holding = np.zeros(len(vocabulary), np.int64)
    for term, n in rows.select(F.explode("term").alias("term")).groupBy("term").count().collect():  # at most the vocabulary
        holding[term] = n
    about = Collection(size["documents"], size["total"], np.array([weight(size["documents"], int(k)) for k in holding], np.int64))
    rows = written(by_norm(rows, about), "ranking-norms")
    start = np.zeros(len(queries.ids), np.int64)
    cut = rows.agg(F.percentile_approx("norm", 1 - min(1.0, HEAD_ROWS / size["documents"]), 1000)).first()[0]
    head = _ranked(_search(rows.where(F.col("norm") >= F.lit(cut)), queries, about, top, start), top)
    for query, score in head.where(F.col("rank") == top).select("query", "score").collect():  # at most a row per query
        start[query] = score
    best = _ranked(_search(rows, queries, about, top, start), top)
    names = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id long")
    return best.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per item and rank: item_id, rank (from 1), doc_id, score."""
    spark = documents.sparkSession
    items = (items.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id"))
             .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    items = written(items, "ranking-items")
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).orderBy("item_id").collect()
        ranks = _block(documents, [(r["item_id"], r["text"]) for r in mine], top, id_col, text_col)
        if ranks is not None:
            found = found.unionByName(ranks if blocks == 1 else written(ranks, "ranking-block"))
    return found
