"""Benchmark decontamination: size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with it,
so plain MinHash would miss it.  Items are partitioned by size into classes whose
upper bound is a power of two, and for a class of bound S every document is cut
into windows of 2 S shingles, overlapping by S: windows are comparable to the
items, so the containment threshold becomes a Jaccard threshold that does not
depend on the document's length.  A window and an item are compared by one value
per hash function (bands of one row); an item is a candidate for a document if
any of the ``HASHES`` minima agree in any window.

If a document holds a share t of an item's q shingles, anywhere in it, the
expected number of agreeing minima is at least HASHES * t q / (2 S + q), with
q > S / 2; for t = 0.8 and 64 hashes that is 10 or more, so a miss has a chance
of about e^-10 at most (in pieces all over the text) and far less for a passage in one piece.
Items of a single shingle have no minima to compare: their hash is looked up among all
shingle hashes of a document, so none is missed.  Every candidate is then verified exactly,
on the distinct shingles themselves.

Words are runs of ASCII letters, digits and any characters beyond ASCII, in lower
case; a shingle is five words, and a text with fewer words is one shingle of all
of them.  Nothing is sampled or
cut off.  The items are read in blocks of at most ``BLOCK_ITEMS``, each broadcast
to the scan of the documents, so memory is bounded for any benchmark.

Inputs and edge cases: null and word-less texts match nothing; rows without an id
are searched and reported with a null id; repeated ids are searched row by row
and reported once with their largest containment; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 64
LEAST_CLASS = 2         # shingles in the smallest size class; items of one shingle are looked up
BLOCK_ITEMS = 20_000    # items in one broadcast block, about 40 MB
PIECE = 1 << 10         # shingles of a document whose minima are taken at a time
TEXT_PIECE = 1 << 20    # bytes of a document that are hashed at a time
FLAG_BITS = 20

_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_TABLE = bytes(b if _INSIDE[b] else 32 for b in range(256))
_BASE = np.uint64(0xD6E8FEB86659FD93)     # an odd number, and its inverse modulo 2 ** 64
_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))
_RANDOM = np.random.default_rng(20240)
_FACTORS = _RANDOM.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd constant of the golden ratio, for mixing


def normal(text: str) -> bytes:
    """Lower case, with a blank for every byte that is in no word."""
    return text.lower().encode("utf-8", "replace").translate(_TABLE)


def shingles(words: list[bytes], size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The distinct shingles as word tuples (for the exact check)."""
    if not words:
        return set()
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    return x ^ (x >> np.uint64(29))


class Powers:
    """Powers of the base and of its inverse, as many as have been asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE)]).cumprod(dtype=np.uint64)
            self.down = np.concatenate([[np.uint64(1)], np.full(2 * n, _INVERSE)]).cumprod(dtype=np.uint64)
        return self.up, self.down


def _word_hashes(raw: bytes, powers: Powers) -> np.ndarray:
    """Polynomial hashes of the blank-separated words, from sums over the bytes."""
    byte = np.frombuffer(raw, np.uint8)
    up, down = powers.upto(len(byte) + 1)
    inside = np.concatenate([[False], byte != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    total = np.concatenate([[np.uint64(0)], np.cumsum(byte.astype(np.uint64) * up[:len(byte)], dtype=np.uint64)])
    return _mix((total[ends] - total[starts]) * down[starts])


def shingle_hashes(raw: bytes, powers: Powers, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles of a normal text, in text order."""
    parts, a = [], 0
    while a < len(raw):
        z = raw.find(b" ", a + TEXT_PIECE)  # pieces end at a blank
        z = len(raw) if z < 0 else z
        parts.append(_word_hashes(raw[a:z], powers))
        a = z
    word = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    size = min(size, len(word))
    h = np.zeros(len(word) - size + 1 if size else 0, np.uint64)
    for k in range(size):
        h = _mix(h + word[k:k + len(h)])
    return h


def size_class(shingle_count: int) -> int:
    """Upper bound of the size class: the next power of two."""
    return max(LEAST_CLASS, 1 << (max(1, shingle_count) - 1).bit_length())


def _permuted(h: np.ndarray) -> np.ndarray:
    """One column per hash function: an odd multiplier and a shift permute the 64-bit numbers."""
    out = np.multiply(h[:, None], _FACTORS[None, :])
    out += _SHIFTS
    return out


def _halved(x: np.ndarray) -> np.ndarray:
    """Minima of neighbouring rows; an odd last row stays."""
    half = len(x) // 2
    low = np.minimum(x[0:2 * half:2], x[1:2 * half:2])
    return np.concatenate([low, x[-1:]]) if len(x) % 2 else low


def item_minima(h: np.ndarray) -> np.ndarray:
    """The minimum of the shingle hashes under every hash function."""
    return _permuted(h).min(axis=0)


@dataclass(frozen=True)
class Block:
    """A block of items: their texts' shingles and, by size class, the sorted
    minima of all hash functions, the items that have them, and a table of flags
    by leading bits that tells most other values apart at once.  ``single`` is the same for
    the hashes of items of one shingle."""

    ids: list
    shingles: list[set[tuple[bytes, ...]]]
    single: tuple[np.ndarray, np.ndarray, np.ndarray]
    index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def build(ids: list, texts: list[str]) -> Block:
    powers, sets, classes, single = Powers(), [], {}, []
    for at, text in enumerate(texts):
        raw = normal(text)
        sets.append(shingles(raw.split()))
        if len(sets[-1]) == 1:
            single.append((at, shingle_hashes(raw, powers)[:1]))
        elif sets[-1]:
            classes.setdefault(size_class(len(sets[-1])), []).append((at, item_minima(shingle_hashes(raw, powers))))
    return Block(ids, sets, _lookup(single, 1), {bound: _lookup(found, HASHES) for bound, found in classes.items()})


def _lookup(found: list[tuple[int, np.ndarray]], each: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted values, the items that have them, and flags by leading bits."""
    at = np.repeat(np.array([f[0] for f in found], np.int64), each)
    values = np.concatenate([np.zeros(0, np.uint64), *(f[1] for f in found)])
    order = np.argsort(values, kind="stable")
    flags = np.zeros(1 << FLAG_BITS, bool)
    flags[values >> np.uint64(64 - FLAG_BITS)] = True
    return values[order], at[order], flags


def _hits(values: np.ndarray, lookup: tuple[np.ndarray, np.ndarray, np.ndarray]) -> set[int]:
    """The items that have any of the values."""
    keys, items, flags = lookup
    values = np.unique(values[flags[values >> np.uint64(64 - FLAG_BITS)]])
    first, last = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
    return {i for k in np.flatnonzero(last > first) for i in items[first[k]:last[k]].tolist()}


def candidates(h: np.ndarray, block: Block) -> set[int]:
    """Items with an agreeing minimum in any window of a document's hashes."""
    out = _hits(h, block.single) if len(block.single[0]) else set()
    bounds = sorted(block.index)
    for a in range(0, len(h) if bounds else 0, PIECE):
        # every piece starts one largest block early, so no window is lost
        low, size = _permuted(h[max(0, a - bounds[-1]):a + PIECE]), 1
        for bound in bounds:
            # minima of blocks of ``bound`` shingles, from those of the class before
            while size < bound:
                low, size = _halved(low), 2 * size
            out |= _hits((np.minimum(low[:-1], low[1:]) if len(low) > 1 else low).ravel(), block.index[bound])
    return out


def matches(text: str, block: Block, powers: Powers, threshold: float) -> list[tuple[int, int]]:
    """(item, shingles in common) of the items that the text holds."""
    raw = normal(text)
    found = candidates(shingle_hashes(raw, powers), block) if block.index or len(block.single[0]) else set()
    if not found:
        return []
    own = shingles(raw.split())
    common = ((i, len(block.shingles[i] & own)) for i in sorted(found))
    return [(i, n) for i, n in common if n >= threshold * len(block.shingles[i]) - 1e-9]


def blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> Iterator[Block]:
    """The items in blocks; items without a word can be in nothing."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).where("text IS NOT NULL")
    total = items.count()
    parts = max(1, -(-2 * total // block_items)) if total > block_items else 1
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).distinct().orderBy("item_id", "text").toPandas()
        yield build([None if pd.isna(i) else int(i) for i in rows["item_id"]], rows["text"].tolist())


def hits_column(spark: SparkSession, block: Block, text: Column, threshold: float) -> Column:
    """Array of (item_id, n_shingles, n_common) for every text; no shuffle."""
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf("array<struct<item_id:long,n_shingles:long,n_common:long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block, powers = shared.value, Powers()
        for texts in batches:
            yield pd.Series([[{"item_id": block.ids[i], "n_shingles": len(block.shingles[i]), "n_common": n}
                              for i, n in matches(t, block, powers, threshold)] for t in texts], dtype=object)

    return run(F.coalesce(text, F.lit("")))


def find_leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) of every item in a document."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in blocks(benchmark):
        part = (docs.select("doc_id", F.explode(hits_column(documents.sparkSession, block, F.col("text"), threshold)).alias("hit"))
                .select("doc_id", "hit.*"))
        found = part if found is None else found.unionByName(part)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max_by(F.struct("n_shingles", "n_common"), F.col("n_common") / F.col("n_shingles")).alias("best"))
            .select("doc_id", "item_id", "best.n_shingles", "best.n_common",
                    (F.col("best.n_common") / F.col("best.n_shingles")).alias("containment")))


def without_leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``documents`` that hold no item, all columns as they are; no shuffle."""
    kept = documents
    for block in blocks(benchmark):
        kept = kept.where(F.size(hits_column(documents.sparkSession, block, F.col("text"), threshold)) == 0)
    return kept
