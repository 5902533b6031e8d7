"""Best-fit packing of tokenised documents by linear grouping.

1. Every document becomes token ids plus one end id; only documents longer than
   a sequence are cut, into full pieces and a last one.
2. Linear grouping: the large pieces, in descending order of length, are cut into
   groups of equal cardinality, and every length is rounded up to its group's
   largest.  The few sizes left are packed by configurations: column generation
   over the linear programme (dual prices, a knapsack for the best configuration),
   rounded down, and the remainder by first fit on the rounded sizes.
3. Substitution: actual documents, ranked by length, take the slots of their
   group; since lengths were rounded up they fit.
4. The small pieces, longest first, go where the least room is left (best fit),
   and to new sequences when no room is left.

The driver sees histograms of lengths and of room only (at most 2048 numbers
each) and makes plans of bounded size.  Documents are matched with the plan by
their rank among the pieces of equal length.  Ranks come from counts per length
and hash bucket, so one frequent length is spread over many tasks, and they do
not depend on how rows are dealt out.

Inputs and edge cases: null texts are empty (one piece with the end id); null and
repeated ids are packed row by row; an empty table gives an empty result; equal
lengths are told apart by id, piece and content; extra columns do not matter.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from unicodedata import is_normalized, normalize

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import written

CAPACITY = 2048
END_ID = 0
SMALL = CAPACITY // 3   # pieces up to this length are small
GROUPS = 12
CACHE_CHUNKS = 120_000  # of one generation
CACHED_BYTES = 64

_SYMBOLS = b".,;:!?%$#&*|"
# symbols between a small ASCII letter or digit and white space
_TRAILING = re.compile(rb"(?<=[a-z0-9])([" + re.escape(_SYMBOLS) + rb"]+)(?!\S)").sub
# the printable character that byte-level vocabularies write for each byte
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Ids(dict):
    """Chunk without white space -> its ids as bytes.

    The vocabulary drops white space and never joins characters across it, so a
    text's ids are those of its chunks.  At ``CACHE_CHUNKS`` entries a new generation
    begins; what is still used moves over from the last one, the rest is forgotten."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.model, self.last = tokenizer, tokenizer.model, {}
        probes = ("word", "thndwhat", "straße", "größenordnung", "été")
        added = tokenizer.get_added_tokens_decoder().values()
        self.plain = (all(self.pieces(w) == self.whole(w) for w in probes)
                      and not any(t.content.isalpha() for t in added))
        # chunks with one of these take no short way
        self.marked = re.compile(b"|".join(re.escape(t.content.lower().encode()) for t in added) or b"(?!)").search
        odd = [t.content for t in added if t.lstrip or t.rstrip or t.single_word or t.normalized or t.content.split() != [t.content]]
        if odd or not self.holds(probes):
            raise ValueError(f"texts cannot be cut at white space and symbols for this vocabulary {odd or ''}")

    def holds(self, probes: tuple[str, ...]) -> bool:
        """Whether chunks, words, trailing symbols and ASCII case are independent, on probes."""
        heads = [*probes, "7", "it's"]
        cuts = [(a, gap, b) for a in heads for b in heads for gap in " \n\t"]
        cuts += [(a, "", chr(b)) for a in heads for b in _SYMBOLS] + [("a", "", _SYMBOLS.decode())]
        return (all(self.whole(a + gap + b) == self.whole(a) + self.whole(b) for a, gap, b in cuts)
                and all(self.whole(w.upper()) == self.whole(w) for w in (*"abcdefghijklmnopqrstuvwxyz", "word", "it's")))

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pieces(self, word: str) -> list[int]:
        """Ids of one word of small letters: the model alone, on its bytes' characters."""
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))]

    def encode(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        # a word of small letters needs no normalising and no cutting
        word = self.plain and text.isalpha() and text == text.lower() and is_normalized("NFC", text)
        ids = self.pieces(text) if word else self.whole(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: str) -> bytes:
        """The ids of a whole text.

        Where nothing composes with another case and no special string stands, capitals and
        trailing symbols go first, in one pass, so fewer different chunks are looked up."""
        raw = text.encode("utf-8", "replace")
        small = raw.lower()
        if not self.marked(small) and (raw.isascii() or all(is_normalized("NFC", c.decode()) for c in (raw, small))):
            raw = _TRAILING(rb" \1", small)
        return b"".join([self[c] for c in raw.split()])

    def __missing__(self, chunk: bytes) -> bytes:
        value = self.last.get(chunk)
        if value is None and self.plain and chunk.isalpha() and chunk.islower():
            value = self.encode(chunk)  # small ASCII letters only
        if value is None:
            # letters, digits and symbols are never in one token, so a word and the
            # symbols behind it are looked up apart if it ends in a letter or digit after
            # normalising (some letters end in a mark then); the case of ASCII does not matter,
            # unless a character composes with the capital or the small letter
            stem, small = chunk.rstrip(_SYMBOLS), chunk.lower()
            last = normalize("NFC", stem[-4:].decode("utf-8", "ignore")[-1:]).lower()[-1:]
            if self.marked(small):
                value = self.encode(chunk)
            elif stem != chunk and (last.isalpha() or last.isdecimal()):
                value = self[stem] + self[chunk[len(stem):]]
            elif chunk != small and (chunk.isascii() or all(is_normalized("NFC", c.decode()) for c in (chunk, small))):
                value = self[small]
            else:
                value = self.encode(chunk)
        if len(chunk) <= CACHED_BYTES:
            if len(self) >= CACHE_CHUNKS:
                self.last = dict(self)
                self.clear()
            self[chunk] = value
        return value


@lru_cache(maxsize=2)
def _open(path: str, specials: bool) -> Ids:
    """One tokenizer and cache for each worker process."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not specials
    return Ids(tokenizer)


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text", specials: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    With ``specials`` the ids are those of a plain ``encode(text, add_special_tokens=False)``:
    a special string in a text is its own id.  Without, it is ordinary text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _open(tokenizer_path, specials)
        end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                raw = ids.text(text) + end
                for piece, a in enumerate(range(0, len(raw), step)):
                    part = raw[a:a + step]
                    rows.append((doc_id, piece, a // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.mapInPandas(run, _PIECES)


def ranked(df: DataFrame, group: str, order: list[str], rank: str) -> DataFrame:
    """Number the rows of each group from 0.

    Rows are dealt to hash buckets within a group; a row's number is its place in
    the bucket plus the rows of the buckets before, so a group that holds most
    rows is numbered by many tasks."""
    buckets = max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.withColumn("bucket_", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(group, "bucket_").agg(F.count("*").alias("n_"))
               .withColumn("before_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_"))
    inside = Window.partitionBy(group, "bucket_").orderBy(*order)
    return (dealt.withColumn("inside_", F.row_number().over(inside) - 1)
            .join(offsets, [group, "bucket_"])
            .withColumn(rank, (F.col("before_") + F.col("inside_")).cast("long"))
            .drop("bucket_", "before_", "inside_"))


@dataclass
class LargePlan:
    """Slots of the large pieces: ``above[L]`` large pieces are longer than L, a
    group holds ``group_rows`` of them, and ``slots[g]`` lists (first rank, first
    sequence, copies) of the configurations that use group g."""

    above: np.ndarray
    group_rows: int
    slots: list[list[tuple[int, int, int]]]
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        at = self.above[length] + rank
        group, inside = at // self.group_rows, at % self.group_rows
        out = np.zeros(len(at), np.int64)
        for g in np.unique(group):
            mine = np.flatnonzero(group == g)
            first, start, copies = (np.array(x) for x in zip(*self.slots[g], strict=True))
            k = np.searchsorted(first, inside[mine], side="right") - 1
            out[mine] = start[k] + (inside[mine] - first[k]) % copies[k]
        return out


def _best_configuration(sizes: list[int], prices: np.ndarray, demand: list[int], capacity: int) -> np.ndarray:
    """Unbounded knapsack by lengths: the configuration of the highest price."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    size = np.array(sizes)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = np.flatnonzero(size <= room)
        if len(fits):
            value = best[room - size[fits]] + prices[fits]
            k = int(value.argmax())
            if value[k] > best[room] + 1e-12:
                best[room], last[room] = value[k], fits[k]
    found, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            found[last[room]] += 1
            room -= sizes[last[room]]
    return found


def configurations(sizes: list[int], demand: list[int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pieces of each size, sequences) that hold the demand exactly.

    Column generation over the linear programme, rounded down; what is left (a few
    pieces for each size) goes by first fit."""
    n = len(sizes)
    columns = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    for _ in range(20 * n + 50):
        prices = np.linalg.solve(columns.T, np.ones(n))
        new = _best_configuration(sizes, np.maximum(prices, 0), demand, capacity)
        if new @ prices <= 1 + 1e-7:
            break
        use, way = np.linalg.solve(columns, need), np.linalg.solve(columns, new)
        ratio = np.where(way > 1e-9, use / np.where(way > 1e-9, way, 1), np.inf)
        columns[:, int(ratio.argmin())] = new
    use = np.linalg.solve(columns, need)
    left, plan = np.array(demand), {}
    for k in range(n):
        copies, config = int(max(0, np.floor(use[k] + 1e-9))), columns[:, k].astype(int)
        used = config > 0
        copies = min(copies, int((left[used] // config[used]).min()))
        if copies:
            left = left - copies * config
            plan[tuple(config.tolist())] = plan.get(tuple(config.tolist()), 0) + copies
    while left.any():
        room, config = capacity, np.zeros(n, int)
        for g in range(n):  # sizes descend
            config[g] = min(left[g], room // sizes[g])
            room -= config[g] * sizes[g]
        copies = int((left[config > 0] // config[config > 0]).min())
        left = left - copies * config
        plan[tuple(config.tolist())] = plan.get(tuple(config.tolist()), 0) + copies
    return list(plan.items())


def plan_large(counts: np.ndarray, small: int = SMALL, groups: int = GROUPS, capacity: int = CAPACITY) -> LargePlan:
    """counts[L]: pieces of length L.  Lengths above ``small`` and below ``capacity`` are large."""
    large = counts.copy()
    large[:small + 1] = 0
    large[capacity:] = 0
    above = np.concatenate([large[::-1].cumsum()[::-1][1:], [0]])
    total = int(large.sum())
    rows = max(1, -(-total // groups))
    sizes, demand, slots = [], [], []
    for first in range(0, total, rows):
        sizes.append(int(np.flatnonzero((above <= first) & (large > 0) & (above + large > first))[0]))
        demand.append(min(rows, total - first))
        slots.append([])
    bins, filled = 0, [0] * len(sizes)
    merged: dict[int, list[int]] = {}
    for g, s in enumerate(sizes):  # equal sizes are one row of the programme
        merged.setdefault(s, []).append(g)
    unit = sorted(merged, reverse=True)
    wanted = [sum(demand[g] for g in merged[s]) for s in unit]
    queue = [[(g, demand[g]) for g in merged[s]] for s in unit]
    for config, copies in (configurations(unit, wanted, capacity) if unit else []):
        todo = [(k, m) for k, m in enumerate(config) if m]
        for k, m in todo:
            for _ in range(m):  # one piece of this size in each of the copies
                at, want = bins, copies
                while want:
                    g, have = queue[k][0]
                    take = min(have, want)
                    slots[g].append((filled[g], at, take))
                    filled[g] += take
                    at, want = at + take, want - take
                    queue[k][0] = (g, have - take)
                    if have == take:
                        queue[k].pop(0)
        bins += copies
    return LargePlan(above, rows, slots, bins)


@dataclass
class SmallPlan:
    """Runs of small pieces: ``runs[L]`` lists (first rank, class, first number in
    the class, offset).  A class is the room that a sequence has before small
    pieces come; ``fresh`` new sequences are the class of the whole capacity."""

    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    fresh: int = 0

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        room, number, offset = (np.zeros(len(length), np.int64) for _ in range(3))
        for size in np.unique(length):
            mine = np.flatnonzero(length == size)
            first, cls, start, at = (np.array(x) for x in zip(*self.runs[int(size)], strict=True))
            k = np.searchsorted(first, rank[mine], side="right") - 1
            room[mine], offset[mine] = cls[k], at[k]
            number[mine] = start[k] + rank[mine] - first[k]
        return room, number, offset


def plan_small(counts: np.ndarray, rooms: np.ndarray, capacity: int = CAPACITY) -> SmallPlan:
    """Best fit, longest first, on histograms: counts[L] small pieces of length L,
    rooms[R] sequences with room R.  Sequences of equal history move together."""
    plan = SmallPlan()
    open_: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (class, first, sequences)
    for r in np.flatnonzero(rooms):
        open_[r].append((int(r), 0, int(rooms[r])))
    filled = [r for r in range(capacity + 1) if open_[r]]
    for size in np.flatnonzero(counts)[::-1].tolist():
        left, rank, runs = int(counts[size]), 0, []
        while left:
            k = bisect_right(filled, size - 1)
            if k == len(filled):
                new = -(-left // (capacity // size))
                open_[capacity].append((capacity, plan.fresh, new))
                plan.fresh += new
                filled.append(capacity)
                continue
            room = filled[k]
            cls, first, many = open_[room].pop()
            take = min(left, many)
            runs.append((rank, cls, first, capacity - room))
            if many > take:
                open_[room].append((cls, first + take, many - take))
            if not open_[room]:
                filled.pop(k)
            less = room - size
            if less and not open_[less]:
                filled.insert(bisect_right(filled, less), less)
            open_[less].append((cls, first, take))
            left, rank = left - take, rank + take
        plan.runs[size] = runs
    return plan


def _histogram(df: DataFrame, column: str, size: int) -> np.ndarray:
    """Counts by value; at most ``size`` rows come to the driver."""
    out = np.zeros(size, np.int64)
    for value, n in df.groupBy(column).agg(F.count("*").alias("n")).collect():
        out[value] = n
    return out


def _sequences(spark: SparkSession, plan: LargePlan) -> Column:
    """The sequence of every large piece; the plan's size is bounded by the capacity."""
    shared = spark.sparkContext.broadcast(plan)

    @F.pandas_udf("long")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for length, rank in batches:
            place = shared.value.place(length.to_numpy(np.int64), rank.to_numpy(np.int64)) if len(length) else []
            yield pd.Series(place, dtype="int64")

    return run("length", "rank")


def _gaps(spark: SparkSession, plan: SmallPlan) -> Column:
    """Class, number in the class and offset of every small piece."""
    shared = spark.sparkContext.broadcast(plan)

    @F.pandas_udf("room int, number long, offset long")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for length, rank in batches:
            place = shared.value.place(length.to_numpy(np.int64), rank.to_numpy(np.int64)) if len(length) else [[]] * 3
            yield pd.DataFrame(dict(zip(("room", "number", "offset"), place, strict=True)))

    return run("length", "rank")


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text", specials: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    (``specials`` as in ``pieces``)."""
    spark = documents.sparkSession
    cut = written(pieces(documents, tokenizer_path, capacity, id_col, text_col, specials), "packing-pieces")
    counts = _histogram(cut, "length", capacity + 1)
    order = ["doc_id", "piece", "start", "ids_crc32"]
    rows = written(ranked(cut, "length", order, "rank"), "packing-ranked")

    small = capacity // 3 if capacity != CAPACITY else SMALL
    is_large = (F.col("length") > small) & (F.col("length") < capacity)
    plan = plan_large(counts, small, GROUPS, capacity)
    large = rows.where(is_large).withColumn("bin", _sequences(spark, plan))
    # a sequence holds less than capacity / small large pieces, so these lists are short
    member = F.struct(F.col("length").alias("l"), *order)
    bins = (large.groupBy("bin").agg(F.sort_array(F.collect_list(member), asc=False).alias("members"),
                                     (F.lit(capacity) - F.sum("length")).cast("int").alias("room")))
    bins = written(ranked(bins, "room", ["bin"], "number"), "packing-large")

    rooms = _histogram(bins, "room", capacity + 1)
    light = counts.copy()
    light[small + 1:] = 0
    best = plan_small(light, rooms, capacity)
    rooms[capacity] = best.fresh
    base = np.concatenate([[0], rooms.cumsum()])  # sequences are numbered class by class, then full pieces
    base_of = F.element_at(F.array(*[F.lit(int(b)) for b in base[:-1]]), F.col("room") + 1).cast("long")

    columns = [*order[:3], "length", "ids_crc32", "sequence_id", "offset"]
    full = (rows.where(F.col("length") == capacity)
            .select("*", (F.lit(int(base[-1])) + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    laid = (bins.select("room", "number", F.posexplode("members").alias("at", "m"), "members")
            .withColumn("sequence_id", base_of + F.col("number"))
            .withColumn("offset", F.aggregate(F.slice("members", 1, F.col("at")), F.lit(0).cast("long"), lambda s, x: s + x.l))
            .select("m.*", F.col("m.l").alias("length"), "sequence_id", "offset"))
    fitted = (rows.where(F.col("length") <= small)
              .withColumn("to", _gaps(spark, best))
              .select(*order, "length", "to.*").withColumn("sequence_id", base_of + F.col("number")))
    out = full.select(*columns).unionByName(laid.select(*columns)).unionByName(fitted.select(*columns))
    return out
