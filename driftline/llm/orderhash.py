"""Document fingerprints by order MinHash, in DataFrame functions only.

A text's words give k-mers (k words in a row); the j-th occurrence of a k-mer is
its own element (k-mer, j), so repeats count.  Every element has a 64-bit hash,
whose leading bits pick one of ``BINS`` bins.  In each bin the ``KEPT`` elements
with the least hashes are selected, put back into text order, and their tuple is
hashed: two texts agree in a bin if they select the same elements in the same
order, which makes the signature sensitive to edit distance and not only to the
set of k-mers.  One hash dealt to bins stands for many hash functions (one
permutation), so a text is sorted twice and not once for every bin.

A bin of a short text often holds fewer than ``KEPT`` elements, and one element has
no order.  A full signature lets such a bin borrow from the bins behind it (the first
follow the last), so every bin selects ``KEPT`` elements if the text has as many; the
query uses full signatures.  Without borrowing, bins are selected from as they are.

The likeness of two fingerprints is the share of equal bins among those that are
not empty in both, and 1 if all are empty.

Everything about a text is computed in its own row, in time n log n for n words.
The next document (by id) comes from a window over blocks of ids; a block also
gets the first row of the block behind it, so no row is missing at an edge.

Inputs and edge cases: a null text is empty; an empty text has an empty signature;
a text of few words (``FEW`` or less: short texts, scripts without blanks, white space
only) is taken by its characters instead of its words; fewer units than k are one k-mer; null ids sort before
all others and equal ids by their texts' hash; the document after the last is the
first (a single document follows itself); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 3
FEW = 8                 # up to so many words a text's characters are its units
KEPT = 2
BIN_BITS = 6
BINS = 1 << BIN_BITS
EMPTY = 0               # the value of an empty bin; a hash of 0 is written as 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def _run_starts(n: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The indices at which a run begins among 0..n-1."""
    return F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | ~same(j, j - 1))


def _kmers(words: Column) -> Column:
    """(hash, place) of every k-mer, sorted."""
    def build(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(h) - WORDS, F.lit(0)))  # a short text: one k-mer
        return F.sort_array(F.transform(places, lambda i: F.struct(
            F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)]).alias("h"), i.alias("p"))))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), build)


def _elements(kmers: Column) -> Column:
    """(hash of k-mer and occurrence, place) of every element, sorted by hash."""
    def number(s: Column) -> Column:
        def runs(starts: Column) -> Column:
            return F.flatten(F.transform(starts, lambda d, r: F.transform(
                F.sequence(d, F.coalesce(F.get(starts, r + 1), F.size(s)) - 1),
                lambda j: F.struct(F.xxhash64(F.get(s, j)["h"], j - d).alias("g"), F.get(s, j)["p"].alias("p")))))
        return F.sort_array(_let(_run_starts(F.size(s), lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]), runs))
    return _let(kmers, number)


def _units(text: Column) -> Column:
    """The words of a text, or its characters if the words are few."""
    words = F.split(F.trim(text), r"[\x20\x09-\x0D]+")
    return _let(words, lambda w: F.when(F.size(w) > FEW, w).otherwise(F.split(text, "")))


def signature(text: Column) -> Column:
    """Array of ``BINS`` 32-bit numbers, ``EMPTY`` for an empty bin."""
    words = _units(text)

    def select(t: Column) -> Column:
        def bin_of(x: Column) -> Column:
            return F.shiftrightunsigned(x["g"], 64 - BIN_BITS).cast("int")

        def hashed(d: Column) -> Column:
            least = F.filter(F.slice(t, d + 1, KEPT), lambda x: bin_of(x) == bin_of(F.get(t, d)))
            in_order = F.sort_array(F.transform(least, lambda x: F.struct(x["p"].alias("p"), x["g"].alias("g"))))
            value = F.xxhash64(F.transform(in_order, lambda x: x["g"])).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
            return F.struct(bin_of(F.get(t, d)).alias("key"), F.greatest(value, F.lit(1)).alias("value"))

        starts = _run_starts(F.size(t), lambda a, b: bin_of(F.get(t, a)) == bin_of(F.get(t, b)))
        return _let(F.map_from_entries(F.transform(starts, hashed)), lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.coalesce(F.try_element_at(m, b), F.lit(EMPTY))))

    return F.when(text == "", F.array_repeat(F.lit(EMPTY), BINS)).otherwise(_let(_elements(_kmers(words)), select))


def full_signature(text: Column) -> Column:
    """Like ``signature``, but every bin selects ``KEPT`` elements: its own with the least
    hashes, then those of the bins behind it.  ``EMPTY`` only for an empty text."""
    words = _units(text)
    # hashes are signed, so the bins lie in the order 32..63, 0..31; a mark sorts before its bin
    marks = F.array(*[F.struct(F.lit((b << 64 - BIN_BITS) - 2**63).alias("g"), F.lit(-1).alias("p")) for b in range(BINS)])

    def select(t: Column) -> Column:
        def hashed(at: Column, b: Column) -> Column:
            chosen = F.slice(t, at - b + 1, KEPT)
            chosen = F.concat(chosen, F.slice(t, 1, F.least(F.lit(KEPT), F.size(t)) - F.size(chosen)))
            in_order = F.sort_array(F.transform(chosen, lambda x: F.struct(x["p"].alias("p"), x["g"].alias("g"))))
            value = F.xxhash64(F.transform(in_order, lambda x: x["g"])).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
            return F.greatest(value, F.lit(1))
        return hashed

    def build(t: Column) -> Column:
        marked = F.sort_array(F.concat(t, marks))
        places = _let(marked, lambda m: F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda j: F.get(m, j)["p"] < 0))
        values = F.transform(places, select(t))
        return _let(values, lambda v: F.concat(F.slice(v, BINS // 2 + 1, BINS // 2), F.slice(v, 1, BINS // 2)))

    return F.when(text == "", F.array_repeat(F.lit(EMPTY), BINS)).otherwise(_let(_elements(_kmers(words)), build))


def as_text(signature: Column) -> Column:
    """The signature as one text, 8 hexadecimal digits for each bin."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bins among those that are not empty in both signatures."""
    used = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x["a"] != EMPTY) | (x["b"] != EMPTY)))
    equal = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: (x["a"] == x["b"]) & (x["a"] != EMPTY)))
    return F.when(used == 0, F.lit(1.0)).otherwise(equal / used)


def fingerprint(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: doc_id, signature (array), fingerprint (one text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = documents.select(F.col(id_col).alias("doc_id"), signature(text).alias("signature"))
    return signed.withColumn("fingerprint", as_text(F.col("signature")))


def block_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds a value has reached (0 for null), by halving: a few
    steps for any number of bounds."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])

    def ahead(step: int) -> Callable[[Column], Column]:
        return lambda at: F.when((at + step <= len(bounds)) & (F.get(table, at + (step - 1)) <= value), at + step).otherwise(at)

    block, step = F.lit(0), 1 << len(bounds).bit_length()
    while step > 1:
        step >>= 1
        block = _let(block, ahead(step))
    return block


def with_next(documents: DataFrame, columns: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """Add ``next_<column>`` of the document with the next larger doc_id.  ``derived`` columns are
    computed once per document, and for the one more row of each block.

    Blocks of ids are cut at approximate quantiles; the bounds and the first id of
    each block are all that the driver sees (one number per block, four blocks for
    each shuffle partition).  A large block is sorted on disk."""
    spark = documents.sparkSession
    ids = documents.select("doc_id")
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # set by the cluster, not by the data
    cuts = ids.approxQuantile("doc_id", [k / blocks for k in range(1, blocks)], 1 / (4 * blocks))
    bounds = sorted({int(b) for b in cuts or []})
    block = block_of(F.col("doc_id"), bounds)
    placed = documents.withColumn("block_", block)
    firsts = sorted((r["block_"], r["first"]) for r in ids.withColumn("block_", block).groupBy("block_")
                    .agg(F.min_by("doc_id", F.struct("doc_id")).alias("first")).collect())
    edges = [(firsts[k - 1][0], firsts[k][1]) for k in range(len(firsts))]  # the last block is followed by the first
    edge = spark.createDataFrame(edges, "edge_block_ int, edge_id_ long")  # one row per block
    follow = (documents.join(F.broadcast(edge), F.col("doc_id").eqNullSafe(F.col("edge_id_")))
              .select(*documents.columns, F.col("edge_block_").alias("block_"), F.lit(1).alias("edge_")))
    rows = placed.select(*documents.columns, "block_", F.lit(0).alias("edge_")).unionByName(follow)
    rows = rows.withColumns(derived or {})
    order = Window.partitionBy("block_").orderBy("edge_", "doc_id", F.xxhash64("text"))
    return (rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
            .where("edge_ = 0").drop("block_", "edge_"))


def fingerprint_edits(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and the likenesses.

    The edited text replaces the last quarter of the characters by the beginning
    of the next document."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = with_next(docs, ["text", "signature"], {"signature": full_signature(F.col("text"))})
    size = F.length("text")
    tail = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - tail), F.substring(F.col("next_text"), F.lit(1), tail))
    changed = (signed.select("doc_id", size.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature")
               .withColumn("edited_signature", full_signature(F.col("edited"))))
    return changed.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                          as_text(F.col("signature")).alias("fingerprint"),
                          as_text(F.col("edited_signature")).alias("edited_fingerprint"),
                          likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
                          likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
