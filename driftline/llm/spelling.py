"""Spelling variants by reduced-alphabet generation.

* Words are runs of letters with enough code points and occurrences.
* Letters are hashed to ``symbols`` symbols.  One edit of a word is at most one edit
  of its reduced word (a replacement inside a symbol's letters leaves it as it is).
* For every word all reduced words within one edit (itself, deletions, replacements,
  insertions) are generated as 64-bit keys and joined with the keys of the reduced
  vocabulary.  A short alphabet keeps that neighbourhood short: about
  ``2 * symbols`` keys per code point.
* Every candidate is verified on the original strings: exactly one inserted, deleted
  or replaced code point.  Keys may collide; a collision costs a verification only.

The keys of a neighbourhood are polynomial hashes that follow from those of the
word's prefixes, so a very long word costs memory in proportion to its length.
Only numbers travel in the candidate join.

A word's form is its most frequent near word (ties: the smaller one in code-point
order) if that is at least ``ratio`` times as frequent; its root is the last word on
the chain of forms.  Along a chain the counts grow, so it ends; chains are followed
by pointer doubling on written tables.

Inputs and edge cases: null texts and texts without letters give no words; an
empty table gives an empty result; a null id counts as the empty text where an id
is hashed; repeated rows count each; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import written

LETTERS = "A-Za-zÀ-ÿ"
SYMBOLS = 8
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE = 0x9E3779B97F4A7C15   # odd, so it has an inverse modulo 2 ** 64
_BACK = pow(_BASE, -1, 1 << 64)
KEYS_PER_BATCH = 200_000


def lowered(run: Column) -> Column:
    """Only A-Z lower-cased; words of ASCII letters take the fast way."""
    return (F.when(F.octet_length(run) == F.char_length(run), F.lower(run))
            .otherwise(F.translate(run, _CAPITALS, _CAPITALS.lower())))


def runs(documents: DataFrame, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run): the lower-cased maximal runs of at least ``least`` letters of whole texts.

    A greedy match of so many letters or more is a maximal run."""
    found = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    return (documents.select(F.col(id_col).alias("doc_id"), found.alias("run"))
            .select("doc_id", lowered(F.col("run")).alias("run")))


def typed(run: Column, doc_id: Column, divisor: int = 199) -> Column:
    """The run, with one code point left out where ``divisor`` divides the hash of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.char_length(run)))
    return F.when(h % divisor == 0, shorter).otherwise(run)


def vocabulary(words: DataFrame, least: int = 6, occurrences: int = 5) -> DataFrame:
    """(id, word, n) of a column ``word``: long and frequent enough; written once, so ids stay."""
    counted = (words.where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
               .where(F.col("n") >= occurrences))
    return written(counted.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")


def reduced(word: str, symbols: int = SYMBOLS) -> np.ndarray:
    """The symbol of every code point."""
    points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return (((points * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)) >> np.uint64(9)) % np.uint64(symbols)


def _values(symbols: int) -> np.ndarray:
    """A 64-bit number for every symbol."""
    x = (np.arange(1, symbols + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) | np.uint64(1)


def neighbourhood(word: str, symbols: int = SYMBOLS) -> tuple[np.uint64, np.ndarray]:
    """The key of the reduced word, and the keys of all reduced words within one edit (itself too)."""
    s, value = reduced(word, symbols).astype(np.int64), _values(symbols)
    n = len(s)
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.cumprod(np.full(n, _BASE, np.uint64))
    head = np.zeros(n + 1, np.uint64)          # keys of the prefixes
    head[1:] = np.cumsum(value[s] * power[:n])
    own = head[n]
    deleted = head[:n] + (own - head[1:]) * np.uint64(_BACK)
    replaced = own + (value[None, :] - value[s][:, None]) * power[:n, None]
    inserted = head[:, None] + value[None, :] * power[:, None] + (own - head)[:, None] * np.uint64(_BASE)
    return own, np.unique(np.concatenate([deleted, replaced.ravel(), inserted.ravel(), [own]]))


def _keys(words: DataFrame, symbols: int, near: bool) -> DataFrame:
    """(id, key): the key of every word, or those of its neighbourhood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids: list, keys: list) -> pa.RecordBatch:
            key = np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64)
            many = [len(k) for k in keys]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), many)), pa.array(key)], ["id", "key"])

        for batch in batches:
            ids, keys, size = [], [], 0
            for i, word in zip(batch["id"].to_pylist(), batch["word"].to_pylist(), strict=True):
                own, around = neighbourhood(word, symbols)
                ids.append(i)
                keys.append(around if near else np.array([own], np.uint64))
                size += len(keys[-1])
                if size >= KEYS_PER_BATCH:
                    yield flush(ids, keys)
                    ids, keys, size = [], [], 0
            yield flush(ids, keys)

    return words.select("id", "word").mapInArrow(run, "id long, key long")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(id, near_id, near_word, near_n): both directions of every pair one edit apart.

    A reduced word that many words share is dealt out by Spark's skew join."""
    around = _keys(words, symbols, near=True)
    own = _keys(words, symbols, near=False).select(F.col("id").alias("near_id"), "key")
    pairs = around.join(own, "key").where("id <> near_id").select("id", "near_id")
    mine = words.select("id", "word")
    theirs = words.select(F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    one = F.levenshtein(F.col("word"), F.col("near_word"), 1) == 1
    return pairs.join(mine, "id").join(theirs, "near_id").where(one).select("id", "near_id", "near_word", "near_n")


def roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """(word, root) of a table (word, form) without cycles: chains are halved in every round."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = now.join(step, "root", "left")
        left = jumped.where("further IS NOT NULL").limit(1).count()
        if not left:
            return now
        now = written(jumped.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    raise RuntimeError("the chains of forms did not end")


def group_variants(words: DataFrame, ratio: int = 5, symbols: int = SYMBOLS) -> DataFrame:
    """One row per word of a vocabulary (id, word, n): word, form, root, n, n_near, form_n."""
    best = (near_words(words, symbols).groupBy("id")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near_word")).alias("best")))
    rows = words.join(best, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    rows = written(rows.select("word", "n", "n_near", F.col("best.near_word").alias("form"), (-F.col("best.less")).alias("form_n")),
                   "spelling-forms")
    named = rows.join(roots(rows.where("form IS NOT NULL")), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
