"""Toxicity by compression distance with two zstandard dictionaries.

The whole text is compressed in its order, repeats included.  Every letter, and the blank
behind a word, is written as four bytes that tell the word's beginning up to that letter.
Plain letters of different words look alike to a compressor's entropy coder, and a match of
a short word saves less than that noise; these bytes do not compress by themselves, so a window
gets shorter exactly by the runs of letters that a dictionary holds: beginnings of words,
whole words and sequences of words.  Windows of ``WINDOW_LETTERS`` letters are compressed
against two dictionaries:

* the ordinary one, trained on ordinary documents and padded to the length of the other;
* the toxic one: the ordinary bytes with a dictionary trained on toxic text in place of the
  padding.  The two share their entropy tables, their ordinary content and its distances, so
  a window's excess (ordinary length less toxic length) is due to toxic text.

Labels mark documents, while most words of a toxic document are ordinary.
Learning repeats ``ROUNDS`` times: dictionaries learnt on two thirds of the
learning documents judge the words of the last third; the words with the largest
excess become the next toxic sample, and those that wrongly gain in ordinary
documents are added to the ordinary dictionary.  The last out-of-fold windows
calibrate a logistic curve over a document's largest excesses, their rate and
its length; a score of 0.7 or more predicts 1.

Learning is bounded by ``SAMPLE_ROWS`` rows of a class, ``ORDINARY_WINDOWS`` windows of an
ordinary document, spread over it, ``TOP_WORDS`` words of a toxic document and round, and by
the dictionaries' sizes.  Scoring has no bounds.

Inputs and edge cases: a null text counts as empty; a text without words scores
0; every window of a text of any length is compressed; a word beyond ``LONGEST_WORD``
letters counts as several; repeated rows get equal scores; other columns do not matter.
Without learning rows of both classes every text with words scores the share of label 1
(0 without any label).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import labelled_sample

SAMPLE_ROWS = 1200      # most learning rows of each class that are fetched
WINDOW_LETTERS = 24
LONGEST_WORD = 256
PIECE_WORDS = 1024      # words that are written as bytes at once
ORDINARY_BYTES = 262144
TOXIC_BYTES = 8192
HEADER_BYTES = 700      # a trained dictionary's tables take no more than this
MISSED_WORDS = 4000     # ordinary words laid over the ordinary dictionary
ROUNDS = 4
FOLDS = 3
TOP_WORDS = 6           # toxic words taken from one document in a round
ORDINARY_WINDOWS = 40   # windows of an ordinary document in the samples
THRESHOLD = 0.7

_WORD = re.compile(r"\w{1,%d}" % LONGEST_WORD)
_WRAP = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_POWERS, _INVERSES = (np.cumprod(np.append(np.uint64(1), np.full(PIECE_WORDS * (LONGEST_WORD + 1), f & _WRAP, np.uint64)))
                      for f in (_STEP, pow(_STEP, -1, 1 << 64)))
Size = Callable[[bytes], int]


def words_of(text: str) -> list[str]:
    """The words of a whole text, in text order, repeats included."""
    return _WORD.findall(text.lower())


def letters(words: list[str]) -> bytes:
    """Four bytes for every letter and the blank behind a word: the hash of the word's beginning up to there.

    The beginnings of all words are hashed at once: running sums of letter times
    a power of ``_STEP``, less the sum before the word, shifted back to its start."""
    code = np.frombuffer((" ".join(words) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sums = np.cumsum((code + np.uint64(1)) * _POWERS[:len(code)])
    ends = np.flatnonzero(code == 32)
    starts = np.append(0, ends[:-1] + 1)
    before = np.append(np.uint64(0), sums[ends[:-1]])
    n = ends - starts + 1
    h = (sums - np.repeat(before, n)) * np.repeat(_INVERSES[starts], n)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype("<u4").tobytes()


def windows(words: list[str]) -> list[bytes]:
    """The text in windows; they start anew every ``PIECE_WORDS`` words."""
    out = []
    for k in range(0, len(words), PIECE_WORDS):
        code = letters(words[k:k + PIECE_WORDS])
        out += [code[j:j + 4 * WINDOW_LETTERS] for j in range(0, len(code), 4 * WINDOW_LETTERS)]
    return out


def units(words: Iterable[str]) -> dict[str, bytes]:
    """The bytes of every word by itself."""
    out, rest = {}, list(dict.fromkeys(words))
    for k in range(0, len(rest), PIECE_WORDS):
        code, at = letters(rest[k:k + PIECE_WORDS]), 0
        for w in rest[k:k + PIECE_WORDS]:
            out[w] = code[at:at + 4 * len(w) + 4]
            at += 4 * len(w) + 4
    return out


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; too small a sample is its own (raw) dictionary."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(reversed([unit for unit, _ in Counter(samples).most_common()]))[-size:] or b"\0" * 32


def _sizer(dictionary: bytes) -> Size:
    params = zstandard.ZstdCompressionParameters.from_level(
        3, window_log=20, hash_log=18, chain_log=18, min_match=5,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(compression_params=params)
    compress = zstandard.ZstdCompressor(dict_data=loaded, compression_params=params).compress
    return lambda window: len(compress(window))


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes

    def sizers(self) -> tuple[Size, Size]:
        return _sizer(self.ordinary), _sizer(self.toxic)


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], missed: Counter[bytes]) -> Dictionaries:
    base = _trained(ordinary, ORDINARY_BYTES)
    base += b"".join(u for u, _ in reversed(missed.most_common(MISSED_WORDS)))
    over = _trained(toxic, TOXIC_BYTES)[-(TOXIC_BYTES - HEADER_BYTES):]
    return Dictionaries(base + b"\0" * len(over), base + over)


def excesses(cut: list[bytes], ordinary: Size, toxic: Size) -> np.ndarray:
    """Per window: how many bytes fewer the toxic dictionary needs (0 at least)."""
    return np.array([max(0, ordinary(w) - toxic(w)) for w in cut], float)


def features(excess: np.ndarray) -> np.ndarray:
    """Largest excesses, how often one shows up, and the length."""
    top = np.concatenate([-np.sort(-excess)[:8], np.zeros(8)])[:8]
    rate = (excess >= 5).sum() / max(1, len(excess)) ** 0.5
    return np.array([top[0], top[1], top[2], top[4], top[7], np.log1p(len(excess)), rate])


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries | None
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float = 0.0

    def curve(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.centre) / self.scale, np.ones(len(x))]
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))

    def scores(self, texts: Iterable[str], sizers: tuple[Size, Size] | None) -> np.ndarray:
        out = []
        for text in texts:
            words = words_of(text)
            if not words:
                out.append(0.0)
            elif sizers is None:
                out.append(self.base)
            else:
                out.append(self.curve(features(excesses(windows(words), *sizers))[None])[0])
        return np.array(out, float)


def _calibrated(x: np.ndarray, y: np.ndarray, dictionaries: Dictionaries) -> Model:
    """Ridge logistic regression by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.01 * np.eye(len(w))
        w += np.linalg.solve(h, z.T @ (y - p) - 0.01 * w)
    return Model(dictionaries, centre, scale, w)


def _spread(cut: list[bytes], most: int) -> list[bytes]:
    """At most ``most`` windows, evenly spread over the document."""
    return cut if len(cut) <= most else [cut[k * len(cut) // most] for k in range(most)]


def fit(texts: list[str], labels: np.ndarray) -> Model:
    docs = [words_of(t) for t in texts]
    keep = [i for i, d in enumerate(docs) if d]
    docs, y = [docs[i] for i in keep], np.asarray(labels)[keep] if keep else np.zeros(0)
    none = np.zeros(7)
    if min((y == 1).sum(), (y == 0).sum()) < FOLDS:
        return Model(None, none, none + 1, np.zeros(8), float(y.mean()) if len(y) else 0.0)
    order = np.argsort(y, kind="stable")
    fold = np.empty(len(docs), int)
    fold[order] = np.arange(len(docs)) % FOLDS
    cut = [windows(d) for d in docs]
    known = [list(dict.fromkeys(d)) for d in docs]  # judged word by word in the rounds
    unit = units(w for d in known for w in d)
    chosen = [[unit[w] for w in known[i]] if t else _spread(cut[i], ORDINARY_WINDOWS) for i, t in enumerate(y)]
    missed: list[list[str]] = [[] for _ in docs]

    def learn(rest: list[int]) -> Dictionaries:
        seen = Counter(unit[w] for i in rest for w in missed[i])
        return _dictionaries([u for i in rest if y[i] for u in chosen[i]], [u for i in rest if not y[i] for u in chosen[i]], seen)

    x = np.zeros((len(docs), 7))
    for turn in range(ROUNDS + 1):
        found: list[list[str]] = [[] for _ in docs]
        for k in range(FOLDS):
            ordinary, toxic = learn([i for i in range(len(docs)) if fold[i] != k]).sizers()
            gain: dict[str, int] = {}
            for i in np.flatnonzero(fold == k):
                if turn == ROUNDS:
                    x[i] = features(excesses(cut[i], ordinary, toxic))
                    continue
                for w in known[i]:
                    if w not in gain:
                        gain[w] = ordinary(unit[w]) - toxic(unit[w])
                found[i] = sorted((w for w in known[i] if gain[w] > 0), key=lambda w: (-gain[w], w))
        if turn < ROUNDS:
            for i, t in enumerate(y):
                if t:
                    chosen[i] = [unit[w] for w in found[i][:TOP_WORDS]]
                else:
                    missed[i] = list(dict.fromkeys(missed[i] + found[i][:40]))
    return _calibrated(x, y.astype(float), learn(list(range(len(docs)))))


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled rows of each class that are not held out."""
    rows = labelled_sample(documents, labels, "toxic", sample_rows)
    return fit(rows["text"].tolist(), rows["label"].to_numpy())


def score_column(model: Model, text: Column) -> Column:
    """The score of every text as a column; no shuffle, one pass."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizers = model.dictionaries.sizers() if model.dictionaries else None
        for texts in batches:
            yield pd.Series(model.scores(texts, sizers))

    return run(F.coalesce(text, F.lit("")))


def score_toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``documents``: id, score of label 1, prediction (1 from 0.7 on)."""
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = docs.select("doc_id", score_column(train(docs, labels, sample_rows), F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
