"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a vector of transformed statistics (lengths, character
classes, repetition, compressibility).  Learning takes the mean and the
covariance of every class, shrinks each covariance towards the pooled one and
towards a multiple of the identity, and keeps the inverse Cholesky factor and
the log determinant.  A score is the logistic of the difference of the two
Gaussian log-densities (Mahalanobis distance from the cached factor) plus the
log prior.

Inputs and edge cases:

* a null text counts as empty; an empty text has a fixed score of 0 (there is
  nothing to keep); any other text is read whole;
* null, repeated or clashing ids and extra columns do not matter: a score
  depends on the text of its own row alone;
* an empty table gives an empty result; without learning rows of both classes
  every non-empty text scores the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import labelled_rows

SAMPLE_ROWS = 4000  # most learning rows of each class; their statistics are fetched, not their texts
STATISTICS = ("log_bytes", "log_words", "log_word_length", "symbols", "capitals", "digits", "spaces",
              "stops", "repeat_1", "repeat_2", "block_variety", "log_line_length", "line_repeats",
              "log_ratio", "entropy", "shouted", "symbol_words")

_BYTE = np.arange(256)
_CAPITAL = (_BYTE >= 65) & (_BYTE <= 90)
_SMALL = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SPACE = np.isin(_BYTE, [9, 10, 11, 12, 13, 32])
_STOP = np.isin(_BYTE, [ord(c) for c in ".,;:'\"-()"])
_SYMBOL = (_BYTE < 128) & ~(_CAPITAL | _SMALL | _DIGIT | _SPACE | _STOP)
_CLASSES = np.stack([_SYMBOL, _CAPITAL, _DIGIT, _SPACE, _STOP, _CAPITAL | _SMALL | (_BYTE >= 128)]).astype(float)


def _root(share: float) -> float:
    """Variance-stabilising transform of a share."""
    return math.asin(math.sqrt(min(1.0, max(0.0, share))))


def statistics(text: str) -> np.ndarray:
    """The transformed statistics of one whole text."""
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    symbols, capitals, digits, spaces, stops, letters = _CLASSES @ counts
    words = raw.split()
    m = max(1, len(words))
    same_1 = sum(a == b for a, b in zip(words, words[1:], strict=False))
    same_2 = sum(a == b for a, b in zip(words, words[2:], strict=False))
    variety = sum(len(set(words[k:k + 64])) for k in range(0, len(words), 64)) / m
    lines = [line for line in raw.split(b"\n") if line]
    p = counts[counts > 0] / n
    squeezed = len(zlib.compress(raw, 1))
    odd = sum(not w[-1:].isalnum() and not w[-2:-1].isalnum() and w[-1] < 128 for w in words)
    shout = sum(w.isupper() and len(w) > 1 for w in words)
    return np.array([
        math.log(1 + len(raw)), math.log(1 + len(words)), math.log((len(raw) - spaces + 1) / m),
        _root(symbols / n), _root(capitals / max(1.0, letters)), _root(digits / n), _root(spaces / n),
        _root(stops / n), _root(same_1 / m), _root(same_2 / m), _root(variety),
        math.log(1 + n / max(1, len(lines))), _root(1 - len(set(lines)) / max(1, len(lines))),
        math.log(squeezed / n), float(-(p * np.log(p)).sum()) if len(p) else 0.0,
        _root(shout / m), _root(odd / m)])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians with cached inverse Cholesky factors; ``base`` is the
    constant log-odds when a class is missing."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    base: float | None = None
    temperature: float = 1.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(x), self.base)
        z = (x - self.centre) / self.scale
        log_density = []
        for k in (0, 1):
            y = (z - self.means[k]) @ self.factors[k].T
            log_density.append(self.offsets[k] - 0.5 * (y * y).sum(axis=1))
        return (log_density[1] - log_density[0]) / self.temperature

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = 0.05, spherical: float = 0.01,
        temperature: float = 4.0) -> Discriminant:
    """Class covariances, shrunk by ``pooled`` towards the common one and by
    ``spherical`` towards a multiple of the identity."""
    d = x.shape[1] if x.ndim == 2 else len(STATISTICS)
    none = np.zeros(d)
    counts = np.array([(y == 0).sum(), (y == 1).sum()], float)
    if counts.min() < 2:
        base = math.log((counts[1] + 1) / (counts[0] + 1))
        return Discriminant(none, none + 1, np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), base)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - centre) / scale
    means = np.stack([z[y == k].mean(axis=0) for k in (0, 1)])
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    common = (counts[0] * own[0] + counts[1] * own[1]) / counts.sum()
    factors, offsets = [], []
    for k in (0, 1):
        s = (1 - pooled) * own[k] + pooled * common
        s = (1 - spherical) * s + spherical * (np.trace(s) / d + 1e-6) * np.eye(d)
        low = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(low))
        offsets.append(math.log(counts[k] / counts.sum()) - np.log(np.diag(low)).sum())
    return Discriminant(centre, scale, means, np.stack(factors), np.array(offsets), None, temperature)


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Discriminant:
    """Learn from at most ``sample_rows`` labelled rows of each class that are not held out.

    The statistics are taken where the texts are; 17 numbers a row come to the driver."""
    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([statistics(t).tolist() for t in texts], dtype=object)

    rows = labelled_rows(documents, labels, "quality", sample_rows).where("text <> ''")
    rows = rows.select("id", "label", measured("text").alias("x")).orderBy(F.xxhash64("id"), "id").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r["label"] for r in rows], np.int64))


def score_column(model: Discriminant, text: Column) -> Column:
    """The score of every text as a column; no shuffle, one pass."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if not len(texts):
                yield pd.Series([], dtype=float)
                continue
            score = model.score(np.stack([statistics(t) for t in texts]))
            yield pd.Series(np.where(texts.to_numpy() == "", 0.0, score))

    return run(F.coalesce(text, F.lit("")))


def score_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``documents``: id, score of label 1, prediction (1 from 0.5 on)."""
    model = train(documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels, sample_rows)
    scored = documents.select(F.col(id_col).alias("doc_id"), score_column(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``documents`` that the classifier accepts, all columns as they are."""
    model = train(documents, labels, sample_rows)
    return documents.where(score_column(model, F.col("text")) >= 0.5)
