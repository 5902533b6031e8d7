"""Language identification by a bidirectional gated recurrent network over bytes.

The UTF-8 bytes of a text are cut into windows.  In each window one recurrent
layer reads forwards and one backwards; at every position the two states give
probabilities of the languages, and a document's probability of a language is
their mean over all positions.  The network is trained in numpy by
backpropagation through time, with the document's language as the label of every
position of the learning windows.

A text shorter than a window is filled up with blanks, which do not count.  The
last window of a longer text ends with the text, and only the positions that no
earlier window labelled count.

Inputs and edge cases: a null text, an empty one and one without a letter give
``und`` with score 0; a text of any length is read whole; other columns are not
read; an empty table gives an empty result; without learning rows every text is
``und``, and with one language only every text with a letter is that one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import held_out

UNKNOWN = "und"
SAMPLE_ROWS = 2400      # most learning rows that are fetched, over all languages
SAMPLE_CHARS = 4096     # a learning row is a window of so many characters, anywhere in its text
LEAST_SCORE = 0.4       # a filter keeps documents from this score on
HIDDEN = 8
WINDOW = 64
BATCH = 256             # learning windows in a step
STEPS = 300
WINDOWS_AT_ONCE = 2048  # windows that are labelled together
RATE = 0.02

Layer = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, np.float32(0.5), out=x)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _layer(rng: np.random.Generator, hidden: int) -> Layer:
    scale = hidden ** -0.5
    return {"w": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            "u": rng.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32),
            "b": np.zeros(hidden, np.float32)}


def forward(layer: Layer, x: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States after every byte: x is (steps, windows), the result one more axis.

    Update gate z, reset gate r, candidate n: h' = n + z (h - n)."""
    k = layer["u"].shape[0]
    h = np.zeros((x.shape[1], k), np.float32)
    out = np.empty((*x.shape, k), np.float32)
    for t in range(x.shape[0]):
        a, g = layer["w"][x[t]], h @ layer["u"]
        zr = _sigmoid(a[:, :2 * k] + g[:, :2 * k])
        z, r = zr[:, :k], zr[:, k:]
        own = g[:, 2 * k:] + layer["b"]
        n = np.tanh(a[:, 2 * k:] + r * own)
        if tape is not None:
            tape.append((h, z, r, n, own))
        h = n + z * (h - n)
        out[t] = h
    return out


def backward(layer: Layer, x: np.ndarray, tape: list, d_out: np.ndarray) -> Layer:
    """Gradients of a layer from those of its states, through time."""
    k = layer["u"].shape[0]
    d_a = np.empty((*x.shape, 3 * k), np.float32)
    grad = {"u": np.zeros_like(layer["u"]), "b": np.zeros_like(layer["b"])}
    carry = np.zeros(d_out.shape[1:], np.float32)
    for t in range(x.shape[0] - 1, -1, -1):
        h, z, r, n, own = tape[t]
        d = d_out[t] + carry
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (h - n) * z * (1 - z)
        d_r = d_n * own * r * (1 - r)
        d_a[t] = np.concatenate([d_z, d_r, d_n], axis=1)
        d_g = np.concatenate([d_z, d_r, d_n * r], axis=1)
        grad["u"] += h.T @ d_g
        grad["b"] += (d_n * r).sum(axis=0)
        carry = d * z + d_g @ layer["u"].T
    grad["w"] = np.zeros_like(layer["w"])
    np.add.at(grad["w"], x.ravel(), d_a.reshape(-1, 3 * k))
    return grad


@dataclass(frozen=True)
class Network:
    languages: list[str]
    ahead: Layer
    back: Layer
    top: Layer

    def logits(self, x: np.ndarray, tapes: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """x is (steps, windows) of bytes; the logits, and the states of both directions."""
        f = forward(self.ahead, x, tapes[0] if tapes else None)
        b = forward(self.back, x[::-1], tapes[1] if tapes else None)[::-1]
        return f @ self.top["f"] + b @ self.top["g"] + self.top["c"], f, b

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = self.logits(x)[0]
        out -= out.max(axis=2, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=2, keepdims=True)
        return out


def cut(raw: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a text (windows, bytes) and the first position that counts in each."""
    n = len(raw)
    if n <= window:
        return np.frombuffer(raw.ljust(window, b" "), np.uint8)[None], np.zeros(1, np.int64)
    byte = np.frombuffer(raw, np.uint8)
    whole = n // window
    rows, first = byte[:whole * window].reshape(whole, window), np.zeros(whole, np.int64)
    if n % window:
        rows, first = np.concatenate([rows, byte[None, n - window:]]), np.append(first, window - n % window)
    return rows, first


def train_network(texts: list[str], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN,
                  seed: int = 7) -> Network:
    """Cross-entropy of every position, by Adam on random windows, languages in equal shares."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    rows = {name: [] for name in names}
    for text, label in zip(texts, labels, strict=True):
        rows[label].append(cut(text.encode("utf-8", "replace"))[0])
    pool = [np.concatenate(rows[name]) for name in names]
    top = {"f": rng.normal(0, 0.3, (hidden, len(names))).astype(np.float32),
           "g": rng.normal(0, 0.3, (hidden, len(names))).astype(np.float32), "c": np.zeros(len(names), np.float32)}
    net = Network(names, _layer(rng, hidden), _layer(rng, hidden), top)
    if len(names) < 2:
        return net
    layers = (net.ahead, net.back, net.top)
    moments = [{k: (np.zeros_like(v), np.zeros_like(v)) for k, v in layer.items()} for layer in layers]
    for step in range(1, steps + 1):
        which = rng.integers(0, len(names), BATCH)
        x = np.stack([pool[c][rng.integers(len(pool[c]))] for c in which]).T
        tapes: tuple[list, list] = ([], [])
        p, f, b = net.logits(x, tapes)
        p = np.exp(p - p.max(axis=2, keepdims=True))
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(BATCH), which] -= 1
        p /= x.size
        flat = p.reshape(-1, len(names))
        grads = (backward(net.ahead, x, tapes[0], p @ net.top["f"].T),
                 backward(net.back, x[::-1], tapes[1], (p @ net.top["g"].T)[::-1]),
                 {"f": f.reshape(-1, hidden).T @ flat, "g": b.reshape(-1, hidden).T @ flat, "c": flat.sum(axis=0)})
        rate = RATE * min(1.0, 2 - 2 * step / (steps + 1))
        for layer, grad, moment in zip(layers, grads, moments, strict=True):
            for k, g in grad.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                layer[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def position_labels(net: Network, text: str) -> list[str]:
    """The most likely language at every byte of a text."""
    raw = text.encode("utf-8", "replace")
    if not raw or not net.languages:
        return [UNKNOWN] * len(raw)
    rows, first = cut(raw)
    best = net.probabilities(rows.T).argmax(axis=2).T
    flat = np.concatenate([b[a:] for b, a in zip(best, first, strict=True)])[:len(raw)]
    return [net.languages[k] for k in flat]


def pooled(net: Network, texts: list[str]) -> np.ndarray:
    """Mean of the positions' probabilities, one row per text; no text may be empty."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    out, size = np.zeros((len(raw), len(net.languages))), np.array([len(r) for r in raw])
    ready: list[tuple[int, np.ndarray, np.ndarray]] = []
    waiting = 0

    def flush() -> None:
        rows = np.concatenate([r for _, r, _ in ready])
        first = np.concatenate([f for _, _, f in ready])
        owner = np.concatenate([np.full(len(r), i) for i, r, _ in ready])
        last = np.minimum(WINDOW, size[owner])
        for a in range(0, len(rows), WINDOWS_AT_ONCE):
            z = a + WINDOWS_AT_ONCE
            p = net.probabilities(np.ascontiguousarray(rows[a:z].T))
            at = np.arange(WINDOW)[:, None]
            p *= ((at >= first[None, a:z]) & (at < last[None, a:z]))[:, :, None]
            np.add.at(out, owner[a:z], p.sum(axis=0))
        ready.clear()

    for i, r in enumerate(raw):
        rows, first = cut(r)
        ready.append((i, rows, first))
        waiting += len(rows)
        if waiting >= WINDOWS_AT_ONCE:
            flush()
            waiting = 0
    if ready:
        flush()
    return out / np.maximum(1, size)[:, None]


def predict(net: Network, texts: list[str]) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if any(c.isalpha() for c in t)]
    if known and net.languages:
        p = pooled(net, [texts[i] for i in known])
        best = p.argmax(axis=1)
        for i, k, row in zip(known, best, p, strict=True):
            names[i], scores[i] = net.languages[k], min(1.0, float(row[k]))
    return names, scores


def learning_rows(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> pd.DataFrame:
    """At most ``sample_rows`` rows (text, lang), the same on every run, in equal shares by language.

    Rows that repeat id and text count once.  Those whose hash falls below their language's
    rate (from an estimate of its different rows, with a margin) are told apart, and of each
    language the ones with the least hashes are taken: a fixed number, whatever repeats."""
    rows = documents.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") > 0))
    rows = rows.select("lang", "text", F.xxhash64(F.lit("lot"), "doc_id", "text").alias("lot"))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("lot", 0.02).alias("n")).collect()  # a row per language
    if not counts:
        return pd.DataFrame({"text": [], "lang": []})
    share = max(1, sample_rows // len(counts))
    rate = F.create_map(*[F.lit(x) for c in counts for x in (c["lang"], min(1.0, 1.5 * (share + 20) / max(1, c["n"])))])
    start = F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)) + 1
    window = F.col("text").substr(start.cast("int"), F.lit(SAMPLE_CHARS))
    picked = rows.where(F.pmod("lot", F.lit(1_000_003)) / 1_000_003 < F.element_at(rate, F.col("lang")))
    once = picked.groupBy("lang", "lot").agg(F.min(window).alias("text"))
    first = Window.partitionBy("lang").orderBy(F.pmod("lot", F.lit(1_000_003)), "lot")
    return (once.withColumn("place", F.row_number().over(first)).where(F.col("place") <= share).select("text", "lang")
            .orderBy("lang", F.xxhash64("text"), "text").toPandas())


def train(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Network:
    rows = learning_rows(documents.select("doc_id", "text", "lang"), sample_rows)
    if not len(rows):
        return Network([], {}, {}, {})
    return train_network(rows["text"].tolist(), rows["lang"].tolist())


def language_column(net: Network, text: Column) -> Column:
    """Struct of lang_pred and score for every text; no shuffle, one pass."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = predict(net, texts.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": scores})

    return run(F.coalesce(text, F.lit("")))


def identify(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``documents``: doc_id, lang_pred, score."""
    net = train(documents, sample_rows)
    return (documents.select("doc_id", language_column(net, F.col("text")).alias("found"))
            .select("doc_id", "found.*"))


def keep_known(documents: DataFrame, least: float = LEAST_SCORE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``documents`` in a known language with a score of ``least`` or more."""
    net = train(documents, sample_rows)
    found = language_column(net, F.col("text"))
    return documents.where(found["score"] >= least)
