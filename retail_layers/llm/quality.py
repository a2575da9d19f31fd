"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; boosted shallow trees, one feature after the
other and round after round, add up to one lookup table per feature, then to one table per
chosen pair of features. A text is scored by adding the looked-up values.

Defined cases: a missing text counts as empty and is scored like any other; rows repeated
in the input give repeated rows; without training rows, or with one class only, every score
is the smoothed share of label 1 (0.5 without rows). Extra columns never enter a score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.llm.common import fold, sliced

FEATURES = (
    "log_words", "word_length", "letters", "upper", "digits", "symbols", "marks", "distinct_words",
    "top_word", "repeated_neighbours", "repeated_lines", "line_words", "short_words", "odd_endings",
    "distinct_sentences",
)
# The model is fitted on at most this many labelled rows (those with the smallest hash of the id).
MAX_TRAINING_ROWS = 40_000
# A text is accepted from this score on.
ACCEPT = 0.7


def _classes() -> np.ndarray:
    """For each byte value: letter, upper case, digit, symbol, rare mark."""
    out = np.zeros((256, 5))
    for b in range(256):
        ch = chr(b)
        out[b, 0] = b >= 0xC0 or (b < 128 and ch.isalpha())
        out[b, 1] = b < 128 and ch.isupper()
        out[b, 2] = b < 128 and ch.isdigit()
        out[b, 3] = 32 < b < 127 and not ch.isalnum()
        out[b, 4] = 32 < b < 127 and not ch.isalnum() and ch not in ".,;:'\"-()?"
    return out


CLASSES = _classes()


def text_features(text: str | None) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    letters, upper, digits, symbols, marks = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ CLASSES
    size = max(letters + digits + symbols, 1.0)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    sentences = [x for x in text.replace("\n", " ").split(". ") if x]
    solid = len(raw) - raw.count(b" ") - raw.count(b"\n")
    return [
        float(np.log1p(n)), solid / n, letters / size, upper / max(letters, 1.0), digits / size, symbols / size,
        marks / size, len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, 1 - len(set(lines)) / max(len(lines), 1),
        float(np.log1p(n / max(len(lines), 1))), sum(k for w, k in counts.items() if len(w) <= 3) / n,
        sum(k for w, k in counts.items() if not w[-1].isalnum()) / n, len(set(sentences)) / max(len(sentences), 1),
    ]


@dataclass
class AdditiveModel:
    """Cut points per feature, a table per feature, and a table per pair of features."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores in 0 to 1 for rows of features, by bin additions alone."""
        if not len(x):
            return np.zeros(0)
        at = self.bins(x)
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[at[:, j]]
        for a, b, table in self.pairs:
            total += table[at[:, a], at[:, b]]
        return 1 / (1 + np.exp(-total))


def _tree_1d(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """The values per bin of a tree with up to three leaves on summed gradients."""
    gain = lambda a, b: a * a / (b + l2)

    def cut(lo: int, hi: int) -> tuple[float, int]:
        cg, ch = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        if not len(cg):
            return 0.0, lo
        tg, th = g[lo:hi].sum(), h[lo:hi].sum()
        won = gain(cg, ch) + gain(tg - cg, th - ch) - gain(tg, th)
        return float(won.max()), lo + int(won.argmax()) + 1

    n = len(g)
    won, first = cut(0, n)
    if won <= 0:
        return np.zeros(n)
    second = max(cut(0, first), cut(first, n))
    edges = sorted({0, first, n} | ({second[1]} if second[0] > 0 else set()))
    out = np.zeros(n)
    for lo, hi in zip(edges, edges[1:]):
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + l2)
    return out


def _tree_2d(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """The best cut of both axes at once into four leaves: its gain and its values."""
    sg, sh = (np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h))

    def quarters(s: np.ndarray) -> list[np.ndarray]:
        a, top, left, all_ = s[1:-1, 1:-1], s[1:-1, -1:], s[-1:, 1:-1], s[-1, -1]
        return [a, top - a, left - a, all_ - top - left + a]

    won = sum(x * x / (y + l2) for x, y in zip(quarters(sg), quarters(sh)))
    if not won.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + l2)
    return float(won.max()), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pair_rounds: int = 30,
        n_pairs: int = 8, rate: float = 0.1, l2: float = 5.0) -> AdditiveModel:
    """Cyclic boosting: all features in turn, then the pairs that explain most of what is left."""
    width = len(FEATURES)
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return AdditiveModel(base, [np.zeros(0)] * width, [np.zeros(1)] * width, [])
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    model = AdditiveModel(base, cuts, [np.zeros(len(c) + 1) for c in cuts], [])
    at, total = model.bins(x), np.full(len(y), base)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = gradients()
            step = rate * _tree_1d(*(np.bincount(at[:, j], v, len(table)) for v in (g, h)), l2)
            table += step
            total += step[at[:, j]]

    def grid(a: int, b: int) -> list[np.ndarray]:
        shape = len(model.tables[a]), len(model.tables[b])
        cell = at[:, a] * shape[1] + at[:, b]
        return [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in gradients()]

    ranked = sorted(((_tree_2d(*grid(a, b), l2)[0], a, b) for a in range(width) for b in range(a)), reverse=True)
    model.pairs = [(a, b, np.zeros((len(model.tables[a]), len(model.tables[b])))) for _, a, b in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, table in model.pairs:
            step = rate * _tree_2d(*grid(a, b), l2)[1]
            table += step
            total += step[at[:, a], at[:, b]]
    return model


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> pd.DataFrame:
    """Features and label of at most ``max_rows`` labelled documents outside the held-out fold.

    The ids are chosen first, so the join sends a bounded list to the executors and only
    the chosen texts are turned into features. An id with several labels counts as its
    smallest, an id with several texts as the least row of features.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & (fold("_id") != 2))
        .groupBy("_id").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )

    @F.pandas_udf("array<double>")
    def features(text: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in text])

    rows = (
        documents.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .select("_id", "_label", features("_text").alias("_x"))
        .groupBy("_id", "_label").agg(F.min("_x").alias("_x"))
    )
    return rows.toPandas().sort_values("_id")


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    rows = training_rows(documents, labels, max_rows)
    x = np.array(rows["_x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, (rows["_label"].to_numpy(float) >= 1).astype(float))


def score(text: Column, model: AdditiveModel) -> Column:
    """The score of each whole text as a column; the model travels with the function."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for part in sliced([pa.RecordBatch.from_arrays([texts], ["text"])]):
            x = [text_features(t) for t in part.column(0).to_pylist()]
            out.append(model.score(np.array(x, float).reshape(len(x), len(FEATURES))))
        return pa.array(np.concatenate(out))

    return scored.asNondeterministic()(text)
