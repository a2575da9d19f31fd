"""Language identification with error-correcting output codes.

Every language has a codeword; for each bit of the codewords a linear classifier over hashed
byte n-grams tells the languages with a 1 from those with a 0. A text's bits are weighed by
how well each classifier separated its training rows, and the language with the least
weighted loss wins. A text whose best two losses are close is flagged as ambiguous.

Defined cases: a text that is missing or has no letter is ``und`` with score 0; without
training rows every text is; with one language every other text is that one. Rows repeated
in the input give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.llm.common import fold

WIDTH = 4096
# The classifiers are fitted on at most this many rows of a language, and on this many in all.
ROWS_PER_LANGUAGE = 500
MAX_ROWS = 20_000
AMBIGUOUS = 0.2


def gram_counts(text: str) -> np.ndarray:
    """Square roots of the counts of hashed byte n-grams (1 to 4 bytes), scaled to length 1."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    out = np.zeros(WIDTH)
    code = np.zeros(len(raw), np.uint32)
    for n in range(1, 5):
        code = code[:len(raw) - n + 1] * np.uint32(257) + raw[n - 1:] + np.uint32(n)
        spread = (code * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(spread, minlength=WIDTH)
    out = np.sqrt(out)
    return (out / max(np.linalg.norm(out), 1e-9)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def codewords(n: int, seed: int = 6) -> np.ndarray:
    """Codewords of +1 and -1 for n languages: all splits of few languages, else far random ones."""
    if n <= 5:
        rows = [[1] * (1 << (n - 1)) if k == 0 else [1 if (c >> (n - 1 - k)) & 1 else -1 for c in range(1 << (n - 1))]
                for k in range(n)]
        table = np.array(rows)
        return table[:, np.abs(table.sum(0)) < n] if n > 1 else table
    rng = np.random.default_rng(seed)
    bits = int(10 * np.ceil(np.log2(n)))

    def distance(table: np.ndarray) -> int:
        apart = (bits - table @ table.T) // 2
        return int(apart[~np.eye(n, dtype=bool)].min())

    return max((rng.choice([-1, 1], (n, bits)) for _ in range(200)),
               key=lambda t: (distance(t), -np.abs(t.sum(0)).max()))


@dataclass
class Codes:
    names: list[str]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """The weighted logistic loss of each language's codeword."""
        margin = x @ self.weights + self.bias
        return sum(np.logaddexp(0, -margin[:, b:b + 1] * self.words[None, :, b]) * self.trust[b]
                   for b in range(self.words.shape[1]))

    def decode(self, x: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each row of n-gram counts."""
        loss = self.losses(x)
        share = np.exp(loss.min(1, keepdims=True) - loss)
        share /= share.sum(1, keepdims=True)
        best = loss.argmin(1)
        two = np.sort(share, axis=1)[:, ::-1]
        close = two[:, 0] - two[:, 1] < AMBIGUOUS if two.shape[1] > 1 else np.zeros(len(x), bool)
        return [self.names[b] for b in best], two[:, 0], close


def fit(x: np.ndarray, languages: list[str], rounds: int = 150, rate: float = 20.0, l2: float = 1e-4) -> Codes | None:
    """One logistic classifier per bit, all fitted together by accelerated gradient descent."""
    names = sorted(set(languages))
    if not names:
        return None
    at = np.searchsorted(names, languages)
    words = codewords(len(names))
    goal = words[at].astype(np.float32)
    size = np.bincount(at)
    row = (len(at) / (len(names) * size[at]))[:, None].astype(np.float32) / len(at)  # languages weigh alike
    w, b = np.zeros((x.shape[1], words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
    past_w, past_b = w, b
    for k in range(rounds):
        pace = np.float32(k / (k + 3))
        ahead_w, ahead_b = w + pace * (w - past_w), b + pace * (b - past_b)
        g = -goal * row / (1 + np.exp(goal * (x @ ahead_w + ahead_b)))
        past_w, past_b = w, b
        w, b = ahead_w - np.float32(rate) * (x.T @ g + np.float32(l2) * ahead_w), ahead_b - np.float32(rate / 10) * g.sum(0)
    right = ((x @ w + b > 0) == (goal > 0)).mean(0)
    trust = np.maximum(right - 0.5, 0.01) * 2
    return Codes(names, words, w, b, trust / trust.mean())


def train(documents: DataFrame, per_language: int = ROWS_PER_LANGUAGE, max_rows: int = MAX_ROWS) -> Codes | None:
    """Codes learned from documents with a language outside the held-out fold.

    The rows with the smallest hash of the id are taken, an equal number per language; an id
    counts once. Ids are chosen first, so only their texts are turned into n-grams.
    """
    usable = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id") != 2))
    ids = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.min("lang").alias("_lang"))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    chosen = (
        ids.withColumn("_place", place).where(F.col("_place") <= per_language)
        .orderBy("_place", "_lang").limit(max_rows).select("_id", "_lang")
    )

    @F.pandas_udf("binary")
    def counts(text: pd.Series) -> pd.Series:
        return pd.Series([gram_counts(t).astype(np.float16).tobytes() for t in text], dtype=object)

    rows = (
        usable.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_l"))
        .join(F.broadcast(chosen), "_id").where(F.col("_l") == F.col("_lang"))
        .groupBy("_id", "_lang").agg(F.min("_text").alias("_text"))
        .select("_id", "_lang", counts("_text").alias("_x")).toPandas().sort_values("_id")
    )
    x = np.array([np.frombuffer(v, np.float16) for v in rows["_x"]], np.float32).reshape(len(rows), WIDTH)
    return fit(x, rows["_lang"].tolist())


def identify(text: Column, codes: Codes | None) -> Column:
    """A struct per text: lang_pred, score, ambiguous."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores, close = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            known = [k for k, t in enumerate(texts) if has_letter(t)] if codes else []
            for at in range(0, len(known), 512):
                part = known[at:at + 512]
                found = codes.decode(np.stack([gram_counts(texts.iat[k]) for k in part]))
                for k, name in zip(part, found[0]):
                    names[k] = name
                scores[part], close[part] = found[1], found[2]
            yield pd.DataFrame({"lang_pred": names, "score": scores, "ambiguous": close})

    return predicted.asNondeterministic()(text)
