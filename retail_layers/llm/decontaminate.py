"""Benchmark decontamination with a generalised suffix automaton of the test items.

All items are put, word by word, into one automaton that accepts every run of words of
every item. Documents are streamed through it: the state says how many of the last words
match some item. A word is hit when it lies in an occurrence of a window (``length``
consecutive words of an item, or a whole shorter item).

The automaton is built per shard of at most ``shard_words`` item words, sent to the
executors and passed over the documents one shard after the other inside the same tasks, so
nothing that grows without bound is broadcast and no document is shuffled.

Defined cases: a missing text has no words and is never hit; an item without words has no
window; items that share an id are one item; an item without id hits words but is not
listed; repeated documents give repeated rows; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
SHARD_WORDS = 200_000
RESULT = "n_words bigint, n_hit bigint, items array<string>, hits binary"


def _byte_map() -> bytes:
    """Upper case ASCII to lower case; all ASCII but digits and letters to a space."""
    out = bytearray(range(256))
    for b in range(128):
        ch = chr(b)
        out[b] = ord(ch.lower()) if ch.isalnum() else 32
    return bytes(out)


BYTE_MAP = _byte_map()


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII, lower-cased in A-Z."""
    return (text or "").encode("utf-8", "replace").translate(BYTE_MAP).split()


class SuffixAutomaton:
    """The generalised suffix automaton of a list of (id, words), with the windows it marks."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], length: int = WINDOW):
        self.length = length
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for name, ws in items if ws]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        # state -> [(window length, items)]: the windows that end wherever this state is reached
        self.windows: dict[int, dict[int, set[str]]] = {}
        for name, codes in coded:
            width = min(length, len(codes))
            for state, matched in self._walk(codes):
                if matched >= width:
                    while self.size[self.link[state]] >= width:
                        state = self.link[state]
                    held = self.windows.setdefault(state, {}).setdefault(width, set())
                    if name is not None:
                        held.add(name)
        self.least = min((w for by in self.windows.values() for w in by), default=0)

    @classmethod
    def restored(cls, state: dict) -> SuffixAutomaton:
        """An automaton from its attributes, which are plain lists and dictionaries."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def _extend(self, last: int, c: int) -> int:
        step, link, size = self.step, self.link, self.size
        known = step[last].get(c)
        if known is not None:
            return known if size[known] == size[last] + 1 else self._split(last, c, known)
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state q for its shorter strings, reached from p by c."""
        copy = len(self.step)
        self.step.append(dict(self.step[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        return copy

    def _walk(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """The state and the longest matching length after each code."""
        state = matched = 0
        step, link, size = self.step, self.link, self.size
        for c in codes:
            nxt = step[state].get(c)
            while nxt is None and state:
                state = link[state]
                matched = size[state]
                nxt = step[state].get(c)
            if nxt is None:
                matched = 0
            else:
                state = nxt
                matched += 1
            yield state, matched

    def scan(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches (start, end) of the words, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.windows or not ws:
            return spans, found
        get = self.vocabulary.get
        codes = [get(w, -1) for w in ws]
        known = np.array(codes) >= 0
        edges = np.flatnonzero(np.diff(np.r_[False, known, False].astype(np.int8)))
        windows, link = self.windows, self.link
        # a word of no item breaks every match, so only runs of known words are streamed
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo < self.least:
                continue
            for i, (state, matched) in enumerate(self._walk(codes[lo:hi]), lo + 1):
                while state > 0 and matched >= self.least:
                    for width, names in windows.get(state, {}).items():
                        if matched >= width:
                            spans.append((i - width, i))
                            found |= names
                    state = link[state]
        return spans, found


def shards(benchmark: DataFrame, shard_words: int = SHARD_WORDS,
           length: int = WINDOW) -> Iterator[SuffixAutomaton]:
    """Automata of the items, each of about ``shard_words`` words; one at a time in the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("_id"), F.col("text").alias("_text"))
    held: list[tuple[str | None, list[bytes]]] = []
    total = 0
    for row in items.where(F.col("_text").isNotNull()).toLocalIterator():
        ws = words(row["_text"])
        held.append((row["_id"], ws))
        total += len(ws)
        if total >= shard_words:
            yield SuffixAutomaton(held, length)
            held, total = [], 0
    if held:
        yield SuffixAutomaton(held, length)


def _mark(text: pd.Series, before: pd.DataFrame | None, automaton: SuffixAutomaton | None) -> pd.DataFrame:
    out = []
    for k, t in enumerate(text):
        ws = words(t)
        hit = np.zeros(len(ws), bool)
        found: set[str] = set()
        if before is not None:
            found |= set(before["items"].iat[k])
            if before["hits"].iat[k]:
                hit = np.unpackbits(np.frombuffer(before["hits"].iat[k], np.uint8), count=len(ws)).astype(bool)
        if automaton is not None:
            spans, more = automaton.scan(ws)
            found |= more
            for lo, hi in spans:
                hit[lo:hi] = True
        out.append((len(ws), int(hit.sum()), sorted(found), np.packbits(hit).tobytes() if hit.any() else b""))
    return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "hits"])


def mark(documents: DataFrame, benchmark: DataFrame, out: str, text: str = "text", length: int = WINDOW,
         shard_words: int = SHARD_WORDS) -> DataFrame:
    """``documents`` with a column ``out``: n_words, n_hit, items (sorted), hits (a bit per word)."""
    spark = documents.sparkSession
    done = None
    for automaton in shards(benchmark, shard_words, length):
        sent = spark.sparkContext.broadcast(vars(automaton))  # executors need no copy of the package to read it
        if done is None:
            done = documents.withColumn(out, _first(sent)(F.col(text)))
        else:
            done = done.withColumn(out, _next(sent)(F.col(text), F.col(out)))
    return documents.withColumn(out, _first(None)(F.col(text))) if done is None else done


def _first(sent):
    @F.pandas_udf(RESULT)
    def run(text: pd.Series) -> pd.DataFrame:
        return _mark(text, None, SuffixAutomaton.restored(sent.value) if sent else None)
    return run.asNondeterministic()


def _next(sent):
    @F.pandas_udf(RESULT)
    def run(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        return _mark(text, before, SuffixAutomaton.restored(sent.value))
    return run.asNondeterministic()


def remove_spans(text: str | None, hits: bytes) -> str | None:
    """The text without the hit words; what separates words stays."""
    if not text or not hits:
        return text
    raw = text.encode("utf-8", "replace")
    plain = np.frombuffer(raw.translate(BYTE_MAP), np.uint8) != 32
    starts = np.flatnonzero(plain & ~np.r_[False, plain[:-1]])
    ends = np.flatnonzero(plain & ~np.r_[plain[1:], False]) + 1
    hit = np.unpackbits(np.frombuffer(hits, np.uint8), count=len(starts)).astype(bool)
    keep = np.ones(len(raw), bool)
    for s, e in zip(starts[hit].tolist(), ends[hit].tolist()):
        keep[s:e] = False
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode("utf-8", "replace")


def decontaminate(documents: DataFrame, benchmark: DataFrame, max_share: float = 0.5, length: int = WINDOW,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents with hit spans cut out; documents hit on more than ``max_share`` of their words go.

    ``n_chars``, where the table has it, is counted anew for texts that were cut.
    """
    from retail_layers.llm.common import free_name

    out = free_name(documents, "_marked")
    marked = mark(documents, benchmark, out, length=length, shard_words=shard_words)

    @F.pandas_udf("string")
    def cut(text: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([remove_spans(t, h) for t, h in zip(text, hits)], dtype=object)

    kept = marked.where(F.col(f"{out}.n_hit") <= max_share * F.col(f"{out}.n_words"))
    was_hit = F.col(f"{out}.n_hit") > 0
    cut_text: Column = F.when(was_hit, cut(F.col("text"), F.col(f"{out}.hits"))).otherwise(F.col("text"))
    kept = kept.withColumn("text", cut_text)
    if "n_chars" in documents.columns:
        kept = kept.withColumn("n_chars", F.when(was_hit, F.length("text").cast(documents.schema["n_chars"].dataType))
                               .otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])


def digest(names: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
