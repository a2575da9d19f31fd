"""Substring dedup by De Bruijn compaction of token sequences.

Every window of ``WINDOW`` consecutive words is an edge between two nodes, the ``WINDOW - 1``
words it begins and ends with. Beginnings and ends of texts count as edges of their own, so all
edges of a nonbranching path occur equally often, and wherever one of them occurs the whole path
does. Paths that occur at least twice are the repeated passages.

How the graph is dealt: a node is represented by its anchor, the ``GRAM``-word run in it with the
least hash. Consecutive nodes of a text with one anchor, with the edges before and behind them,
are a context; equal nodes lie in contexts of equal anchors, so what branches is seen within one
anchor. Contexts travel as hashes with a coordinate (text, first word). An anchor that occurs once
holds no repeated edge and goes. An anchor with a single context has no branch, and consecutive
contexts of that kind compact inside the text that stands for them. Contexts of other anchors are
spelled out node by node, and cut at every node with two ways in or out. The pieces that are left
share their first and last edges with one another; joins on these link them, and pointers that
double their reach in each round give every piece its passage and its place there.

Occurrences of the pieces are then put together again: those of one text that agree on passage and
shift have to cover the passage from its first to its last edge. Only spans that these coordinates
confirm are removed.

Scale: anchors (about one in ten words) are shuffled, not words. Counts, copies and coordinates
are combined on the map side; no group is collected, except the spans of one text; joins carry
plain rows, which Spark may split where a key is hot. Texts meet their marks by hash, so copies of
a text are decided once.

Defined cases: a missing text has no words; ids play no part, so repeated rows and rows without
id are texts like any others; a text shorter than a window stays whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.llm.common import sliced
from retail_layers.scratch import keep

WINDOW = 35
NODE = WINDOW - 1
GRAM = 16
PIECE = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_2 = np.uint64(0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

CONTEXTS = "anchor bigint, context bigint, tag bigint, twin bigint, first int, nodes int"
# f, t, o: the run's first edge and whether it comes from another context; at, own: edges of the run before
# this context and in it; the rest only with the run's first context: edges, last edge, whether that leads on
FETCHED = ("anchor bigint, context bigint, several boolean, n_rows bigint, chain array<bigint>, own_from int, own_to int, f bigint, t bigint, "
           "o boolean, at int, own int, edges int, lf bigint, lt bigint, r boolean")
EDGE = ("f", "t", "o")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD_2
    return h ^ (h >> np.uint64(29))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and a hash of each: a sum of bytes times random numbers of their places."""
    space = SPACE[raw]
    begin = np.flatnonzero(~space & np.r_[True, space[:-1]])
    if not len(begin):
        return begin, np.zeros(0, np.uint64)
    place = np.arange(len(raw))
    last = np.zeros(len(raw), np.int64)
    last[begin] = begin
    place = (place - np.maximum.accumulate(last)).astype(np.uint64)
    value = (raw.astype(np.uint64) + np.uint64(1)) * _mixed((place + np.uint64(1)) * ODD)
    value[space] = 0
    return begin, _mixed(np.add.reduceat(value, begin) + ODD)


def grams(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` values from each place on, by doubling."""
    out, size = h, 1
    while size * 2 <= width:
        out = _mixed(out[:-size] * ODD + out[size:])
        size *= 2
    rest = width - size
    return _mixed(out[:-rest] * ODD_2 + out[rest:]) if rest else out


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first least of the ``width`` values from each place on lies."""
    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] < values[a], b, a)

    out, size = np.arange(len(values)), 1
    while size * 2 <= width:
        out = better(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return better(out[:-rest], out[rest:]) if rest else out


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of whole texts; batches have tag, twin, text."""
    def rows(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch | None:
        raw = np.frombuffer(b" ".join(r for _, _, r in held), np.uint8)
        ends = np.cumsum([len(r) + 1 for _, _, r in held])
        begin, h = word_hashes(raw)
        if len(h) < WINDOW:
            return None
        owner = np.searchsorted(ends, begin, side="right")
        words = np.bincount(owner, minlength=len(held))
        start = np.cumsum(words) - words
        node, gram = grams(h, NODE), grams(h, GRAM)
        anchor = leftmost_least(gram, NODE - GRAM + 1)
        valid = (owner[:len(node)] == owner[NODE - 1:]) & (words[owner[:len(node)]] >= WINDOW)
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])]
        lo = np.flatnonzero(new)
        hi = np.r_[lo[1:], len(node)] - 1
        lo, hi = lo[valid[lo]], hi[valid[lo]]
        if not len(lo):
            return None
        doc = owner[lo]
        first = lo - start[doc]
        before, behind = first > 0, hi - start[doc] + WINDOW <= words[doc]
        left, right = lo - before, hi + behind
        shape = ((right - left) * 4 + before * 2 + behind).astype(np.uint64)
        context = _mixed(_mixed(node[left] * ODD + node[right]) * ODD + shape)
        tag, twin = (np.array([x[k] for x in held], np.int64)[doc] for k in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (gram[anchor[lo]].view(np.int64), context.view(np.int64), tag, twin,
                                   first.astype(np.int32), (hi - lo + 1).astype(np.int32))],
            ["anchor", "context", "tag", "twin", "first", "nodes"])

    for batch in batches:
        held, size = [], 0
        for part in sliced([batch]):
            for tag, twin, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                raw = text.encode("utf-8", "replace")
                held.append((tag, twin, raw))
                size += len(raw)
                if size >= PIECE:
                    if out := rows(held):
                        yield out
                    held, size = [], 0
        if held and (out := rows(held)):
            yield out


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node hashes of the contexts a text stands for; batches have tag, twin, text, wanted."""
    names = [part.strip().split()[0] for part in FETCHED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(),
             pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def of(text: str, wanted: list[dict]) -> list[list]:
        _, h = word_hashes(np.frombuffer(text.encode("utf-8", "replace"), np.uint8))
        node = grams(h, NODE).view(np.int64)
        out, run, begin, follows = [], None, 0, None
        for w in sorted(wanted, key=lambda w: w["first"]):
            first, last = w["first"], w["first"] + w["nodes"] - 1
            left, right = first - (first > 0), last + (last + WINDOW <= len(h))
            if w["several"]:
                chain = node[left:right + 1].tolist()
                out.append([w["anchor"], w["context"], True, w["n_rows"], chain, first - left, last - left, None, None, first > left,
                            None, None, None, None, None, right > last])
                run = None
                continue
            if run is None or follows != first:
                run, begin = [w["anchor"], w["context"], False, w["n_rows"], None, None, None, int(node[left]), int(node[left + 1]),
                              first > left, 0, right - left, None, None, None, None], left
                out.append(run)
            else:
                out.append([w["anchor"], w["context"], False, w["n_rows"], None, None, None, *run[7:10],
                            left - begin, right - left, None, None, None, None])
            run[12:] = right - begin, int(node[right - 1]), int(node[right]), right > last
            follows = last + 1
        return out

    before = None
    for batch in batches:
        for part in sliced([batch], 64):
            out = []
            for tag, twin, text, wanted in zip(*(part.column(k).to_pylist() for k in range(4))):
                if (tag, twin) != before:  # copies of a text mostly arrive in a row
                    out += of(text, wanted)
                before = (tag, twin)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def keyed(documents: DataFrame, text: str) -> DataFrame:
    """tag and twin, two hashes that name a text, and the text."""
    t = F.col(text).cast("string")
    return documents.select(F.xxhash64(t).alias("tag"), F.xxhash64(F.lit(1), t).alias("twin"), t.alias("text"))


def _pieces(fetched: DataFrame) -> DataFrame:
    """Pieces of the contexts whose anchor has several: cut at every node with two ways in or out."""
    chains = fetched.where("several")
    at = F.col("j")
    nodes = (
        chains.select("anchor", "context", "chain", "own_from", "own_to", F.posexplode("chain").alias("j", "node"))
        .where(at.between(F.col("own_from"), F.col("own_to")))
        .select("anchor", "context", "j", "node", F.coalesce(F.get("chain", at - 1), F.lit(0)).alias("before"),
                F.coalesce(F.get("chain", at + 1), F.lit(0)).alias("behind")))
    branching = (
        nodes.groupBy("anchor", "node").agg(*[f(c).alias(f"{n}_{c}") for c in ("before", "behind") for n, f in (("lo", F.min), ("hi", F.max))])
        .where("lo_before <> hi_before or lo_behind <> hi_behind").select("anchor", "node"))
    cuts = nodes.join(branching, ["anchor", "node"]).groupBy("anchor", "context").agg(F.collect_set("j").alias("cuts"))
    last = F.size("chain") - 1
    bounds = F.array_sort(F.array_distinct(F.concat(
        F.array(F.lit(0), last), F.filter(F.coalesce("cuts", F.array().cast("array<int>")), lambda j: (j > 0) & (j < last)))))
    cut = chains.join(cuts, ["anchor", "context"], "left").withColumn("bounds", bounds)

    def piece(k: Column) -> Column:
        lo, hi = F.get("bounds", k), F.get("bounds", k + 1)
        return F.struct(lo.alias("at"), (hi - lo).alias("edges"), F.get("chain", lo).alias("f"), F.get("chain", lo + 1).alias("t"),
                        ((lo == 0) & F.col("o")).alias("o"), F.get("chain", hi - 1).alias("lf"), F.get("chain", hi).alias("lt"),
                        ((hi == last) & F.col("r")).alias("r"))

    return cut.select("anchor", "context", "n_rows", F.inline(F.transform(F.sequence(F.lit(0), F.size("bounds") - 2), piece)))


def _ranked(pieces: DataFrame) -> DataFrame:
    """f, t, o, edges of each piece with its passage (pf, pt, po), its offset there and the passage's length in edges."""
    before = pieces.where("r").select(F.col("lf").alias("f"), F.col("lt").alias("t"), F.struct(*EDGE).alias("ptr"), (F.col("edges") - 1).cast("bigint").alias("d"))
    linked = keep(
        pieces.select(F.struct(*EDGE).alias("key"), "f", "t", F.col("o").alias("open")).join(before, ["f", "t"], "left")
        .select("key", F.when(F.col("open"), F.col("ptr")).alias("ptr"), F.when(F.col("open") & F.col("ptr").isNotNull(), F.col("d")).otherwise(0).alias("d")))
    done = linked.where("ptr is null").select("key", F.col("key").alias("head"), "d")
    waiting = linked.where("ptr is not null")
    while not waiting.isEmpty():
        reach = done.select(F.col("key").alias("ptr"), "head", F.lit(None).cast(done.schema["key"].dataType).alias("next"), F.col("d").alias("more")).unionByName(
            waiting.select(F.col("key").alias("ptr"), F.lit(None).cast(done.schema["key"].dataType).alias("head"), F.col("ptr").alias("next"), F.col("d").alias("more")))
        moved = keep(waiting.join(reach, "ptr").select("key", "head", F.col("next").alias("ptr"), (F.col("d") + F.col("more")).alias("d")))
        done = done.unionByName(moved.where("head is not null").select("key", "head", "d"))
        waiting = moved.where("head is null").select("key", "ptr", "d")
    placed = keep(done.join(pieces.select(F.struct(*EDGE).alias("key"), "edges"), "key"))
    length = placed.groupBy("head").agg(F.max(F.col("d") + F.col("edges")).alias("length"))
    return placed.join(length, "head").select("key.*", "head", "d", "length")


def spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """tag, twin, start, stop, passage: the stretches of words of each text to remove, one row per
    occurrence of a repeated passage; passage is a hash that names it."""
    texts = keyed(documents, text).where(F.length("text") >= 2 * WINDOW - 1)
    rows = keep(texts.mapInArrow(_contexts, CONTEXTS))
    shared = keep(  # written, because Spark splits a hot anchor only where both sides of the join come from shuffles
        rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.min("context").alias("_lo"), F.max("context").alias("_hi"))
        .where("_n > 1").select("anchor", F.expr("_lo <> _hi").alias("several")))
    held = keep(rows.join(shared, "anchor"))
    stands = held.groupBy("anchor", "context", "several").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("tag", "twin", "first", "nodes")).alias("at"))
    wanted = stands.groupBy("at.tag", "at.twin").agg(
        F.collect_list(F.struct("anchor", "context", "several", "n_rows", "at.first", "at.nodes")).alias("wanted"))
    fetched = keep(texts.join(wanted, ["tag", "twin"]).select("tag", "twin", "text", "wanted").mapInArrow(_fetched, FETCHED)
                   .dropDuplicates(["anchor", "context"]))
    pieces = keep(_pieces(fetched))
    runs = fetched.where("edges is not null").select(*EDGE, "edges", "lf", "lt", "r", "n_rows")
    distinct = keep(
        pieces.select(*EDGE, "edges", "lf", "lt", "r", "n_rows").unionByName(runs).groupBy(*EDGE, "edges", "lf", "lt", "r")
        .agg(F.sum("n_rows").alias("n_rows")).where("n_rows > 1"))
    ranked = keep(_ranked(distinct))
    parts = (
        pieces.select("anchor", "context", "at", F.lit(0).alias("skip"), F.col("edges").alias("own"), *EDGE)
        .unionByName(fetched.where("not several").select("anchor", "context", F.lit(0).alias("at"), F.col("at").alias("skip"), "own", *EDGE)))
    marks = parts.join(ranked, list(EDGE)).select(
        "anchor", "context", "at", "own", (F.col("d") + F.col("skip")).alias("offset"), "length",
        F.xxhash64("head.f", "head.t", "head.o").alias("passage"))
    begin = F.col("first") - (F.col("first") > 0).cast("int") + F.col("at")
    found = held.join(marks, ["anchor", "context"]).groupBy("tag", "twin", "passage", (begin - F.col("offset")).alias("start")).agg(
        F.min("offset").alias("lo"), F.max(F.col("offset") + F.col("own")).alias("hi"), F.max("length").alias("length"))
    return found.where("lo = 0 and hi = length").select("tag", "twin", "start", (F.col("start") + F.col("length") + NODE).alias("stop"), "passage")


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (start, stop, passage: stretches of words, in order, which
    may overlap) and kept (the remaining words, joined by one space)."""
    lists = spans(documents, text).groupBy("tag", "twin").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "passage"))).alias("spans"))
    names = F.xxhash64(F.col(text).cast("string")), F.xxhash64(F.lit(1), F.col(text).cast("string"))
    texts = documents.select(F.col(doc_id).alias("doc_id"), names[0].alias("tag"), names[1].alias("twin"), F.col(text).cast("string").alias("text"))
    return texts.join(lists, ["tag", "twin"], "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, f"doc_id {documents.schema[doc_id].dataType.simpleString()}, n_words bigint, n_removed bigint, "
              "spans array<struct<start: bigint, stop: bigint, passage: bigint>>, kept string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced([batch]):
            sizes, removed, kept = [], [], []
            for text, stretches in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                words = (text or "").encode("utf-8", "replace").split()
                rest, done = [], 0
                for s in stretches or ():
                    rest += words[done:s["start"]]
                    done = max(done, s["stop"])
                rest += words[done:]
                sizes.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), part.column(2), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "spans", "kept"])
