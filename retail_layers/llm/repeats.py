"""Suffix-array dedup of byte strings with a run-length compressed index.

Every byte that lies in a ``LENGTH``-byte string which also starts earlier (smaller id, or
same document and earlier start) is marked, judged on the input.

How the work is dealt: each ``LENGTH``-byte window is represented by its anchor, the
``GRAM``-byte string in it with the least hash, so equal windows have equal anchors at equal
places. The windows of one anchor form a context of at most ``LENGTH + GRAM_CHOICES - 1``
bytes. Rows of anchors (no text) are dealt by anchor and streamed in sorted order: a context
equal to an earlier one is marked whole. Where an anchor has several different contexts, the
first of each is fetched, and a bucket of such contexts gets a run-length index: its suffix
array gives the Burrows-Wheeler transform, of which only the run borders are kept as samples
(position, preceding suffix, length in common). Streaming the positions over the samples
yields each position's preceding suffix and matching length; windows linked by at least
``LENGTH`` common bytes are one string, all but the earliest of which are marked.

Scale: text is never dealt except to its own document's marks; a bucket holds a bounded
number of contexts, and an anchor with more than ``MAX_CONTEXTS`` of them is resolved by
aggregating window hashes instead, so no group has to fit into one task.

Defined cases: a missing text counts as empty; a missing id counts as the smallest one; rows
that share an id and a text are the same document and do not mark each other; rows that
share an id only are compared by their starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.llm.common import release
from retail_layers.scratch import keep

LENGTH = 100
GRAM = 32
GRAM_CHOICES = LENGTH - GRAM + 1
MAX_CONTEXTS = 20_000
BUCKET_CONTEXTS = 15_000
PIECE = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_2 = np.uint64(0xD6E8FEB86659FD93)
ANCHORS = "anchor bigint, context bigint, doc bigint, place bigint, tag bigint"
# place: start of the context's first window, number of windows; tag: hash of the text
COUNT_BITS = 7


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD_2
    return h ^ (h >> np.uint64(29))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on, by doubling."""
    h = mixed((raw.astype(np.uint64) + np.uint64(1)) * ODD)
    size = 1
    while size < GRAM:
        h = mixed(h[:-size] * ODD + h[size:])
        size *= 2
    return h


def sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) of each ``width`` neighbours."""
    out, size = values, 1
    while size * 2 <= width:
        out = least(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return least(out[:-rest], out[rest:]) if rest else out


def contexts(raw: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """anchor hash, context hash, first window, number of windows, for windows ``inside`` one text."""
    h = gram_hashes(raw)
    least = sliding(h, GRAM_CHOICES, np.minimum)
    valid = inside[:len(least)]
    new = np.r_[True, (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(least)] - 1  # the last window of the run
    begin, end = begin[valid[begin]], end[valid[begin]]
    # positions that are the least of some window; the first of them from a window on is its anchor
    padded = np.r_[np.zeros(GRAM_CHOICES - 1, np.uint64), least, np.zeros(GRAM_CHOICES - 1, np.uint64)]
    chosen = np.flatnonzero(h == sliding(padded, GRAM_CHOICES, np.maximum))
    firsts, counts = [], []
    while len(begin):
        at = np.searchsorted(chosen, begin)
        other = h[chosen[at]] != least[begin]
        while other.any():
            at[other] += 1
            other[other] = h[chosen[at[other]]] != least[begin[other]]
        anchor = chosen[at]
        stop = np.minimum(anchor, end)
        firsts.append(np.stack([begin, anchor]))
        counts.append(stop - begin + 1)
        more = anchor < end  # the same bytes again further on: they anchor the windows behind
        begin, end = anchor[more] + 1, end[more]
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    (first, anchor), count = np.concatenate(firsts, 1), np.concatenate(counts)
    size = count + LENGTH - 1
    whole = (anchor - first).astype(np.uint64) * ODD + count.astype(np.uint64)
    for at in range(0, GRAM_CHOICES + LENGTH - 1, GRAM):
        whole = mixed(whole * ODD + h[first + np.minimum(at, size - GRAM)])
    return h[anchor].view(np.int64), whole.view(np.int64), first, count


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchor rows of whole texts; batches have doc, tag, text."""

    def rows(docs: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        sizes = np.array([len(r) for _, _, r in docs])
        start = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"".join(r for _, _, r in docs), np.uint8)
        owner = np.repeat(np.arange(len(docs)), sizes)
        left = np.repeat(start + sizes, sizes) - np.arange(len(raw))
        anchor, context, first, count = contexts(raw, left >= LENGTH)
        doc = owner[first]
        tag = np.array([t for _, t, _ in docs])[doc]
        place = ((first - start[doc]) << COUNT_BITS) | count
        return pa.RecordBatch.from_arrays(
            [pa.array(anchor), pa.array(context), pa.array(np.array([d for d, _, _ in docs])[doc]), pa.array(place), pa.array(tag)],
            ["anchor", "context", "doc", "place", "tag"])

    for batch in batches:
        held, size = [], 0
        for doc, tag, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            raw = text.encode("utf-8", "replace")
            if len(raw) >= LENGTH:
                held.append((doc, tag, raw))
                size += len(raw)
            if size >= PIECE:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream rows sorted by anchor, context, doc, place, tag; only the last row's state is carried.

    Out: doc, place, tag, anchor. Without anchor the context is marked whole; with it the windows
    have to be asked for, because the anchor has other contexts too. Another text of the same id
    and start is always asked for, so that only the first row has to wait.
    """
    last = None  # the row before: anchor, context, doc, start and tag of that context's first row
    several = False  # whether that anchor has shown a second context
    waiting = None  # the first row (doc, place, tag) of that anchor, as long as it has not
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, context, doc, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        n, start = len(anchor), place >> COUNT_BITS
        tag = batch.column(4).to_numpy(zero_copy_only=False) if batch.num_columns > 4 else np.zeros(n, np.int64)
        new_anchor = np.r_[last is None or anchor[0] != last[0], anchor[1:] != anchor[:-1]]
        new_context = new_anchor | np.r_[last is None or context[0] != last[1], context[1:] != context[:-1]]
        head = np.maximum.accumulate(np.where(new_context, np.arange(n), -1))
        first_doc, first_start, first_tag = (x[np.maximum(head, 0)] for x in (doc, start, tag))
        if last is not None:
            first_doc[head < 0], first_start[head < 0], first_tag[head < 0] = last[2:]
        copy = (doc != first_doc) | (start != first_start)
        group = np.cumsum(new_anchor)  # 0 goes on from the batch before
        many = np.zeros(group[-1] + 1, bool)
        many[group[new_context & ~new_anchor]] = True
        late = bool(many[0] and waiting is not None)  # the waiting row is needed after all
        many[0] |= several
        ask = ~copy & (many[group] | (tag != first_tag))
        d, p, t, a, q = doc, place, tag, anchor, ask
        if late:
            d, p, t = (np.r_[x, w] for x, w in zip((d, p, t), waiting))
            a, q = np.r_[a, last[0]], np.r_[q, True]
        send = q | np.r_[copy, np.zeros(len(d) - n, bool)]
        if late or group[-1]:
            waiting = None
        several = bool(many[-1])
        if group[-1] and not several:
            begin = np.flatnonzero(new_anchor)[-1]
            waiting = doc[begin], place[begin], tag[begin]
        last = anchor[-1], context[-1], first_doc[-1], first_start[-1], first_tag[-1]
        if send.any():
            yield pa.RecordBatch.from_arrays([pa.array(d[send]), pa.array(p[send]), pa.array(t[send]), pa.array(a[send], mask=~q[send])],
                                             ["doc", "place", "tag", "anchor"])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of values 0 to 256 by prefix doubling."""
    n = len(text)
    padded = np.r_[text, np.zeros(6, text.dtype)].astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(6):
        key = (key << np.uint64(9)) | padded[k:n + k]
    size = 6
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.r_[False, ordered[1:] != ordered[:-1]]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new) + 1
        if new.sum() == n - 1 or size >= n:
            return order
        key = rank << np.uint64(32)
        key[:-size] |= rank[size:]
        size *= 2


class RunIndex:
    """The run borders of a text's Burrows-Wheeler transform, with a sample at each.

    At a border the suffix's position, its predecessor in suffix order and the length they
    share are kept; between borders both go on by one for every step of the position.
    """

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        before = np.where(order > 0, text[order - 1].astype(np.int64), -1)
        border = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        position, previous = order[border], order[np.maximum(border - 1, 0)]
        shared = self._shared(text, position, previous)
        shared[border == 0] = 0
        by = np.argsort(position)
        self.position, self.previous, self.shared = position[by], previous[by], shared[by]
        self.size, self.runs = len(text), len(border)

    @staticmethod
    def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths two suffixes have in common, as far as a window needs them with all its shifts."""
        most = 4 * LENGTH
        padded = np.r_[text, np.zeros(most + 1, text.dtype)]
        out = np.zeros(len(a), np.int64)
        left = np.arange(len(a))
        for k in range(most):
            left = left[padded[a[left] + k] == padded[b[left] + k]]
            if not len(left):
                break
            out[left] += 1
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position the preceding suffix and the matching length, streamed from the samples."""
        at = np.searchsorted(self.position, np.arange(self.size), side="right") - 1
        step = np.arange(self.size) - self.position[at]
        return self.previous[at] + step, np.maximum(self.shared[at] - step, 0)


def repeated_windows(parts: list[bytes], docs: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For contexts sorted by doc and start: which windows of each also start earlier."""
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(sizes.sum() + len(parts), np.uint16)
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    owner = np.repeat(np.arange(len(parts)), sizes)
    offset = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[begin[owner] + offset] = raw
    previous, shared = RunIndex(text).statistics()
    window = np.flatnonzero(offset + LENGTH <= sizes[owner])
    at = begin[owner[window]] + offset[window]
    head = np.arange(len(text))
    linked = at[shared[at] >= LENGTH]
    head[linked] = previous[linked]
    while True:
        further = head[head[at]]
        if np.array_equal(further, head[at]):
            break
        head[at] = further
    doc, start = docs[owner[window]], starts[owner[window]] + offset[window]
    by_start = np.lexsort((start, doc))  # contexts of texts that share an id may overlap
    rank = np.empty(len(at), np.int64)
    rank[by_start] = np.arange(len(at))
    first = np.full(len(text), len(at))
    np.minimum.at(first, head[at], rank)
    earliest = by_start[first[head[at]]]
    marked = (doc != doc[earliest]) | (start != start[earliest])
    return np.split(marked, np.cumsum(sizes - LENGTH + 1)[:-1])


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(first, one past the last) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _resolve(held: pd.DataFrame) -> pd.DataFrame:
    held = held.sort_values(["doc", "start"], kind="stable")
    docs, starts = held["doc"].to_numpy(), held["start"].to_numpy()
    out = []
    for marked, doc, tag, start in zip(repeated_windows(list(held["bytes"]), docs, starts), docs, held["tag"], starts):
        out += [(doc, tag, start + lo, start + hi + LENGTH - 1) for lo, hi in _runs(marked)]
    return pd.DataFrame(out, columns=["doc", "tag", "start", "stop"])


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a context: two independent hashes, doc, tag, start."""
    for batch in batches:
        for doc, tag, start, raw in zip(*(batch.column(k).to_pylist() for k in range(4))):
            h = gram_hashes(np.frombuffer(raw, np.uint8))
            n = len(raw) - LENGTH + 1
            one = two = np.zeros(n, np.uint64)
            for at in (0, GRAM, 2 * GRAM, LENGTH - GRAM):
                one, two = mixed(one * ODD + h[at:at + n]), mixed(two * ODD_2 + h[at:at + n])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(np.full(n, doc)),
                 pa.array(np.full(n, tag)), pa.array(start + np.arange(n))], ["one", "two", "doc", "tag", "start"])


SPANS = "doc bigint, tag bigint, start bigint, stop bigint"


def spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
          max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """doc, tag, start, stop: byte stretches to remove, overlapping ones included; kept."""
    spark = documents.sparkSession
    texts = keyed(documents, doc_id, text).select("_doc", "_tag", F.col(text).alias("_text"))
    rows = (
        texts.where(F.octet_length("_text") >= LENGTH).mapInArrow(_anchors, ANCHORS)
        .repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "place", "tag")
        .mapInArrow(_settle, "doc bigint, place bigint, tag bigint, anchor bigint")
    )
    start = F.shiftright("place", COUNT_BITS)
    settled = keep(rows.select("doc", "tag", start.alias("start"), "anchor",
                               (start + F.col("place").bitwiseAND((1 << COUNT_BITS) - 1) + LENGTH - 1).alias("stop")))
    release(spark)
    whole = settled.where("anchor is null").select("doc", "tag", "start", "stop")
    asked = settled.where("anchor is not null")

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, tag_, t, wanted in zip(batch["doc"], batch["tag"], batch["_text"], batch["wanted"]):
                raw = t.encode("utf-8", "replace")
                out += [(w["anchor"], doc, tag_, w["start"], raw[w["start"]:w["stop"]]) for w in wanted]
            yield pd.DataFrame(out, columns=["anchor", "doc", "tag", "start", "bytes"])

    lists = asked.groupBy("doc", "tag").agg(F.collect_set(F.struct("anchor", "start", "stop")).alias("wanted"))
    parts = keep(
        texts.join(lists, (texts["_doc"] == lists["doc"]) & (texts["_tag"] == lists["tag"]))
        .select("doc", "tag", "_text", "wanted").dropDuplicates(["doc", "tag"])
        .mapInPandas(fetched, "anchor bigint, doc bigint, tag bigint, start bigint, bytes binary")
    )
    release(spark)
    large = keep(parts.groupBy("anchor").count().where(F.col("count") > max_contexts).select("anchor"))
    usual = parts.join(large, "anchor", "left_anti")
    buckets = max(1, parts.count() // BUCKET_CONTEXTS)
    found = [whole, usual.groupBy(F.pmod(F.xxhash64("anchor"), buckets).alias("bucket")).applyInPandas(_resolve, SPANS)]
    if not large.isEmpty():
        windows = keep(parts.join(large, "anchor", "left_semi").select("doc", "tag", "start", "bytes")
                       .mapInArrow(_window_hashes, "one bigint, two bigint, doc bigint, tag bigint, start bigint"))
        first = windows.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("first"))
        later = windows.join(first, ["one", "two"]).where(F.struct("doc", "start") > F.col("first"))
        found.append(later.select("doc", "tag", "start", (F.col("start") + LENGTH).alias("stop")))
    out = keep(found[0].unionByName(found[1]) if len(found) == 2 else found[0].unionByName(found[1]).unionByName(found[2]))
    release(spark)
    return out


def keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``documents`` with the order key of the id and the text's hash, which together name a text."""
    return documents.withColumns({
        "_doc": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63))),
        "_tag": F.xxhash64(text)})


def _kept(text: Column, stretches: Column) -> Column:
    @F.pandas_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for t, spans_ in zip(texts, lists):
            raw = (t or "").encode("utf-8", "replace")
            if spans_ is None or not len(spans_):
                out.append((len(raw), 0, 0, raw))
                continue
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, np.array([s["start"] for s in spans_]), 1)
            np.add.at(edge, np.array([s["stop"] for s in spans_]), -1)
            gone = np.cumsum(edge[:-1]) > 0
            out.append((len(raw), int(gone.sum()), len(_runs(gone)), np.frombuffer(raw, np.uint8)[~gone].tobytes()))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return cut.asNondeterministic()(text, stretches)


def without_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the remaining bytes)."""
    lists = spans(documents, doc_id, text, max_contexts).groupBy("doc", "tag").agg(
        F.collect_list(F.struct("start", "stop")).alias("_spans"))
    texts = keyed(documents, doc_id, text).select(F.col(doc_id).alias("doc_id"), "_doc", "_tag", F.col(text).alias("_text"))
    joined = texts.join(lists, (texts["_doc"] == lists["doc"]) & (texts["_tag"] == lists["tag"]), "left")
    cut = joined.select("doc_id", _kept(F.col("_text"), F.col("_spans")).alias("_r"))
    return cut.select("doc_id", "_r.n_bytes", "_r.n_removed", "_r.n_spans", "_r.kept")
