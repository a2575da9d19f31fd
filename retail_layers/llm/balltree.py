"""Exact ranked lexical search: sparse ball trees searched for the largest inner product.

A document is a sparse vector with one integer weight per term of the queries, a query a
sparse vector of integer term weights; the score is their inner product. Documents are read
where they lie. A task gathers blocks of ``block`` of them and splits each into balls, by the
nearer of two far points, until ``leaf`` are left. A ball has a centroid, a radius and a number
of vectors. No vector is negative anywhere, so a term that the centroid lacks is in none of
them, and none holds more of a term than the centroid times their number. No score in a ball
exceeds

    query . centroid + min(|query on the centroid's terms| * radius,
                           query . min(radius, (number - 1) * centroid)),

nor the bound of the ball around it, rounded upwards by more than doubles may lose. Each
query walks the balls best-first through a priority queue and stops when the best bound left is
below its k-th score so far, which a task carries on from block to block; ties are followed,
because the smaller id wins them. Leaves are scored exactly. Tasks return their k best of each
query, and Spark merges these.

Scale: no document is shuffled; corpus counts are aggregated on the map side; a task holds one
block and k results a query. Queries are broadcast in groups of at most ``group_terms`` terms,
further groups follow one another, each over the documents' stored terms. Documents that share
a text differ in their id only and are scored like any others.

Defined cases: a missing or termless text counts in nothing and is never found; equal query rows
are one query, rows that share an id only are answered each; of equal scores the smaller id goes
first, a missing one before all; repeated documents are ranked each; an empty table on either
side gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.llm.common import sliced
from retail_layers.scratch import keep

K = 10
LEAF = 32
BLOCK = 4096
GROUP_TERMS = 50_000
TABLE_BYTES = 128 << 20
SLACK = 1e-9  # far more than the rounding of a sum of doubles, relative to its terms
EXACT = 2 ** 53  # doubles hold whole numbers below this


def _byte_map() -> bytes:
    """Upper case ASCII to lower case; all ASCII but digits and letters to a space."""
    return bytes(ord(chr(b).lower()) if b > 127 or chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


BYTE_MAP = _byte_map()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(BYTE_MAP).split()


@dataclass
class Queries:
    """Term weights of all queries of a group; ``begin`` has one more entry than there are queries."""

    begin: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        of = np.repeat(np.arange(len(self)), np.diff(self.begin))
        self.squares = self.weights.astype(np.float64) ** 2
        self.length = np.sqrt(np.bincount(of, self.squares, len(self)))

    def __len__(self) -> int:
        return len(self.begin) - 1

    def bounds(self, centre: np.ndarray, radius: float, longest: float, number: int) -> np.ndarray:
        """For every query what no score in the ball exceeds."""
        at = centre[self.terms]
        lead = np.add.reduceat(self.weights * at, self.begin[:-1])
        ball = np.sqrt(np.add.reduceat(self.squares * (at > 0), self.begin[:-1])) * radius
        box = np.add.reduceat(self.weights * np.minimum(radius, (number - 1) * at), self.begin[:-1])
        return np.floor(lead + np.minimum(ball, box) + SLACK * (lead + self.length * (radius + longest)) + 1)

    def of(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.begin[q], self.begin[q + 1]
        return self.terms[lo:hi], self.weights[lo:hi]


class Sparse:
    """Rows of (terms, values); every row holds at least one term."""

    def __init__(self, begin: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.begin, self.terms, self.values = begin, terms, values
        self.square = np.add.reduceat(values * values, begin[:-1]) if len(terms) else np.zeros(0)

    def take(self, rows: np.ndarray) -> Sparse:
        size = np.diff(self.begin)[rows]
        begin = np.r_[0, np.cumsum(size)]
        at = np.repeat(self.begin[rows] - begin[:-1], size) + np.arange(begin[-1])
        return Sparse(begin, self.terms[at], self.values[at])

    def dense(self, row: int, out: np.ndarray) -> np.ndarray:
        lo, hi = self.begin[row], self.begin[row + 1]
        out[self.terms[lo:hi]] = self.values[lo:hi]
        return out

    def squared_distance(self, point: np.ndarray) -> np.ndarray:
        dots = np.add.reduceat(self.values * point[self.terms], self.begin[:-1])
        return np.maximum(self.square + point @ point - 2 * dots, 0)


class BallTree:
    """Balls over the rows of one block: ``children`` of a ball, or its ``leaf`` rows."""

    def __init__(self, rows: Sparse, queries: Queries, width: int, leaf: int = LEAF):
        n = len(rows.begin) - 1
        self.children: list[tuple[int, int] | None] = []
        self.leaf: list[np.ndarray | None] = []
        self.bounds: list[np.ndarray] = []
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.held = 0  # bytes of these tables
        self.rows = rows
        todo = [(np.arange(n), rows, -1, 0)] if n else []
        point = np.zeros(width)
        while todo:
            held, part, above, side = todo.pop()
            number = len(self.bounds)
            centre = np.bincount(part.terms, part.values, width) / len(held)
            square = part.squared_distance(centre)
            # the square of a distance is a difference of squares: what that may lose is added back
            radius = math.sqrt(float((square + SLACK * (part.square + centre @ centre)).max())) * (1 + SLACK)
            bound = queries.bounds(centre, radius, math.sqrt(float(part.square.max())), len(held))
            self.bounds.append(bound if above < 0 else np.minimum(bound, self.bounds[above]))
            self.children.append(None)
            self.leaf.append(None)
            if above >= 0:
                pair = self.children[above] or (0, 0)
                self.children[above] = (number, pair[1]) if side == 0 else (pair[0], number)
            near = None
            if len(held) > leaf:
                point[:] = 0
                from_first = part.squared_distance(part.dense(int(square.argmax()), point))
                other = int(from_first.argmax())
                point[:] = 0
                further = from_first - part.squared_distance(part.dense(other, point))
                near = further > 0
                if min(near.sum(), (~near).sum()) * 8 < len(held):  # a few outliers, or equal vectors: halves instead
                    near = np.zeros(len(held), bool)
                    near[np.argsort(further, kind="stable")[len(held) // 2:]] = True
            if near is None:
                self.leaf[number] = held
            else:
                for side, which in ((0, np.flatnonzero(~near)), (1, np.flatnonzero(near))):
                    todo.append((held[which], part.take(which), number, side))

    def scores(self, ball: int, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The exact scores of a leaf's rows."""
        if ball not in self.tables:
            if self.held > TABLE_BYTES:
                self.tables, self.held = {}, 0
            part = self.rows.take(self.leaf[ball])
            columns, at = np.unique(part.terms, return_inverse=True)
            table = np.zeros((len(self.leaf[ball]), len(columns) + 1))
            table[np.repeat(np.arange(len(table)), np.diff(part.begin)), at] = part.values
            self.tables[ball] = columns, table
            self.held += table.nbytes
        columns, table = self.tables[ball]
        at = np.searchsorted(columns, words)
        known = at < len(columns)
        known[known] = columns[at[known]] == words[known]
        part, by = table[:, at[known]], weights[known]
        if float(np.abs(part).max(initial=0)) * float(by.sum()) < EXACT:
            return (part @ by.astype(np.float64)).astype(np.int64)  # whole numbers throughout
        return (part.astype(np.int64) * by).sum(1)

    def search(self, q: int, queries: Queries, best: list[tuple], k: int, names: list[tuple]) -> int:
        """Improve ``best``, a heap of (score, names) with the worst first; returns the leaves met."""
        if not self.bounds:
            return 0
        words, weights = queries.of(q)
        queue, met = [(-self.bounds[0][q], 0)], 0
        while queue:
            bound, ball = heapq.heappop(queue)
            if -bound < 1 or len(best) == k and -bound < best[0][0]:
                break
            if self.children[ball] is not None:
                for child in self.children[ball]:
                    heapq.heappush(queue, (-self.bounds[child][q], child))
                continue
            met += 1
            score = self.scores(ball, words, weights)
            least = best[0][0] if len(best) == k else 1
            for row in np.flatnonzero(score >= max(least, 1)).tolist():
                entry = (int(score[row]), names[self.leaf[ball][row]])
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return met


def weight(n_documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What one occurrence count is worth in a document of ``n`` terms, in whole numbers."""
    m = 25 + 75 * n * n_documents // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _counted(documents: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int] | None):
    """id, n (terms of the text), terms and tfs of the ``vocabulary``; broadcast as plain bytes and numbers."""
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary or {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        for batch in sliced(batches):
            sizes, codes, tfs = [], [], []
            for t in batch.column(1).to_pylist():
                found = terms(t)
                sizes.append(len(found))
                held = Counter(c for c in map(get, found) if c is not None)
                row = sorted(held)
                codes.append(row)
                tfs.append([held[c] for c in row])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(codes, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                ["id", "n", "terms", "tfs"])

    return documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        count, "id bigint, n bigint, terms array<int>, tfs array<bigint>")


def _groups(items: list[tuple], group_terms: int) -> Iterator[list[tuple]]:
    held, size = [], 0
    for item in items:
        if held and size + len(item[1]) > group_terms:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item[1])
    if held:
        yield held


def _query_groups(items: DataFrame, item_id: str, text: str, group_terms: int) -> Iterator[list[tuple]]:
    """Groups of (id, counts of terms) that hold at most ``group_terms`` terms, one at a time."""
    rows = items.select(F.col(item_id).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null").distinct()
    counted = ((r["id"], Counter(terms(r["text"]))) for r in rows.toLocalIterator())
    return _groups((c for c in counted if c[1]), group_terms)


def search(documents: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           group_terms: int = GROUP_TERMS, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for each item."""
    spark = documents.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    found = None
    for number, group in enumerate(_query_groups(items, item_id, text, group_terms)):
        part = _best(documents, group, number, k, doc_id, text, block, leaf)
        names = spark.createDataFrame([(number, q, item) for q, (item, _) in enumerate(group)], f"g int, q int, item_id {kind}")
        part = part.join(names, ["g", "q"]).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return found


def _best(documents: DataFrame, group: list[tuple], number: int, k: int, doc_id: str, text: str, block: int, leaf: int) -> DataFrame:
    words = sorted({w for _, held in group for w in held})
    code = {w: c for c, w in enumerate(words)}
    counted = keep(_counted(documents, doc_id, text, code))
    totals = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(words), np.int64)
    for row in counted.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[row["t"]] = row["count"]  # at most one row per term of the group
    weights = np.array([weight(totals["docs"], int(d)) for d in df], np.int64)
    begin = np.r_[0, np.cumsum([len(held) for _, held in group])]
    arrays = (
        begin, np.array([code[w] for _, held in group for w in held], np.int64),
        np.array([weights[code[w]] * times for _, held in group for w, times in held.items()], np.int64))
    sent = documents.sparkSession.sparkContext.broadcast(arrays)
    width, n_documents, n_terms = len(words), totals["docs"], totals["terms"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(*sent.value)
        best: list[list[tuple]] = [[] for _ in range(len(queries))]
        for held in _blocks(batches, block):
            ids, n, rows = held
            impact = impacts(rows.values, np.repeat(n, np.diff(rows.begin)), n_documents, n_terms)
            tree = BallTree(Sparse(rows.begin, rows.terms, impact.astype(np.float64)), queries, width, leaf)
            # the smaller id is the better one, and a missing id the least
            names = [(0, 0) if i is None else (-1, -i) for i in ids]
            for q in range(len(queries)):
                tree.search(q, queries, best[q], k, names)
        out = [(q, None if there == 0 else -name, score) for q, heap in enumerate(best) for score, (there, name) in heap]
        columns = list(zip(*out)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))],
                                         ["q", "doc_id", "score"])

    hits = counted.where(F.size("terms") > 0).mapInArrow(searched, "q int, doc_id bigint, score bigint")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).withColumn("g", F.lit(number))


@dataclass
class _Rows:
    begin: np.ndarray
    terms: np.ndarray
    values: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[list, np.ndarray, _Rows]]:
    """ids, lengths and term counts of ``block`` documents at a time."""
    held, size = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, min(block - size, batch.num_rows - at))
            held.append(part)
            size += part.num_rows
            at += part.num_rows
            if size == block:
                yield _joined(held)
                held, size = [], 0
    if size:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> tuple[list, np.ndarray, _Rows]:
    whole = pa.Table.from_batches(held).combine_chunks()
    codes, tfs = (whole.column(c).combine_chunks() for c in ("terms", "tfs"))
    codes, tfs = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (codes, tfs))
    begin = np.r_[0, np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    return (whole.column("id").to_pylist(), whole.column("n").to_numpy(),
            _Rows(begin, codes.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()))
