"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees.

Vectors get one more component that brings all to the same length, so a large inner product
is nearness, and trees of random hyperplanes are fitted on a sample of at most
``SAMPLE_ROWS`` vectors. Every vector is routed to one leaf of every tree. A query walks all
trees through one shared priority queue, nearest side first, and takes the best leaves, at
least ``PROBES``; leaves meet their queries in one task each, where inner products are computed
in double precision on the original vectors, and the best of all leaves are merged.

How many leaves a query takes is measured on the table itself: for the ``CHECKED`` queries of
least hash the true neighbours are found by comparing all rows, and enough leaves are taken for
them to meet the share ``RECALL``. Where more than ``PROBES`` are needed and they hold more
than a ``DENSE`` part of all rows, every query is compared with all rows instead, in blocks of
queries and slices of rows; trees do not part such a table.

Equal vectors are one node with its smallest ids (one more than asked for, as a query skips
itself), so a vector that a third of all rows share fills no leaf.

Defined cases: vectors that are null, zero, of another length than most, or that hold null
or non-finite components take no part; a row repeated with its id counts once; ties go to
the smaller id; with fewer candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.scratch import keep

TREES = 16
LEAF_ROWS = 96
PROBES = 160
SAMPLE_ROWS = 50_000
CHECKED = 100
RECALL = 0.95
DENSE = 0.25
BLOCK_QUERIES = 4096
SLICE_ROWS = 50_000
LEAST_SLICES = 8


@dataclass
class Forest:
    """Planes of all trees in one table; a child below 0 is leaf ``-1 - child``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(x), root)
            open_ = np.flatnonzero(at >= 0)
            while len(open_):
                plane = at[open_]
                side = np.einsum("ij,ij->i", x[open_], self.normals[plane]) >= self.offsets[plane]
                at[open_] = self.children[plane, side.astype(int)]
                open_ = open_[at[open_] >= 0]
            out[:, t] = -1 - at
        return out

    def nearness(self, q: np.ndarray) -> np.ndarray:
        """For each query and leaf its place in the one queue: the largest margin on the way to it."""
        margins = q @ self.normals.T - self.offsets
        near = np.full((len(q), len(self.normals)), -np.inf)
        out = np.full((len(q), self.n_leaves), -np.inf)
        level = np.array([r for r in self.roots if r >= 0], np.int64)
        while len(level):
            following = []
            for side, sign in ((0, 1), (1, -1)):
                child = self.children[level, side]
                value = np.maximum(near[:, level], sign * margins[:, level])
                inner = child >= 0
                near[:, child[inner]] = value[:, inner]
                out[:, -1 - child[~inner]] = value[:, ~inner]
                following.append(child[inner])
            level = np.concatenate(following)
        return out

    @property
    def n_leaves(self) -> int:
        return len(self.normals) + len(self.roots)

    def probes(self, q: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each query the ``wanted`` leaves that come first out of one queue over all trees."""
        if wanted >= self.n_leaves:
            return [np.arange(self.n_leaves)] * len(q)
        return list(np.argpartition(self.nearness(q), wanted - 1, axis=1)[:, :wanted])

    def needed(self, q: np.ndarray, true: list[np.ndarray], recall: float) -> int:
        """How many leaves a query has to take until the share ``recall`` of its ``true`` neighbours is met."""
        first = []
        for one, x in zip(q, true):
            if len(x):
                near = self.nearness(one[None, :])[0]
                best = near[self.leaves(x)].min(1)
                first.append(np.searchsorted(np.sort(near), best, side="right"))
        if not first:
            return 1
        first = np.sort(np.concatenate(first))
        return int(first[min(len(first), int(np.ceil(recall * len(first)))) - 1])


def plant(sample: np.ndarray, leaf: float, trees: int, seed: int = 1) -> Forest:
    """Trees whose planes halve the sample between two of its vectors until ``leaf`` are left."""
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots = [], [], [], []
    n_leaves = 0

    for _ in range(trees):
        todo = [(np.arange(len(sample)), None, 0)]
        root = None
        while todo:
            rows, parent, side = todo.pop()
            plane = None
            if len(rows) > max(leaf, 1):
                for _ in range(3):  # equal vectors have no plane between them
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    size = np.linalg.norm(a - b)
                    if size == 0:
                        continue
                    normal = (a - b) / size
                    at = sample[rows] @ normal
                    offset = float(np.median(at))
                    high = at >= offset
                    if 0 < high.sum() < len(rows):
                        plane = normal, offset, high
                        break
            if plane is None:
                number = -1 - n_leaves
                n_leaves += 1
            else:
                number = len(normals)
                normals.append(plane[0])
                offsets.append(plane[1])
                children.append([0, 0])
                todo += [(rows[~plane[2]], number, 0), (rows[plane[2]], number, 1)]
            if parent is None:
                root = number
            else:
                children[parent][side] = number
        roots.append(root)
    width = sample.shape[1] if sample.size else 1
    return Forest(np.array(normals, np.float64).reshape(-1, width), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), roots)


def valid_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v and node (a hash of the vector) of the vectors that take part."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = (
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(F.coalesce(fine, F.lit(False)))
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0)).withColumn("node", F.xxhash64("v"))


def search(vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
           trees: int = TREES, leaf_rows: int = LEAF_ROWS, probes: int = PROBES,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row where ``is_query``."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, vec_id, embedding)
    nodes = keep(
        rows.groupBy("node", "vec_id").agg(F.first("v").alias("v"))
        .withColumn("_place", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("_place") <= k + 1)
        .groupBy("node").agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    queries = keep(rows.where(is_query).select("node", F.col("vec_id").alias("query_id")).distinct())
    n = nodes.count()
    longest = nodes.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0] or 0.0
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("v").toPandas()
    flat = _lifted(np.array(sample["v"].tolist(), np.float64) if len(sample) else np.zeros((0, 1)), longest)
    grown = plant(flat, leaf_rows * len(sample) / max(n, 1), trees)
    wanted = max(probes, _leaves_needed(nodes, queries, grown, longest, k)) if probes < grown.n_leaves else probes
    if wanted > probes and wanted * leaf_rows > DENSE * n:
        return _listed(_compared(nodes, queries, n, k), nodes, queries, k)
    # plain arrays: executors need no copy of the package to read them
    sent = spark.sparkContext.broadcast((grown.normals, grown.offsets, grown.children, grown.roots))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest(*sent.value)
        for batch in batches:
            x = np.stack(batch["v"].to_numpy()).astype(np.float64)
            leaves = forest.leaves(_lifted(x, longest))
            yield pd.DataFrame({"leaf": leaves.ravel(), "node": np.repeat(batch["node"].to_numpy(), leaves.shape[1]),
                                "least": np.repeat(batch["least"].to_numpy(), leaves.shape[1]),
                                "v": np.repeat(batch["v"].to_numpy(), leaves.shape[1])})

    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest(*sent.value)
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.iloc[at:at + 64]
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                found = forest.probes(np.c_[x, np.zeros(len(x))], wanted)
                count = [len(f) for f in found]
                yield pd.DataFrame({"leaf": np.concatenate(found), "node": np.repeat(part["node"].to_numpy(), count),
                                    "v": np.repeat(part["v"].to_numpy(), count)})

    def scored(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _scored(held, asked, k)

    kind = dict(nodes.dtypes)["v"]
    index = nodes.select("node", "least", "v").mapInPandas(routed, f"leaf bigint, node bigint, least bigint, v {kind}")
    asked = nodes.join(queries.select("node").distinct(), "node", "left_semi").select("node", "v").mapInPandas(
        probed, f"leaf bigint, node bigint, v {kind}")
    found = index.groupBy("leaf").cogroup(asked.groupBy("leaf")).applyInPandas(scored, "query bigint, node bigint, score double")
    return _listed(found, nodes, queries, k)


def _scored(held: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """query, node, score: the best ``k`` and the query itself of all ``held`` for each one ``asked``; of
    equal scores those with the smallest ids.

    A matrix product finds what may be among the best. Its last bits depend on the shape of the block, so
    these are scored again row by row, by one formula wherever they lie.
    """
    if not len(held) or not len(asked):
        return pd.DataFrame({"query": [], "node": [], "score": []})
    x, q = (np.stack(f["v"].to_numpy()).astype(np.float64) for f in (held, asked))
    names, least, queries, out = held["node"].to_numpy(), held["least"].to_numpy(), asked["node"].to_numpy(), []
    slack = 1e-10 * np.sqrt((x * x).sum(1).max() * (q * q).sum(1))
    for at in range(0, len(q), 512):
        product = q[at:at + 512] @ x.T
        edge = np.partition(product, max(len(x) - k - 1, 0), axis=1)[:, max(len(x) - k - 1, 0)]
        for row, one in enumerate(product):
            close = np.flatnonzero(one >= edge[row] - slack[at + row])
            score = np.einsum("ij,j->i", x[close], q[at + row])
            best = np.lexsort((least[close], -score))[:k + 1]
            out.append((np.full(len(best), queries[at + row]), names[close[best]], score[best]))
    return pd.DataFrame(dict(zip(("query", "node", "score"), map(np.concatenate, zip(*out)))))


def _leaves_needed(nodes: DataFrame, queries: DataFrame, forest: Forest, longest: float, k: int) -> int:
    """Leaves that meet the share ``RECALL`` of the true neighbours of the ``CHECKED`` queries of least hash."""
    spark = nodes.sparkSession
    asked = (
        nodes.join(queries.select("node").distinct(), "node", "left_semi")
        .orderBy(F.xxhash64("node"), "node").limit(CHECKED).select("node", "v").toPandas())
    if not len(asked):
        return 1
    checked = spark.sparkContext.broadcast(asked)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _scored(batch, checked.value, k)

    every = nodes.select("node", "least", "v").mapInPandas(nearest, "query bigint, node bigint, score double")
    ranked = every.withColumn("_at", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node")))
    true = ranked.where(F.col("_at") <= k + 1).where("node <> query").join(nodes, "node").select("query", "v").toPandas()
    of = {query: _lifted(np.array(v.tolist(), np.float64), longest) for query, v in true.groupby("query")["v"]}
    q = np.array(asked["v"].tolist(), np.float64)
    return forest.needed(np.c_[q, np.zeros(len(q))], [of.get(x, q[:0]) for x in asked["node"]], RECALL)


def _compared(nodes: DataFrame, queries: DataFrame, n: int, k: int) -> DataFrame:
    """query, node, score: every query against all rows, one block of queries and slice of rows a task."""
    asked = keep(nodes.join(queries.select("node").distinct(), "node", "left_semi").select("node", "v"))
    blocks = -(-asked.count() // BLOCK_QUERIES)
    slices = max(LEAST_SLICES, -(-n // SLICE_ROWS))
    block, slice_ = F.pmod(F.xxhash64("node"), F.lit(blocks or 1)), F.pmod(F.hash("node"), F.lit(slices))
    every = nodes.select("node", "least", "v", slice_.alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))).alias("block"))
    asked = asked.select("node", "v", block.cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    return every.groupBy("slice", "block").cogroup(asked.groupBy("slice", "block")).applyInPandas(
        lambda held, q: _scored(held, q, k), "query bigint, node bigint, score double")


def _listed(found: DataFrame, nodes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the best of all ``found``."""
    best = (
        found.groupBy("query", "node").agg(F.max("score").alias("score"))
        .join(nodes.select("node", "ids"), "node")
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("_place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("_place") <= k + 1)
        .groupBy(F.col("query").alias("node")).agg(F.sort_array(F.collect_list(F.struct("_place", "vec_id", "score"))).alias("best"))
    )
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    listed = queries.join(best, "node").select("query_id", F.posexplode(others).alias("_at", "_hit"))
    return listed.select("query_id", (F.col("_at") + 1).alias("rank"), "_hit.vec_id", "_hit.score")


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that brings them to the longest one's length."""
    return np.c_[x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0))]
