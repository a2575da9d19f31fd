"""MinHash near-dedup with circulant permutations, banding and exact Jaccard verification.

A document's set holds its distinct shingles of five words (all words as one shingle when
there are fewer). One permutation spreads the shingles over a ring; a second one, shifted
by one place per coordinate, gives every coordinate of the signature, so a shingle costs
one contiguous read. Five coordinates make a band key. Documents that share a band key are
candidates, and a link counts only after the whole sets were intersected.

Scale: equal sets are one node, so exact copies cost one row. Band rows are range
partitioned by (key, node), so one very large bucket spreads over tasks, and each task
streams its sorted rows: up to ``FULL`` members of a bucket are compared with each other,
later ones with the first and the preceding member. Links are verified in rounds, and a
pair is looked at only while its ends are in different components. Members of buckets that
were cut or longer than ``FULL`` and still lie in several components are then compared
across components, block against block: what a task hands on are links, never all pairs
of a group, and no link is missed for a bucket's size. What remains is
the chance that two linked texts share no band: below 3 in a million at similarity 0.75.

Defined cases: a missing or empty text has no set, is linked with nothing and is its own
component; rows that share an id and a text are equal rows; a row without id takes part but
is never kept. Extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_layers.llm.common import free_name, release, sliced
from retail_layers.scratch import keep

SHINGLE = 5
BANDS, ROWS = 48, 5
RING = 1 << 18
FULL = 16
BLOCK = 512
SPACE = bytes([32, *range(9, 14)])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_2 = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values spread so that every bit depends on every bit."""
    h = (h ^ (h >> np.uint64(32))) * ODD_2
    h = (h ^ (h >> np.uint64(29))) * ODD
    return h ^ (h >> np.uint64(32))


class Hashing:
    """The fixed random tables: a value per byte, powers, and the two permutations."""

    def __init__(self, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.byte_value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.is_word = np.ones(256, bool)
        self.is_word[list(SPACE)] = False
        self.factor = rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
        self.spread = rng.permutation(RING)
        ring = rng.permutation(RING).astype(np.uint32)
        self.shifted = sliding_window_view(np.concatenate([ring, ring[:BANDS * ROWS]]), BANDS * ROWS)
        self.band_seed = rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
        self.band_factor = rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)

    def word_hashes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-8", "replace").translate(LOWER), np.uint8)
        inside = self.is_word[raw]
        first = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        if not len(first):
            return np.zeros(0, np.uint64)
        size = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1 - first
        begin = np.cumsum(size) - size
        place = np.arange(begin[-1] + size[-1]) - np.repeat(begin, size)
        power = np.cumprod(np.full(size.max(), ODD, np.uint64))
        return mixed(np.add.reduceat(self.byte_value[raw[inside]] * power[place], begin))

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted distinct shingles of a whole text as 64-bit values."""
        words = self.word_hashes(text or "")
        n = min(SHINGLE, len(words))
        if not n:
            return words
        total = np.full(len(words) - n + 1, n, np.uint64)
        for j in range(n):
            total = total + words[j:len(words) - n + 1 + j] * self.factor[j]
        return np.unique(mixed(total))

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(shingles), 8192):
            place = self.spread[(shingles[at:at + 8192] >> np.uint64(40)).astype(np.int64) % RING]
            least = np.minimum(least, self.shifted[place].min(axis=0))
        bands = (least.reshape(BANDS, ROWS).astype(np.uint64) * self.band_factor).sum(1)
        return mixed(bands + self.band_seed).view(np.int64)


def set_id(shingles: np.ndarray) -> int:
    """One 64-bit value for a whole set."""
    return int(mixed(np.array([mixed(shingles + ODD).sum() + np.uint64(len(shingles))])).view(np.int64)[0])


def pack(shingles: np.ndarray) -> bytes:
    """Six bytes of each shingle; they keep their order."""
    return np.ascontiguousarray((shingles >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def signatures(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, node (None without a set) and its band keys."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = Hashing()
        for batch in sliced(batches):
            sets = [h.shingles(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([set_id(x) if len(x) else None for x in sets], pa.int64()),
                pa.array([h.band_keys(x) if len(x) else [] for x in sets], pa.list_(pa.int64())),
            ], ["doc_id", "text_hash", "n_shingles", "node", "bands"])

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                            F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(signed, "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, bands array<bigint>")


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of rows sorted by key and node; members (key, b) of long or cut buckets."""
    tail_key = np.zeros(0, np.int64)  # the last rows of the current bucket, FULL at most
    tail_node = np.zeros(0, np.int64)
    tail_index = np.zeros(0, np.int64)
    pivot, first_key, last = 0, None, None

    def out(a, b, key):
        none = np.zeros(len(b), bool)
        return pa.RecordBatch.from_arrays(
            [pa.array(a if a is not None else np.zeros(len(b), np.int64), mask=none if a is not None else ~none),
             pa.array(b), pa.array(key if key is not None else np.zeros(len(b), np.int64),
                                   mask=none if key is not None else ~none)], ["a", "b", "key"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.concatenate([tail_key, batch.column(0).to_numpy(zero_copy_only=False)])
        node = np.concatenate([tail_node, batch.column(1).to_numpy(zero_copy_only=False)])
        old = len(tail_key)
        new_run = np.r_[True, key[1:] != key[:-1]]
        start = np.maximum.accumulate(np.where(new_run, np.arange(len(key)), 0))
        index = np.arange(len(key)) - start
        head = node[start].copy()
        if old:  # the tail continues the bucket it belongs to
            same = start == 0
            index[same] += tail_index[0]
            head[same] = pivot
        if first_key is None:
            first_key = key[0]
        pairs_a, pairs_b = [], []
        fresh = np.arange(len(key)) >= old
        for back in range(1, FULL):
            at = np.flatnonzero(fresh & (index >= back) & ((index < FULL) | (back == 1)))
            at = at[at - back >= start[at]]
            pairs_a.append(node[at - back])
            pairs_b.append(node[at])
        far = fresh & (index >= FULL)
        pairs_a.append(head[far])
        pairs_b.append(node[far])
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        if len(a):
            yield out(a, b, None)
        # members of long buckets: from the FULL-th on, and the first ones once it is long
        member = far.copy()
        for at in np.flatnonzero(fresh & (index == FULL)):
            member[max(0, at - FULL):at] = True
        member |= fresh & (key == first_key)
        if member.any():
            yield out(None, node[member], key[member])
        keep_from = max(start[-1], len(key) - FULL)
        tail_key, tail_node, tail_index = key[keep_from:], node[keep_from:], index[keep_from:]
        pivot, last = head[-1], key[-1]
    if last is not None and len(tail_key):
        yield out(None, tail_node, tail_key)  # the bucket may go on in the next task


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) and members (key, b), kept; nodes has node and bands."""
    rows = keep(nodes.select(F.explode("bands").alias("key"), "node"))
    return keep(
        rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
        .mapInArrow(_edges, "a bigint, b bigint, key bigint")
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have 100 * intersection >= percent * union."""

    @F.pandas_udf("bigint")
    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(unpack(p), unpack(q), assume_unique=True)) for p, q in zip(x, y)], dtype="int64")

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"), F.col("n").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"), F.col("n").alias("nb"))
    close = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    both = pairs.join(right, "b").join(left, "a").where(close)
    return (
        both.withColumn("both", common("ma", "mb"))
        .where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent)
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, label for every end of an edge; the label is the least node reachable.

    Every node hooks to its least neighbour, pointers are shortened until they rest on
    roots, and the roots' graph is treated alike until it has no edge left.
    """
    spark = edges.sparkSession
    labels = None
    while True:
        edges = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .where(F.col("a") != F.col("b")).distinct())
        if edges.isEmpty():
            return labels if labels is not None else spark.createDataFrame([], "node bigint, label bigint")
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
            edges.select(F.col("a").alias("node"), F.col("a").alias("label")))
        hooks = keep(ends.groupBy("node").agg(F.min("label").alias("label")))
        while True:
            up = hooks.select(F.col("node").alias("label"), F.col("label").alias("_up"))
            jumped = keep(hooks.join(up, "label").select("node", F.col("_up").alias("label"),
                                                         (F.col("_up") != F.col("label")).alias("_moved")))
            hooks = jumped.drop("_moved")
            if jumped.where("_moved").isEmpty():
                break
        labels = hooks if labels is None else keep(relabelled(labels, hooks, "label"))
        edges = relabelled(relabelled(edges, hooks, "a"), hooks, "b")


def relabelled(rows: DataFrame, labels: DataFrame, col: str) -> DataFrame:
    """``col`` replaced by its label where it has one."""
    by = labels.select(F.col("node").alias(col), F.col("label").alias("_new"))
    return rows.join(by, col, "left").withColumn(col, F.coalesce("_new", col)).drop("_new").select(*rows.columns)


def link(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """Per row of ``documents``: doc_id, text_hash, n_shingles, component_id, kept."""
    spark = documents.sparkSession
    rows = keep(signatures(documents, doc_id, text))
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("bands").alias("bands"), F.min("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"))
    nodes = keep(nodes)
    found = candidates(nodes)
    pairs = found.where(F.col("key").isNull()).select("a", "b")
    members = found.where(F.col("key").isNotNull()).select("key", F.col("b").alias("node"))

    # whole sets of the nodes that are candidates at all
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.select("node")).distinct()
    sources = nodes.join(wanted, "node", "left_semi").select("node", F.col("doc_id").alias("_id"))
    sets = keep(_sets(documents, doc_id, text, sources))
    release(spark)

    # each node's likeliest link decides most components; then only pairs across components matter
    counted = keep(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")))
    either = counted.select(F.col("a").alias("node"), F.col("b").alias("other"), "shared").unionByName(
        counted.select(F.col("b").alias("node"), F.col("a").alias("other"), "shared"))
    star = keep(either.groupBy("node").agg(F.max_by("other", F.struct("shared", "other")).alias("other"))
                .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    labels = components(verified(star, sets, percent))
    across = relabelled(counted.select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")), labels, "ca")
    across = relabelled(across, labels, "cb").where("ca <> cb").join(star, ["a", "b"], "left_anti").select("a", "b")
    labels = _merged(labels, keep(verified(across, sets, percent)))

    # long or cut buckets whose members still lie in several components
    members = keep(members.distinct())
    placed = _split(members, labels)
    if not placed.isEmpty():
        labels = _merged(labels, keep(_links_across(placed, sets, percent)))

    named = keep(_named(nodes, labels))
    release(spark)
    return (
        rows.drop("bands").join(named, "node", "left")
        .select("doc_id", "text_hash", "n_shingles",
                F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def _split(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, node, label of the members of buckets that lie in several components; kept."""
    placed = keep(relabelled(members.withColumn("label", F.col("node")), labels, "label"))
    split = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return keep(placed.join(split.select("key"), "key", "left_semi"))


def _links_across(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of the same cluster of buckets, one per pair of components at least.

    placed has key, node, label. Buckets that share a node are one cluster. Its nodes
    outside its largest component are compared with all its nodes in blocks of whole
    sets: a task gets two blocks and hands on links only, never pairs.
    """
    first = placed.groupBy("key").agg(F.min("node").alias("a"))
    cluster = components(placed.join(first, "key").select("a", F.col("node").alias("b")))
    nodes = keep(placed.select("node", "label").distinct().join(cluster.withColumnRenamed("label", "cluster"), "node"))
    sizes = nodes.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("_n")).groupBy("cluster").agg(
        F.sum("_n").alias("_all"), F.max("_n").alias("_most"), F.max_by("label", F.struct("_n", "label")).alias("_main"))
    n_all = F.ceil(F.col("_all") / BLOCK).cast("int")
    n_rest = F.ceil((F.col("_all") - F.col("_most")) / BLOCK).cast("int")
    nodes = nodes.join(sizes, "cluster").withColumn("_h", F.xxhash64("node"))
    right = nodes.select("cluster", "node", "label", F.lit(False).alias("rest"), F.pmod("_h", n_all).alias("j"),
                         F.explode(F.sequence(F.lit(0), n_rest - 1)).alias("i"))
    left = nodes.where("label <> _main").select("cluster", "node", "label", F.lit(True).alias("rest"),
                                                F.explode(F.sequence(F.lit(0), n_all - 1)).alias("j"),
                                                F.pmod("_h", n_rest).alias("i"))
    blocks = right.select("cluster", "i", "j", "node", "label", "rest").unionByName(
        left.select("cluster", "i", "j", "node", "label", "rest")).join(sets.select("node", "members"), "node")

    def compare(held: pd.DataFrame) -> pd.DataFrame:
        x, y = held[held["rest"]], held[~held["rest"]]
        sides = [[unpack(m) for m in side["members"]] for side in (x, y)]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        both = _intersections(*sides)
        n = [np.array([len(s) for s in side]) for side in sides]
        linked = both * 100 >= (n[0][:, None] + n[1][None, :] - both) * percent
        linked &= x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :]
        i, j = np.nonzero(linked)
        found = pd.DataFrame({"a": x["node"].to_numpy()[i], "b": y["node"].to_numpy()[j],
                              "la": x["label"].to_numpy()[i], "lb": y["label"].to_numpy()[j]})
        return found.drop_duplicates(["la", "lb"])[["a", "b"]]

    return blocks.groupBy("cluster", "i", "j").applyInPandas(compare, "a bigint, b bigint").distinct()


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections between two blocks of sets."""
    shared = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    total = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(shared), 4096):  # the shared shingles in slices of bounded width
        part = shared[at:at + 4096]
        rows = []
        for side in (left, right):
            table = np.zeros((len(side), len(part)), np.float32)
            for k, s in enumerate(side):
                place = np.searchsorted(part, s)
                place[place == len(part)] = 0
                table[k, place[part[place] == s]] = 1
            rows.append(table)
        total += (rows[0] @ rows[1].T).astype(np.int64)
    return total


def _named(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """node, component_id: the smallest doc_id of each component."""
    labelled = relabelled(nodes.select("node", "doc_id", F.col("node").alias("label")), labels, "label")
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return labelled.select("node", "label").join(least, "label").select("node", "component_id")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the components at both ends of each link became one."""
    if links.isEmpty():
        return labels
    more = components(relabelled(relabelled(links, labels, "a"), labels, "b"))
    old = relabelled(labels, more, "label")
    return keep(old.unionByName(more.join(labels, "node", "left_anti")))


def _sets(documents: DataFrame, doc_id: str, text: str, sources: DataFrame) -> DataFrame:
    """node, n, members of the wanted nodes, from one document of each."""
    texts = documents.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("string").alias("_text"))
    picked = texts.join(sources, texts["_id"].eqNullSafe(sources["_id"])).select("node", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = Hashing()
        for batch in sliced(batches):
            sets = zip(batch.column("node").to_pylist(), map(h.shingles, batch.column("_text").to_pylist()))
            # the id may have other texts too
            found = [(node, len(x), pack(x)) for node, x in sets if len(x) and set_id(x) == node]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                ["node", "n", "members"])

    return picked.mapInArrow(run, "node bigint, n bigint, members binary").groupBy("node").agg(
        F.first("n").alias("n"), F.first("members").alias("members"))


def deduplicated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One document of each group, whole rows: the one with the smallest id.

    Of rows with equal id and equal text one stays. Rows without id are never dropped.
    """
    id_, hash_ = free_name(documents, "_linked_id"), free_name(documents, "_linked_hash")
    linked = keep(link(documents, doc_id, text, percent).where(F.col("doc_id").isNotNull())
                  .groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
                  .agg(F.min("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")))
    same = (F.col(doc_id).cast("bigint") == F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    left = documents.join(linked.where("not _kept").select(id_, hash_), same, "left_anti")
    repeated = linked.where("_kept and _rows > 1").select(id_, hash_)
    if repeated.isEmpty():
        return left
    once = left.join(repeated, same, "left_semi").dropDuplicates([doc_id, text])
    return left.join(repeated, same, "left_anti").unionByName(once)
