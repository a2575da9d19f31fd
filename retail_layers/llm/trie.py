"""Burst trie of conversations: every shared beginning of conversations once.

A conversation is a sequence of turns, a turn the 16-byte digest of its role and text, so
texts stay where they are. Equal sequences are one record with the number of its
conversations. Records start in one container under the root. A container that holds more
than ``burst`` turns and more than one record bursts: what all its records share becomes a
trie head (found from the least and the greatest record), and its records move on to one
container per next turn. The containers that remain are dealt to shards, sorted by Spark
and swept by tasks that keep open the path to the current record only; their nodes are rolled
up into the heads, deepest round first.

Scale: a head that a third of all conversations begin with is burst like any other, copies
travel as one record from the map side on, and rounds follow the branching of oversized
containers, not the depth of the trie. A task holds the nodes of one container (at most
``burst`` turns, or a single record), and the turn digests of one conversation. The digest of
a node's ending ids is a hash over their sorted sequence, so the ids of equal conversations are
streamed through one task, in constant memory.

Defined cases: a missing conversation id belongs to no conversation; missing role and text are
empty; turns of one number are ordered by role, then by digest; repeated rows are repeated
turns; without conversations there are no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.scratch import keep

BURST_TURNS = 20_000
SHARD_TURNS = 100_000
GROUP = 20  # conversations of one group share the beginning of the group's first
SHARED = 4
WORD = r"[^\x20\x09-\x0D]+"
NODE = ("depth bigint, conv_id bigint, parent_conv_id bigint, head string, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, last_turn binary, seq string, ends bigint")
# seq, ends: the record that ends at the node and its least conversation


def sequences(conversations: DataFrame) -> DataFrame:
    """conv, turns (role digest and words of each turn in order): one row per conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), digest.alias("id"),
                 F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words")).alias("t"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuilt(own: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Every conversation with its first ``crc32(id) % shared`` turns taken from its group's first one."""
    first = own.where(F.col("conv") % group == 0).select(
        F.col("conv").alias("_base"), F.slice("turns", 1, shared - 1).alias("_turns"))
    h = (F.crc32(F.col("conv").cast("string")) % shared).cast("int")
    joined = own.join(first, F.col("conv") - F.col("conv") % group == F.col("_base"), "left")
    begin = F.slice(F.coalesce("_turns", F.slice("turns", 1, 0)), F.lit(1), h)
    return joined.select("conv", F.concat(begin, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def trie(conversations: DataFrame, burst: int = BURST_TURNS, shard: int = SHARD_TURNS) -> DataFrame:
    """The nodes of sequences (conv, turns): depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, last_turn (digest of the node's last turn), ends_sha256."""
    ids = F.col("turns.id")
    named = keep(conversations.select(
        "conv", ids.alias("ids"), F.col("turns.words").alias("words"),
        F.md5(F.array_join(F.transform(ids, lambda x: F.hex(x)), "")).alias("seq")))
    records = named.groupBy("seq", "ids", "words").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    active = keep(records.select("*", F.lit("").alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(-1).alias("base")))
    left, rounds = [], []
    while True:
        turns = F.sum((F.size("ids") - F.col("base")).cast("bigint"))
        large = keep(
            active.groupBy("key", "parent", "base").agg(
                F.count(F.lit(1)).alias("_records"), turns.alias("_turns"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
                F.min(F.struct("ids", "words", "seq", "conv")).alias("lo"), F.max("ids").alias("hi"))
            .where((F.col("_records") > 1) & (F.col("_turns") > burst))
            .withColumn("depth", _shared(F.col("lo.ids"), F.col("hi"))))
        if large.isEmpty():
            left.append(active)
            break
        left.append(active.join(large.select("key"), "key", "left_anti"))
        rounds.append(large)
        moved = active.join(large.select("key", "depth"), "key").where(F.size("ids") > F.col("depth"))
        deeper = F.md5(F.concat(F.col("key"), F.hex(F.element_at("ids", F.col("depth") + 1))))
        active = keep(moved.select("seq", "ids", "words", "n", "conv", deeper.alias("key"),
                                   F.col("key").alias("parent"), F.col("depth").alias("base")))
    containers = reduce(DataFrame.unionByName, left)
    size = containers.agg(F.sum(F.size("ids").cast("bigint") + 1)).first()[0] or 0
    swept = keep(
        containers.select("key", "ids", "words", "seq", "parent", "base", "n", "conv")
        .repartition(max(1, -(-size // shard)), "key").sortWithinPartitions("key", "ids").mapInArrow(_sweep, NODE))
    nodes = _rolled_up(swept, rounds)
    ends = (
        named.join(records.where("n > 1").select("seq"), "seq", "left_semi").select("seq", "conv")
        .repartition("seq").sortWithinPartitions("seq", "conv").mapInArrow(_digests, "seq string, several string"))
    one = F.when(F.col("seq").isNull(), F.sha2(F.lit(""), 256)).otherwise(F.sha2(F.col("ends").cast("string"), 256))
    return nodes.join(ends, "seq", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "last_turn",
        F.coalesce("several", one).alias("ends_sha256"))


def _shared(lo: Column, hi: Column) -> Column:
    """How many ids two arrays have in common at their beginning."""
    other = F.array_position(F.zip_with(lo, hi, lambda a, b: a.eqNullSafe(b)), False).cast("int")
    return F.when(other == 0, F.size(lo)).otherwise(other - 1)


def _rolled_up(swept: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """All nodes: the swept ones with the heads above them, whose totals come from below."""
    below = swept.where("head is not null").select("head", "n_leaves", "saved_tokens")
    found = []
    for large in reversed(rounds):
        top = F.greatest(F.col("base") + 1, F.lit(0))
        totals = below.groupBy("head").agg(F.count(F.lit(1)).alias("_children"), F.sum("n_leaves").alias("_leaves"),
                                           F.sum("saved_tokens").alias("_saved"))
        level = F.sequence(top, F.col("depth"))
        first = F.greatest("_l", F.lit(1))
        ended = (F.col("_l") == F.col("depth")) & (F.size("lo.ids") == F.col("depth"))
        words = F.aggregate(F.slice("lo.words", first, F.col("depth") - first + 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
        chain = keep(
            large.join(totals, large["key"] == totals["head"]).select("*", F.explode(level).alias("_l"))
            .select(
                F.col("_l").cast("bigint").alias("depth"), F.col("conv").alias("conv_id"),
                F.when(F.col("_l") > top, F.col("conv")).alias("parent_conv_id"),
                F.when(F.col("_l") == top, F.col("parent")).alias("head"),
                F.col("n").alias("n_convs"), F.when(F.col("_l") == F.col("depth"), F.col("_children")).otherwise(1).alias("n_children"),
                F.col("_leaves").alias("n_leaves"),
                (F.col("_saved") + (F.col("n") - 1) * words).alias("saved_tokens"),
                F.when(F.col("_l") > 0, F.element_at("lo.ids", first)).alias("last_turn"),
                F.when(ended, F.col("lo.seq")).alias("seq"), F.when(ended, F.col("lo.conv")).alias("ends")))
        found.append(chain)
        # heads of the round before count what lies under this round's heads too
        below = below.unionByName(chain.where("head is not null").select("head", "n_leaves", "saved_tokens"))
    if not found:
        return swept.drop("head")
    heads = reduce(DataFrame.unionByName, found)
    above = reduce(DataFrame.unionByName, rounds).select(F.col("key").alias("head"), F.col("conv").alias("_above"))
    every = swept.unionByName(heads).join(above, "head", "left")
    return every.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).drop("_above", "head")


class _Container:
    """The nodes under one head, from records in sorted order."""

    def __init__(self, base: int, parent: str | None):
        self.base, self.parent = base, parent
        self.last: list[bytes] = []
        self.nodes: list[list] = []  # depth, conv, above, n, children, leaves, saved, last turn, seq, ends
        self.open: list[int] = []
        self.words: list[int] = []

    def add(self, ids: list[bytes], words: list[int], seq: str, n: int, conv: int) -> None:
        common = 0
        for a, b in zip(self.last, ids):
            if a != b:
                break
            common += 1
        while self.open and self.nodes[self.open[-1]][0] > common:
            self._close()
        begin = self.nodes[self.open[-1]][0] + 1 if self.open else self.base + 1
        for depth in range(begin, len(ids) + 1):
            above = self.open[-1] if self.open else None
            if above is not None:
                self.nodes[above][4] += 1
            self.open.append(len(self.nodes))
            self.nodes.append([depth, conv, above, 0, 0, 0, 0, ids[depth - 1] if depth else None, None, None])
            self.words.append(words[depth - 1] if depth else 0)
        end = self.nodes[self.open[-1]]
        end[1], end[3], end[8], end[9] = min(end[1], conv), end[3] + n, seq, conv
        self.last = ids

    def _close(self) -> None:
        at = self.open.pop()
        node = self.nodes[at]
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * self.words[at]
        if self.open:
            above = self.nodes[self.open[-1]]
            above[1] = min(above[1], node[1])
            for k in (3, 5, 6):
                above[k] += node[k]

    def rows(self) -> list[tuple]:
        while self.open:
            self._close()
        return [(depth, conv, None if above is None else self.nodes[above][1], self.parent if above is None else None,
                 *rest)
                for depth, conv, above, *rest in self.nodes]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], names)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted records of containers to nodes; one container's nodes are held at a time."""
    held, current, out = None, None, []
    for batch in batches:
        for key, ids, words, seq, parent, base, n, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if key != current:
                if held:
                    out += held.rows()
                held, current = _Container(base, parent), key
                if len(out) >= 10_000:
                    yield _table(out)
                    out = []
            held.add(ids, words, seq, n, conv)
    if held:
        out += held.rows()
    if out:
        yield _table(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """seq and the digest of its ids, sorted and joined by commas; only the running hash is kept."""
    current, digest = None, None
    for batch in batches:
        out = []
        for seq, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if seq != current:
                if digest:
                    out.append((current, digest.hexdigest()))
                current, digest = seq, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["seq", "several"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], ["seq", "several"])
