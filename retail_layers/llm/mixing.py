"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Slot i of the schedule belongs to the source whose stretch of cumulative targets holds the
point frac(i * golden ratio), so any run of slots is close to the targets. The slots of a
source are ranked; the source's documents, in an order shuffled by a hash of their id, are
cut into blocks of equal words, and rank r takes block r modulo the number of blocks.

Scale: a block holds the words of all sources over ``slots``, at least one. A source whose size
or target is below ``slots / SHARE`` such blocks has smaller blocks of its own and as many more
slots, so the schedule has about ``slots`` slots and at most a few ``slots / SHARE`` more for every
such source, and a source's error is a few blocks of its own at any size of the input. Places within a source are prefix sums
over small hash ranges of the shuffled order, so a source with a third of all rows spreads
over many tasks. Only the table of sources is sorted in one task.

Defined cases: a missing text has size 0 and takes nothing; a missing source is a source of
its own, the last one; rows repeated in the input are documents of their own; without words
every target is 0. Extra columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.scratch import keep

# Weights by place of the source, the most a source may be repeated, a word.
WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 0.6180339887498949
SLOTS = 1 << 20
SHARE = 1024
CELLS = 4096
RANGE_ROWS = 512


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the place in the shuffled order; kept."""
    return keep(documents.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_hash")))


def targets(sized: DataFrame) -> DataFrame:
    """Per source: place, source_size, target, and its stretch [lo, hi) of the unit line; kept.

    A source is filled by weight up to ``MOST`` times its size; sorted by how soon they are
    full, the level all others reach is the highest one that leaving out the full ones gives.
    """
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_full = Window.orderBy("_full_at", "place")
    before = by_full.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_full.rowsBetween(0, Window.unboundedFollowing)
    in_order = Window.orderBy("place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * MOST)
        .withColumn("_full_at", F.col("_cap") / F.col("_weight"))
        .withColumn("_all", F.sum("source_size").over(every))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                    / F.sum("_weight").over(onwards))
        .withColumn("_level", F.max("_level").over(every))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_level")))
        .withColumn("_sum", F.sum("target").over(every))
        .withColumn("hi", F.try_divide(F.sum("target").over(in_order.rowsBetween(Window.unboundedPreceding, 0)), F.col("_sum")))
        .withColumn("lo", F.coalesce(F.lag("hi").over(in_order), F.lit(0.0)))
    )
    return keep(rows.select("source", "place", "source_size", "target", "lo", "hi", F.col("_all").alias("all_size")))


def schedule(goals: DataFrame, slots: int = SLOTS) -> DataFrame:
    """slot, place (of the source) and block: which block of which source comes when."""
    spark = goals.sparkSession
    cut = blocked(goals, slots)
    words, block = block_words(goals, slots)
    more = cut.where(F.col("_block") < block).agg(F.sum(F.col("_weight") - F.col("target"))).first()[0] or 0
    points = spark.range(1, (-(-words // block) + math.ceil(more / block) if words else 0) + 1).select(
        F.col("id").alias("slot"), (F.col("id") * F.lit(GOLDEN) % 1).alias("_point"))
    filled = cut.where("hi > lo")
    stretches = filled.select("place", "lo", "hi", F.ceil(F.col("source_size") / F.col("_block")).alias("_blocks"), F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("_cell"))
    placed = (
        points.withColumn("_cell", F.floor(F.col("_point") * CELLS)).join(stretches, "_cell")
        .where((F.col("_point") >= F.col("lo")) & (F.col("_point") < F.col("hi")))
        .withColumn("_range", F.floor(F.col("slot") / RANGE_ROWS))
    )
    ranked = running(placed.withColumn("_one", F.lit(1).cast("bigint")), "_one", ["slot"])
    return (
        ranked.where(F.col("_start") < F.col("_blocks") * MOST)
        .select("slot", "place", (F.col("_start") % F.col("_blocks")).alias("block"))
    )


def blocked(goals: DataFrame, slots: int) -> DataFrame:
    """``goals`` with the words of a block of each source, and stretches as long as its slots need."""
    _, block = block_words(goals, slots)
    in_order = Window.orderBy("place")
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.floor(F.least("target", F.col("source_size").cast("double")) / max(1, slots // SHARE))
    return (
        goals.withColumn("_block", F.greatest(F.lit(1), F.least(F.lit(block), own)).cast("bigint"))
        .withColumn("_weight", F.when(F.col("_block") == block, F.col("target")).otherwise(F.col("target") * block / F.col("_block")))
        .withColumn("hi", F.try_divide(F.sum("_weight").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
                                       F.sum("_weight").over(every)))
        .withColumn("lo", F.coalesce(F.lag("hi").over(in_order), F.lit(0.0)))
    )


def block_words(goals: DataFrame, slots: int) -> tuple[int, int]:
    """All words, and the words of a block of a source that needs no smaller ones."""
    row = goals.agg(F.max("all_size")).first()
    words = int(row[0] or 0)
    return words, max(1, -(-words // slots))


def running(rows: DataFrame, value: str, order: list[str]) -> DataFrame:
    """``_start``: the sum of ``value`` over earlier rows of the same place.

    ``_range`` has to grow with the order. Sums within a range and sums of whole ranges are
    taken apart, so a place of any size is spread.
    """
    within = Window.partitionBy("place", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("place").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("place", "_range").agg(F.sum(value).alias("_sum"))
        .select("place", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        rows.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, ["place", "_range"])
        .withColumn("_start", F.col("_inner") + F.col("_offset"))
    )


def placed_documents(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """Every document with its source's goal and its first word's place in the shuffled source."""
    ranges = max(1, sized.count() // RANGE_ROWS)
    by = goals.select(F.col("source").alias("_source"), "place", "source_size", "target", "_block")
    rows = (
        sized.join(by, sized["source"].eqNullSafe(by["_source"]))
        .withColumn("_range", F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") * ranges / (1 << 32)))
    )
    return running(rows, "size", ["_hash", "doc_id", "size"])


def mix(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words taken, repeats counted)."""
    sized = sizes(documents)
    goals = targets(sized)
    cut, block = blocked(goals, slots), F.col("_block")
    times = schedule(goals, slots).groupBy("place", "block").agg(F.count(F.lit(1)).alias("_times"))
    end = F.col("_start") + F.col("size")
    blocks = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("_start") / block), F.floor((end - 1) / block)))
    pieces = (
        placed_documents(sized, cut)
        .select("doc_id", "source", "size", "source_size", "target", "place", "_start", "_block", F.explode_outer(blocks).alias("block"))
        .withColumn("_words", F.least((F.col("block") + 1) * block, end) - F.greatest(F.col("block") * block, F.col("_start")))
    )
    taken = F.coalesce(F.sum(F.col("_words") * F.coalesce("_times", F.lit(0))), F.lit(0)).cast("bigint")
    key = ["doc_id", "source", "size", "source_size", "target", "place", "_start"]
    # documents without words may share a place, so they pass by the sums
    some = pieces.where("size > 0").join(times, ["place", "block"], "left").groupBy(*key).agg(taken.alias("taken"))
    none = pieces.where("size = 0").select(*key, F.lit(0).cast("bigint").alias("taken"))
    return some.unionByName(none).select("doc_id", "source", "size", "source_size", "target", "taken")
