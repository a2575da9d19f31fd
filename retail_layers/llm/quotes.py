"""Chat formatting by quotation links, in DataFrame functions only.

A line that begins with ``>`` marks is quoted, as deep as it has marks. Neighbouring lines of
one depth are a passage. Passages are normalised (lower case, only letters and digits, one
space between words) and hashed; so are the whole own text of every message and each of its
paragraphs and lines, and any run of its sentences (cut at line and sentence ends) that is as
long as some passage of the conversation. A passage is linked to the latest earlier message of its conversation
that has a unit of the same hash. A message answers the one its shallowest linked passage
comes from, and messages that answer one another are a thread. Sorting by conversation,
thread, depth of the answer and turn gives conversations in reply order without quotes.

Scale: only conversations with quotes are exploded; units meet by conversation and hash, so
one huge conversation spreads over tasks. Threads are found by shortening pointers, which
takes a number of rounds that grows with the logarithm of the longest chain of answers.

Defined cases: a missing text counts as empty; messages without a linked quote begin a thread
of their own; rows that share conversation and turn are kept apart, and a quote is linked to
their turn; a missing conversation or turn is linked with nothing. Extra columns are left
alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retail_layers.scratch import keep

QUOTED = r"^[\x20\t]*>"
MARKS = r"^((?:[\x20\t]*>)+)[\x20\t]?"
ATTRIBUTION = r"(?md)^[\x20\t]*(?:On\b.*\bwrote|[^\n>]{1,80}\bwrote)[\x20\t]*:[\x20\t]*$(?=\n[\x20\t\n]*>)"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def lines(text: Column) -> Column:
    """An array of (depth, text) per line; lines that announce a quote right below have depth -1."""
    def line(x: Column) -> Column:
        depth = F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", ""))
        return F.struct(F.when(x.startswith("\r"), -1).otherwise(depth).alias("depth"),
                        F.regexp_replace(x, MARKS, "").alias("text"))
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n")
    return F.transform(F.split(F.regexp_replace(plain, ATTRIBUTION, "\r$0"), "\n"), line)


def sentences(text: Column) -> Column:
    """The hashes of a text's lines, cut further at sentence ends."""
    parts = F.transform(F.split(text, r"\n|(?<=[.!?])\s+"), normalised)
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.xxhash64(x))


def own_text(parsed: Column) -> Column:
    """The message without quoted lines and their announcements."""
    kept = F.transform(F.filter(parsed, lambda x: x["depth"] == 0), lambda x: x["text"])
    return F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """conv, turn, at (first line), depth, hash, run (hash by sentences) of every quoted passage; messages has conv, turn, _row, parsed.

    A passage's lines are put together with the offset trick: among quoted lines of one depth,
    line number less rank is the same for neighbours.
    """
    rows = messages.select("conv", "turn", "_row", F.posexplode("parsed").alias("at", "line")).where("line.depth > 0")
    rank = F.row_number().over(Window.partitionBy("conv", "turn", "_row", "line.depth").orderBy("at"))
    return (
        rows.withColumn("_group", F.col("at") - rank)
        .groupBy("conv", "turn", "_row", F.col("line.depth").alias("depth"), "_group")
        .agg(F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "line.text"))).alias("held"))
        .withColumn("said", F.array_join(F.transform("held", lambda x: x["text"]), "\n"))
        .withColumn("words", normalised(F.col("said")))
        .where("words <> ''")
        .withColumn("run", sentences(F.col("said")))
        .select("conv", "turn", "_row", "at", "depth", F.xxhash64("words").alias("hash"), F.length("words").alias("size"),
                F.xxhash64("run").alias("run"), F.size("run").alias("n"))
    )


def units(messages: DataFrame) -> DataFrame:
    """conv, hash, size and source turn of everything a passage may quote."""
    whole = F.array("own")
    parts = F.concat(whole, F.split("own", r"\n\s*\n"), F.split("own", "\n"))
    return (
        messages.select("conv", F.col("turn").alias("source"), F.explode(F.array_distinct(F.transform(parts, normalised))).alias("words"))
        .where("words <> ''")
        .select("conv", "source", F.xxhash64("words").alias("hash"), F.length("words").alias("size")).distinct()
    )


def runs(messages: DataFrame, found: DataFrame) -> DataFrame:
    """conv, source turn, n and run (hash) of any ``n`` sentences in a row, for the ``n`` of the conversation's passages."""
    wanted = found.groupBy("conv").agg(F.collect_set("n").alias("wanted"))
    every = F.expr("""flatten(transform(filter(wanted, n -> n <= size(_said)), n ->
        transform(sequence(1, size(_said) - n + 1), i -> struct(n as n, xxhash64(slice(_said, i, n)) as run))))""")
    return (
        messages.select("conv", F.col("turn").alias("source"), sentences(F.col("own")).alias("_said")).join(wanted, "conv")
        .select("conv", "source", F.explode(every).alias("_run")).select("conv", "source", "_run.n", "_run.run").distinct()
    )


def link_quotes(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """Per row of ``conversations``: conv, turn, role, text (without quotes), quotes, deepest, linked,
    answers (turn), thread (first turn of its thread), depth (answers above it)."""
    role = F.col("role") if "role" in conversations.columns else F.lit(None).cast("string")
    rows = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), role.alias("role"),
        F.col(text).alias("_text"), F.xxhash64(text).alias("_row")).withColumn("parsed", lines(F.col("_text")))
    quoted = F.exists("parsed", lambda x: x["depth"] > 0)
    messages = rows.select("conv", "turn", "role", "_row", own_text(F.col("parsed")).alias("own"), "parsed", quoted.alias("_quoted"))
    quoting = messages.where(F.col("_quoted") & F.col("conv").isNotNull() & F.col("turn").isNotNull())
    found = keep(passages(quoting).distinct())
    asked = messages.where("turn is not null").join(found.select("conv").distinct(), "conv", "left_semi")
    key = ["conv", "turn", "_row", "at", "source"]
    hits = (
        found.join(units(asked), ["conv", "hash", "size"]).where("source < turn").select(*key)
        .unionByName(found.join(runs(asked, found), ["conv", "n", "run"]).where("source < turn").select(*key))
    )
    linked = keep(
        found.join(hits.groupBy("conv", "turn", "_row", "at").agg(F.max("source").alias("source")),
                   ["conv", "turn", "_row", "at"], "left")
        .groupBy("conv", "turn", "_row").agg(
            F.count(F.lit(1)).alias("quotes"), F.max("depth").alias("deepest"), F.count("source").alias("linked"),
            F.min_by("source", F.when(F.col("source").isNotNull(), F.struct("depth", "at"))).alias("answers")))
    threads = _threads(linked.where("answers is not null").groupBy("conv", "turn").agg(F.max("answers").alias("up")))
    return (
        messages.join(linked, ["conv", "turn", "_row"], "left").join(threads, ["conv", "turn"], "left")
        .select("conv", "turn", "role", F.col("own").alias("text"),
                *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("quotes", "deepest", "linked")], "answers",
                F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"))
    )


def _threads(answers: DataFrame) -> DataFrame:
    """conv, turn, thread, depth: the first turn above each answer, by shortening pointers."""
    pointers = keep(answers.select("conv", "turn", F.col("up").alias("thread"), F.lit(1).cast("bigint").alias("depth")))
    while True:
        above = pointers.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("_next"), F.col("depth").alias("_more"))
        joined = keep(pointers.join(above, ["conv", "thread"], "left"))
        pointers = joined.select("conv", "turn", F.coalesce("_next", "thread").alias("thread"),
                                 (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"))
        if joined.where("_next is not null").isEmpty():
            return pointers
