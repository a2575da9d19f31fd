"""The operators bound to the given tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_layers.llm import balltree, debruijn, decontaminate, language, mixing, neardup, neighbours, pages, quality, quotes, repeats, secrets, sql, trie
from retail_layers.llm.common import held_out, table


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    return (
        documents.select("doc_id", held_out("doc_id").alias("held_out"), quality.score(F.col("text"), model).alias("score"))
        .withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = documents.select("doc_id", held_out("doc_id").alias("held_out"),
                             language.identify(F.col("text"), language.train(documents)).alias("_l"))
    return found.select("doc_id", "held_out", "_l.lang_pred", "_l.score", "_l.ambiguous")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = documents.select("doc_id", secrets.find(F.col("text")).alias("_f"))
    return found.select("doc_id", "_f.n_assign", "_f.n_access", "_f.n_hex",
                        F.sha2("_f.base", 256).alias("base_sha256"), "_f.spans")


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    marked = decontaminate.mark(documents.select("doc_id", "text"), benchmark, "_m")
    return marked.select(
        "doc_id", "_m.n_words", "_m.n_hit", F.size("_m.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_m.items", ","), 256).alias("items_sha256"), (F.col("_m.n_hit") > 0).alias("contaminated"))


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = debruijn.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie.trie(trie.rebuilt(trie.sequences(table(spark, sf_dir, "conversations"))))
    return nodes.drop("last_turn")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_neighbours, op2_quotes, op3_repeats, op4_pages, op5_quality, op6_language, op7_mixing, op8_secrets, op9_neardup, op10_decontamination,
                              op11_passages, op12_ranked, op13_trie)
}
ORACLE: dict[str, str] = {"op3_repeats": sql.REPEATS, "op7_mixing": sql.MIXING, "op8_secrets": sql.SECRETS,
                          "op9_neardup": sql.NEARDUP, "op10_decontamination": sql.DECONTAMINATION,
                          "op11_passages": sql.PASSAGES, "op12_ranked": sql.RANKED, "op13_trie": sql.TRIE}
