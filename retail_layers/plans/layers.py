"""Whole runs: sources to silver to gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession

from retail_layers.operators.skew import MAX_GROUP_ROWS
from retail_layers.plans import clean, enrich, marts, star
from retail_layers.plans.clean import MAX_REVIEW_CHARS
from retail_layers.sinks import published
from retail_layers.sinks.writers import read_back, sink_kind, write_tables
from retail_layers.sources import readers
from retail_layers.sources.settings import required


def read_sources(spark: SparkSession, settings: Mapping, zone: str | None = None) -> dict[str, DataFrame]:
    """The tables of the ``relational`` and ``feeds`` sections as one catalog.
    Typed timestamps of feeds are read in ``zone`` where they carry no offset."""
    relational = required(settings, "relational", "settings")
    feeds = required(settings, "feeds", "settings")
    return readers.catalog(
        readers.read_parquet_tables(
            spark, required(relational, "base_path", "relational"),
            relational.get("suffix", "_parquet"), required=relational.get("required", ()),
            names=relational.get("names")),
        readers.read_json_feeds(spark, required(feeds, "base_path", "feeds"),
                                feeds.get("files", {}), multi_line=feeds.get("multi_line", True),
                                malformed=feeds.get("malformed", "fail"), zone=zone),
    )


def build_layers(tables: Mapping[str, DataFrame], as_of: Column | date, run_ts: Column | datetime,
                 null_tokens: Sequence[str] = (), max_group_rows: int = MAX_GROUP_ROWS,
                 zone: str | None = None) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Silver and gold of ``tables`` as frames that no sink has been given yet.

    Text without an offset is read, and days are cut, in ``zone``; without one both follow
    the session's time zone.

    Large groups are looked for while the plan is built, so jobs run and their rows are kept
    in the shared folder.
    """
    cleaned = clean.clean_tables(tables, run_ts, null_tokens, zone=zone)
    silver = star.build_star(enrich.enrich_tables(cleaned, as_of, tables, max_group_rows, zone),
                             max_group_rows, tables, zone=zone)
    return silver, marts.build_marts(silver, unique_orders=True, zone=zone)


def run(spark: SparkSession, settings: Mapping, as_of: Column | date, run_ts: Column | datetime,
        null_tokens: Sequence[str] = (), max_group_rows: int = MAX_GROUP_ROWS,
        rare_duplicates: bool = True, zone: str = "UTC",
        max_review_chars: int | None = MAX_REVIEW_CHARS, typed_keys: bool = False) -> dict[str, int]:
    """Read, clean, enrich, write silver, write gold; rows written per table.

    Silver is written in two steps and read back in between: tables that need
    ``fact_orders`` or ``dim_product``, and then the marts, scan what was written. Each
    stage therefore runs once, and gold always agrees with the silver on storage.

    Text without an offset is read, and days are cut, in ``zone``, whatever the session's
    time zone is; that one is left alone. ``max_review_chars`` cuts the texts of reviews
    (None: not at all); ``typed_keys`` turns the feeds' text keys into numbers.

    Sinks with ``publish`` get a folder for each run. Silver and gold are put in force when
    all tables of both are written, so a run that fails leaves the one before readable.
    """
    silver_sink = required(settings, "silver", "settings")
    gold_sink = required(settings, "gold", "settings")
    if sink_kind(silver_sink, "silver") == "jdbc":
        raise ValueError("silver is read back for gold and so needs a folder or catalog sink")
    sink_kind(gold_sink, "gold")
    switched = [sink for sink in (silver_sink, gold_sink) if published.is_published(sink)]
    staged = [published.staged(spark, sink) for sink in switched]
    silver_sink, gold_sink = (staged[switched.index(sink)] if sink in switched else sink for sink in (silver_sink, gold_sink))
    tables = read_sources(spark, settings, zone)
    cleaned = clean.clean_tables(tables, run_ts, null_tokens, rare_duplicates, max_review_chars, zone=zone)
    enriched = enrich.enrich_tables(cleaned, as_of, tables, max_group_rows, zone)

    base = star.base_tables(enriched, typed_keys, zone)
    rows = write_tables(base, silver_sink)
    written = read_back(spark, base, silver_sink)
    dependent = star.dependent_tables(enriched, written, max_group_rows, tables, zone)
    rows |= write_tables(dependent, silver_sink)
    written |= read_back(spark, dependent, silver_sink)
    rows |= write_tables(marts.build_marts(written, True, zone, max_group_rows), gold_sink)
    for sink, run_sink in zip(switched, staged):
        published.publish(spark, sink, run_sink)
    return rows
