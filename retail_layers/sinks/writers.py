"""Table writers.

A sink is a mapping that names one of three targets: ``base_path`` alone (folders),
``base_path`` with ``catalog_db`` (external catalog tables) or ``jdbc`` (a warehouse).
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retail_layers.operators.columns import quoted
from retail_layers.sinks import published
from retail_layers.sources.readers import read_tsv

PASSWORD_VARIABLE = "WAREHOUSE_PASSWORD"


def sink_kind(sink: Mapping | None, where: str = "sink") -> str:
    """``folder``, ``catalog`` or ``jdbc``; anything else is an error."""
    if sink is None:
        raise ValueError(f"no {where} section")
    if "jdbc" in sink:
        return "jdbc"
    if "base_path" in sink:
        return "catalog" if "catalog_db" in sink else "folder"
    raise ValueError(f"{where} needs 'base_path' (with or without 'catalog_db') or 'jdbc'")


def jdbc_options(jdbc: Mapping, table: str) -> dict[str, str]:
    """Options of one JDBC write. The password comes from the environment, never from settings."""
    variable = jdbc.get("password_variable", PASSWORD_VARIABLE)
    if variable not in os.environ:
        raise ValueError(f"environment variable {variable} holds no password")
    options = {
        "url": jdbc["url"],
        "dbtable": f"{jdbc.get('schema', 'public')}.{jdbc.get('table_prefix', '')}{table}",
        "user": jdbc["user"],
        "password": os.environ[variable],
    }
    for extra in ("driver", "numPartitions", "batchsize"):
        if extra in jdbc:
            options[extra] = str(jdbc[extra])
    # any other option of the writer, such as truncate or isolationLevel; none replaces the above
    return {k: str(v) for k, v in jdbc.get("options", {}).items()} | options


def write_table(df: DataFrame, name: str, sink: Mapping) -> int:
    """Write one table and return its rows, counted by the writing tasks themselves.

    ``partition_by`` of the sink may name folder columns per table, ``compression`` the codec of
    Parquet (zstd unless given).
    """
    kind = sink_kind(sink)
    columns = sink.get("partition_by", {}).get(name, ()) if kind != "jdbc" else ()
    if columns:
        # rebalancing brings a folder's rows together, yet splits a large folder
        df = df.hint("rebalance", *columns)
    seen = Observation(f"rows of {name}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(sink.get("mode", "overwrite"))
    if kind == "jdbc":
        writer.format("jdbc").options(**jdbc_options(sink["jdbc"], name)).save()
        return seen.get["n"]
    form = sink.get("format", "parquet")
    writer = writer.format(form)
    if form == "parquet":
        writer = writer.option("compression", sink.get("compression", "zstd"))
    if columns:
        writer = writer.partitionBy(*columns)
    path = f"{sink['base_path'].rstrip('/')}/{name}"
    if kind == "folder":
        writer.save(path)
    else:
        writer.option("path", path).saveAsTable(
            f"{sink['catalog_db']}.{sink.get('table_prefix', '')}{name}")
    return seen.get["n"]


def write_tables(tables: Mapping[str, DataFrame], sink: Mapping, at_once: int = 4) -> dict[str, int]:
    """Write every table; rows per table.

    Up to ``at_once`` writes run side by side, so small tables fill the gaps that the
    last tasks of large ones leave.
    """
    sink_kind(sink)

    def write(item: tuple[str, DataFrame]) -> tuple[str, int]:
        name, df = item
        return name, write_table(df, name, sink)

    if not tables:
        return {}
    session = next(iter(tables.values())).sparkSession
    with ThreadPoolExecutor(max_workers=min(at_once, len(tables))) as pool:
        return dict(pool.map(inheritable_thread_target(session)(write), tables.items()))


def read_back(spark: SparkSession, tables: Mapping[str, DataFrame], sink: Mapping) -> dict[str, DataFrame]:
    """The tables of a folder or catalog sink as written, with the columns and types they
    were written with, whatever folders hold them and even when they are empty."""
    kind = sink_kind(sink)
    if kind == "jdbc":
        raise ValueError("a JDBC sink is not read back")
    if kind == "catalog":
        return {n: spark.table(f"{sink['catalog_db']}.{sink.get('table_prefix', '')}{n}") for n in tables}
    base, form = sink["base_path"].rstrip("/"), sink.get("format", "parquet")
    return {n: spark.read.format(form).schema(df.schema).load(f"{base}/{n}").select(*map(quoted, df.columns))
            for n, df in tables.items()}


def stored(spark: SparkSession, names: Sequence[str], sink: Mapping) -> dict[str, DataFrame]:
    """The named tables of a folder or catalog sink with whatever columns they have; those of
    the last published run where the sink is published by a switch."""
    sink = published.in_force(spark, sink)
    if sink_kind(sink) == "catalog":
        return {n: spark.table(f"{sink['catalog_db']}.{sink.get('table_prefix', '')}{n}") for n in names}
    reader, base = spark.read.format(sink.get("format", "parquet")), sink["base_path"].rstrip("/")
    return {n: reader.load(f"{base}/{n}") for n in names}


def tsv_to_parquet(spark: SparkSession, files: Mapping[str, str], base: str,
                   table_schemas: Mapping[str, str] | None = None, suffix: str = "_parquet",
                   at_once: int = 4) -> dict[str, int]:
    """Convert named tab-separated files to one Parquet folder each; rows per table."""
    known = table_schemas or {}
    frames = {f"{n}{suffix}": read_tsv(spark, p, known.get(n)) for n, p in files.items()}
    rows = write_tables(frames, {"base_path": base}, at_once)
    return {name[: -len(suffix)]: n for name, n in rows.items()}


def summary(tables: Mapping[str, DataFrame], rows: Mapping[str, int] | None = None) -> DataFrame:
    """One row per table: name, schema, number of rows.

    ``rows`` are counts that are known already, as writes report them; the other tables are
    counted.
    """
    known = rows or {}
    counts = []
    for name, df in tables.items():
        described = F.lit(name).alias("table_name"), F.lit(df.schema.simpleString()).alias("table_schema")
        if name in known:
            one = df.sparkSession.range(1).select(*described, F.lit(known[name]).cast("bigint").alias("row_count"))
        else:
            one = df.agg(F.count(F.lit(1)).alias("row_count")).select(*described, quoted("row_count"))
        counts.append(one)
    return reduce(DataFrame.unionByName, counts)
