"""Source scans. All listing goes through Hadoop file systems, so any URI Spark reads works."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_layers.operators.columns import cast_timestamps, conform, parse_schema, quoted
from retail_layers.plans import schemas
from retail_layers.scratch import keep
from retail_layers.sources import paths

REJECT = "_rejected_record"


def discover_parquet(spark: SparkSession, base: str, suffix: str = "_parquet") -> dict[str, str]:
    """Table name to folder for every ``<name><suffix>`` folder under ``base``."""
    if not paths.exists(spark, base):
        raise FileNotFoundError(f"no such source folder: {base}")
    found = {name[: -len(suffix)]: path for name, path in paths.folders(spark, base, f"*{suffix}").items()}
    if not found:
        warnings.warn(f"no folder under {base} ends in {suffix!r}", stacklevel=2)
    return found


def read_parquet_tables(spark: SparkSession, base: str, suffix: str = "_parquet",
                        table_schemas: Mapping[str, str] = schemas.RELATIONAL,
                        required: Iterable[str] = (),
                        names: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Every discovered folder as a table of its declared types.

    ``names`` maps folder names to table names where an export spells them differently;
    a table of ``required`` that is not there is an error.
    """
    aliases = names or {}
    tables = {}
    for found, path in discover_parquet(spark, base, suffix).items():
        name = aliases.get(found, found)
        if name in tables:
            raise ValueError(f"two folders under {base} are table {name!r}")
        df = spark.read.parquet(path)
        tables[name] = conform(df, table_schemas[name]) if name in table_schemas else df
    missing = sorted(set(required) - tables.keys())
    if missing:
        raise ValueError(f"required tables missing under {base}: {missing}")
    return tables


def read_json(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
              multi_line: bool = True, malformed: str = "fail", zone: str | None = None) -> DataFrame:
    """A JSON feed: arrays over many lines, or one object per line (``multi_line=False``).

    A record that is no JSON of the schema is an error; with ``malformed="reject"`` it is
    left out, to be had from ``json_rejects``.

    Spark cannot split a file with an array in it; a feed that grows large should arrive
    as many files or as one object per line.

    Timestamps of the schema that carry no offset are read in ``zone``, or in the session's.
    """
    if malformed not in ("fail", "reject"):
        raise ValueError(f"malformed must be fail or reject, not {malformed!r}")
    if malformed == "reject" and schema is None:
        raise ValueError("without a schema no record is known to be malformed")
    if malformed == "reject":
        found = _with_rejects(spark, path, schema, multi_line, zone)
        # Spark refuses to filter on the rejected text alone, so the filter names another column too
        also = F.hash(quoted(found.columns[0])) >= F.lit(-(1 << 31))
        return found.where(F.col(REJECT).isNull() & also).drop(REJECT)
    reader = _in_zone(spark.read, zone).option("multiLine", multi_line).option("mode", "FAILFAST" if malformed == "fail" else "DROPMALFORMED")
    return (reader if schema is None else reader.schema(schema)).json(path)


def json_rejects(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True) -> DataFrame:
    """The records of a feed that are no JSON of ``schema``, as text in column ``record``."""
    return keep(_with_rejects(spark, path, schema, multi_line).where(F.col(REJECT).isNotNull())).select(F.col(REJECT).alias("record"))


def _in_zone(reader: DataFrameReader, zone: str | None) -> DataFrameReader:
    return reader if zone is None else reader.option("timeZone", zone)


def _with_rejects(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool,
                  zone: str | None = None) -> DataFrame:
    declared = T.StructType([*parse_schema(schema).fields, T.StructField(REJECT, T.StringType())])
    return (_in_zone(spark.read, zone).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", REJECT).schema(declared).json(path))


def read_json_feeds(spark: SparkSession, base: str, files: Mapping[str, str],
                    feed_schemas: Mapping[str, str] = schemas.JSON_FEEDS,
                    multi_line: bool = True, malformed: str = "fail",
                    zone: str | None = None) -> dict[str, DataFrame]:
    """The feeds named in ``files`` (feed to path under ``base``); others are left out.

    A name without a schema is an error, as it would otherwise be left out without a word.
    """
    unknown = sorted(set(files) - set(feed_schemas))
    if unknown:
        raise ValueError(f"unknown feeds: {unknown}")
    return {
        name: read_json(spark, f"{base.rstrip('/')}/{files[name]}", schema, multi_line, malformed, zone)
        for name, schema in feed_schemas.items() if name in files
    }


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             malformed: str = "keep", zone: str | None = None) -> DataFrame:
    """Tab-separated text with a header; empty fields are NULL.

    With a schema the header has to name its columns in order, and 0/1 flags become
    booleans; without one the types are inferred by an extra pass over the data. Rows
    with missing or surplus fields, or values of another type, are kept as far as they can
    be read; with ``malformed="reject"`` they are left out, to be had from ``tsv_rejects``.
    A line of nothing but tabs and spaces is no row. Timestamps without an offset are read
    in ``zone``, or in the session's.
    """
    if malformed not in ("keep", "reject"):
        raise ValueError(f"malformed must be keep or reject, not {malformed!r}")
    if malformed == "reject":
        if schema is None:
            raise ValueError("without a schema no row is known to be malformed")
        found = _tsv_with_rejects(spark, path, schema, zone)
        also = F.hash(quoted(found.columns[0])) >= F.lit(-(1 << 31))  # as in read_json
        return found.where(F.col(REJECT).isNull() & also).drop(REJECT)
    reader = _in_zone(_tsv(spark), zone)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    declared = parse_schema(schema)
    return conform(reader.option("enforceSchema", False).schema(_as_text_flags(declared)).csv(path), declared)


def tsv_rejects(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The rows that ``read_tsv`` leaves out as malformed, as text in column ``record``."""
    return keep(_tsv_with_rejects(spark, path, schema).where(F.col(REJECT).isNotNull())).select(F.col(REJECT).alias("record"))


def _tsv(spark: SparkSession):
    return spark.read.option("header", True).option("sep", "\t").option("nullValue", "")


def _tsv_with_rejects(spark: SparkSession, path: str, schema: str | T.StructType,
                      zone: str | None = None) -> DataFrame:
    declared = parse_schema(schema)
    as_read = T.StructType([*_as_text_flags(declared).fields, T.StructField(REJECT, T.StringType())])
    # every field is parsed whatever columns are asked for, so that the same rows are malformed each time
    found = (_in_zone(_tsv(spark), zone).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECT).option("columnPruning", False)
             .option("enforceSchema", False).schema(as_read).csv(path))
    return conform(found, declared)


def _as_text_flags(declared: T.StructType) -> T.StructType:
    """The CSV reader knows only true/false, so flags are read as text and cast after."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BooleanType) else f.dataType)
        for f in declared.fields
    ])


def from_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str],
              timestamps: Sequence[str] = (), days: Sequence[str] = (), zone: str | None = None) -> DataFrame:
    """A small typed frame from literals, with text columns cast to timestamps and dates."""
    df = cast_timestamps(spark.createDataFrame(rows, list(columns)), *timestamps, zone=zone)
    return df.withColumns({c: F.col(c).try_cast("date") for c in days}) if days else df


def catalog(*sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One set of tables from several; the later source wins where names repeat."""
    merged: dict[str, DataFrame] = {}
    for source in sources:
        merged |= source
    return merged
