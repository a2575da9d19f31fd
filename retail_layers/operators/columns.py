"""Column-wise cleaning and projection. Everything here is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_layers.functions import dates, numbers, text


def quoted(name: str) -> Column:
    """Column by its literal name, also when that holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def standardize_names(df: DataFrame) -> DataFrame:
    """Strip, lower-case and put ``_`` for spaces in every column name."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after standardizing: {clashes}")
    return df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.trimmed(quoted(c)) for c in string_columns(df)})


def blanks_to_null(df: DataFrame, cols: Sequence[str] | None = None,
                   tokens: Sequence[str] = ()) -> DataFrame:
    """``''`` (and any of ``tokens``) to NULL, in ``cols`` or in all string columns."""
    chosen = string_columns(df) if cols is None else cols
    return df.withColumns({c: text.blank_to_null(quoted(c), tokens) for c in chosen})


def stamp(df: DataFrame, run_ts: Column | datetime, col: str = "ingestion_ts") -> DataFrame:
    """Add the load time unless the table already carries one."""
    return df if col in df.columns else df.withColumn(col, dates.as_column(run_ts))


def generic_clean(df: DataFrame, run_ts: Column | datetime,
                  null_tokens: Sequence[str] = ()) -> DataFrame:
    return stamp(blanks_to_null(trim_strings(df), tokens=null_tokens), run_ts)


def clamp_negative(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Raise negatives to 0 and say so in ``<col>_was_negative``; absent columns are skipped."""
    found = [c for c in cols if c in df.columns]
    flags = {f"{c}_was_negative": numbers.is_negative(quoted(c)) for c in found}
    values = {c: numbers.floored_at_zero(quoted(c), df.schema[c].dataType) for c in found}
    return df.withColumns(flags | values) if found else df


def clip_range(df: DataFrame, col: str, low, high) -> DataFrame:
    if col not in df.columns:
        return df
    return df.withColumn(col, numbers.clipped(quoted(col), low, high, df.schema[col].dataType))


def cast_timestamps(df: DataFrame, *cols: str, zone: str | None = None) -> DataFrame:
    """Text and days to timestamps, those without an offset read in ``zone`` (the session's if None)."""
    found = [c for c in cols if c in df.columns]
    return df.withColumns(
        {c: dates.safe_timestamp(quoted(c), df.schema[c].dataType, zone) for c in found}
    ) if found else df


def wall_clocks(df: DataFrame, zone: str | None) -> Callable[[str], Column]:
    """Columns of ``df`` by name, instants as clocks in ``zone`` show them."""
    return lambda c: dates.wall_clock(quoted(c), df.schema[c].dataType, zone)


def cast_integers(df: DataFrame, *cols: str) -> DataFrame:
    found = [c for c in cols if c in df.columns]
    return df.withColumns(
        {c: numbers.safe_int(quoted(c), df.schema[c].dataType) for c in found}
    ) if found else df


def flag_in_set(df: DataFrame, col: str, allowed: Sequence[str], out: str) -> DataFrame:
    """Whether ``col`` is one of ``allowed``; NULL in, NULL out."""
    return df.withColumn(out, quoted(col).isin(list(allowed))) if col in df.columns else df


def parse_schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def project(df: DataFrame, ddl: str | T.StructType) -> DataFrame:
    """Exactly the declared columns in the declared order.

    Present columns keep their type; absent ones come out as NULLs of the declared type.
    """
    present = set(df.columns)
    return df.select(*[
        quoted(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in parse_schema(ddl).fields
    ])


def conform(df: DataFrame, ddl: str | T.StructType) -> DataFrame:
    """Cast the declared columns to the declared types; a value that does not fit is NULL.

    Columns the schema does not name stay as they are.
    """
    wanted = {f.name: f.dataType for f in parse_schema(ddl).fields}
    casts = {}
    for f in df.schema.fields:
        target = wanted.get(f.name, f.dataType)
        if target == f.dataType:
            continue
        source = quoted(f.name)
        # a boolean kept as 0/1 may arrive as text, which only casts by way of a number
        if isinstance(target, T.BooleanType) and isinstance(f.dataType, T.StringType):
            casts[f.name] = F.coalesce(source.try_cast("boolean"),
                                       source.try_cast("int").cast("boolean"))
        elif isinstance(target, T.IntegerType):
            casts[f.name] = numbers.safe_int(source, f.dataType)
        else:
            casts[f.name] = source.try_cast(target)
    return df.withColumns(casts) if casts else df


def digest(df: DataFrame, col: str) -> Column:
    """32 characters that stand for a long value, equal where the values are."""
    kind = df.schema[col].dataType
    return F.md5(quoted(col) if isinstance(kind, (T.StringType, T.BinaryType)) else F.to_json(quoted(col), {"ignoreNullFields": "false"}))


def sortable(df: DataFrame, col: str) -> Column:
    """``col`` as something Spark can order: maps and variants by their JSON text."""
    def orderable(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.StructType):
            return all(orderable(f.dataType) for f in dtype.fields)
        if isinstance(dtype, T.ArrayType):
            return orderable(dtype.elementType)
        return not isinstance(dtype, (T.MapType, T.VariantType))

    return quoted(col) if orderable(df.schema[col].dataType) else F.to_json(quoted(col))
