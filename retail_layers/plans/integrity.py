"""The declared constraints of the source tables, checked as Spark jobs.

The database enforced these; files do not. Checks whose tables or columns are not there
are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_layers.operators import quality
from retail_layers.operators.columns import parse_schema, quoted
from retail_layers.plans import schemas

# Names of the kinds of checks.
UNIQUE, REFERENCE, NOT_NULL = "unique", "reference", "not null"


def _has(tables: Mapping[str, DataFrame], name: str, *cols: str) -> bool:
    return name in tables and set(cols) <= set(tables[name].columns)


def _any_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with at least one of ``cols``; wholly missing keys are the other check's concern."""
    return df.where(reduce(lambda a, b: a | b, [quoted(c).isNotNull() for c in cols]))


def repeated_keys(tables: Mapping[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Per (table, columns) the primary and unique keys that occur more than once."""
    keys = [*schemas.PRIMARY_KEYS.items(), *((t, (c,)) for t, c in schemas.UNIQUE_COLUMNS.items())]
    return {(name, ", ".join(cols)): quality.duplicate_keys(_any_present(tables[name], cols), cols)
            for name, cols in keys if _has(tables, name, *cols)}


def broken_references(tables: Mapping[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Per (table, column) the references that no parent row answers."""
    found = {}
    for child, col, parent in schemas.REFERENCES:
        key = schemas.PRIMARY_KEYS[parent]
        if _has(tables, child, col) and _has(tables, parent, *key):
            found[child, col] = quality.orphans(tables[child], [col], tables[parent], key)
    return found


def missing_values(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Per table the number of NULLs in each column declared ``not null``, in one pass."""
    found = {}
    for name, ddl in schemas.RELATIONAL.items():
        if name in tables:
            needed = [f.name for f in parse_schema(ddl).fields
                      if not f.nullable and f.name in tables[name].columns]
            if needed:
                found[name] = quality.null_counts(tables[name], needed)
    return found


def key_checks(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(check, table, columns) of the declared keys and references that the tables at hand allow to check."""
    keys = [*schemas.PRIMARY_KEYS.items(), *((t, (c,)) for t, c in schemas.UNIQUE_COLUMNS.items())]
    found = [(UNIQUE, name, ", ".join(cols)) for name, cols in keys if _has(tables, name, *cols)]
    return found + [(REFERENCE, child, col) for child, col, parent in schemas.REFERENCES
                    if _has(tables, child, col) and _has(tables, parent, *schemas.PRIMARY_KEYS[parent])]


def _entries(name: str, df: DataFrame, wanted: Sequence[tuple[str, str, str]]) -> DataFrame | None:
    """What the rows of one table have to say to all checks: number of the check, key, rows, known."""
    parents = {(child, col): parent for child, col, parent in schemas.REFERENCES}
    found = []

    def say(number: int, cols: Sequence[str], rows: int, known: bool) -> None:
        present = reduce(lambda a, b: a | b, [quoted(c).isNotNull() for c in cols])
        found.append(F.struct(F.lit(number).alias("number"), F.when(present, _key(cols)).alias("key"),
                              F.lit(rows).cast("bigint").alias("rows"), F.lit(known).alias("known")))

    for number, (check, table, cols) in enumerate(wanted):
        if table == name:
            say(number, cols.split(", "), 1, False)
        if check == REFERENCE and parents[table, cols] == name:
            say(number, schemas.PRIMARY_KEYS[name], 0, True)
    return df.select(F.inline(F.array(*found))).where(F.col("key").isNotNull()) if found else None


def _key(names: Sequence[str]) -> Column:
    """One text per key: the value's own for one column, JSON for several."""
    return quoted(names[0]).cast("string") if len(names) == 1 else F.to_json(F.struct(*map(quoted, names)))


def report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: what it is, on which table and columns, how many violations.

    Violations are repeated keys, child rows without a parent, and missing values. Every
    table is read twice: once its rows tell their keys and references to all checks, as
    children and as parents, and one count per check and key brings them together; once
    its missing values are counted. Counts start on the map side, so a key that many rows
    share travels as one row per task.
    """
    wanted = key_checks(tables)
    told = [e for e in (_entries(name, df, wanted) for name, df in tables.items()) if e is not None]
    missing = [df.select(F.lit(NOT_NULL).alias("check"), F.lit(n).alias("table_name"), F.col("column_name").alias("column_names"),
                         F.col("null_rows").alias("violations")) for n, df in missing_values(tables).items()]
    if not told:
        if not missing:
            raise ValueError("none of the declared tables is there to check")
        return reduce(DataFrame.unionByName, missing)
    per_key = reduce(DataFrame.unionByName, told).groupBy("number", "key").agg(
        F.sum("rows").alias("rows"), F.max("known").alias("known"))
    spark = told[0].sparkSession
    named = spark.createDataFrame([(k, *check) for k, check in enumerate(wanted)], "number int, check string, table_name string, column_names string")
    unique = [k for k, (check, _, _) in enumerate(wanted) if check == UNIQUE]
    rows = F.col("rows")
    violations = F.when(F.col("number").isin(unique), (rows > 1).cast("bigint")).when(~F.col("known"), rows).otherwise(0)
    totals = per_key.groupBy("number").agg(F.sum(violations).alias("violations"))
    keys = named.join(totals, "number", "left").select(
        "check", "table_name", "column_names", F.coalesce("violations", F.lit(0)).alias("violations"))
    return reduce(DataFrame.unionByName, [keys, *missing])
