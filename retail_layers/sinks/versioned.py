"""Keyed tables on plain Parquet: insert once, upsert in batches, read the latest state.

A commit writes the partitions it touches, whole, under ``data/version=<n>`` and then
lists under ``versions/<n>`` which version holds each partition. The listing is written
last and counts once complete, so readers see all of a commit or none of it, a failed
commit leaves the table as it was, and partitions a batch does not touch are neither
read nor rewritten. The table's columns are stored with each version, so a batch that lacks
one changes nothing for readers. One writer at a time.

Which folders a reader opens is decided by a join with the listing, whose partitions Spark
prunes while the query runs; reading and writing pass no partition through the driver (only
``vacuum`` lists folders there, a version at a time). Rows are sorted by partition and key, and
Parquet keeps Bloom filters of the keys, so that looking up the keys of a small batch skips row
groups that cannot hold any of them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retail_layers.operators import upsert as merging
from retail_layers.operators.columns import quoted
from retail_layers.operators.skew import if_small
from retail_layers.scratch import keep
from retail_layers.sources import paths

SCOPES = ("partition", "table")
# A batch with up to this many keys is looked up by value, so that Bloom filters apply; a larger
# one by the range of its keys and a join. The rows are the same.
FEW_KEYS = 1_000
# Types whose smallest and largest value Parquet keeps in an order that Spark compares by.
RANGED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Types for which Parquet keeps Bloom filters and equality is pushed to the scan.
LISTED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


@dataclass(frozen=True)
class KeyedTable:
    """Where a keyed table lives and how its rows are identified and ordered.

    ``scope`` says where a key is looked for: in its own ``partition`` (the same key in
    another partition is another row) or in the whole ``table`` (a key may move). NULL keys
    are refused; a NULL partition value is a partition of its own. A table that may
    ``evolve`` takes columns it does not have and batches that lack some of its own.
    """

    path: str
    keys: tuple[str, ...]
    order_col: str
    partition_col: str
    scope: str = "partition"
    policy: str = "incoming_wins"
    evolve: bool = False

    def __post_init__(self) -> None:
        if self.scope not in SCOPES:
            raise ValueError(f"scope must be one of {SCOPES}, not {self.scope!r}")
        if self.policy not in merging.POLICIES:
            raise ValueError(f"policy must be one of {merging.POLICIES}, not {self.policy!r}")

    @property
    def identity(self) -> list[str]:
        return [*self.keys, self.partition_col] if self.scope == "partition" else [*self.keys]

    def insert(self, rows: DataFrame) -> int:
        """Start the table, replacing any earlier state; returns the version written."""
        rows = merging.refuse_missing(rows, self.keys)
        first = merging.precombine(rows, self.identity, self.order_col)
        return self._commit(first, None, self.version(rows.sparkSession) + 1)

    def upsert(self, batch: DataFrame) -> int:
        """Apply one batch; returns the version written, or the current one for no rows."""
        spark = batch.sparkSession
        current = self.version(spark)
        if current == 0:
            return self.insert(batch)
        empty = spark.createDataFrame([], self._schema(spark, current))
        _, batch = merging.aligned(empty, batch, self.evolve)
        batch = merging.refuse_missing(batch, self.keys)
        incoming = keep(merging.precombine(batch, self.identity, self.order_col))
        if incoming.isEmpty():
            return current
        touched = incoming.select(self._part())
        if self.scope == "table":
            held = self.snapshot(spark).where(self.may_hold(incoming)).select(*map(quoted, self.keys), self._part())
            moved = merging.matching(held, incoming.select(*map(quoted, self.keys)), self.keys, "left_semi")
            touched = touched.union(moved.select("_part"))
        touched = keep(touched.distinct())
        listing = self._listing(spark, current)
        same = listing["_part"].eqNullSafe(touched["_part"])
        before = self._rows(spark, listing.join(touched, same, "left_semi"), current)
        merged = merging.upsert(
            before, incoming, self.identity, self.order_col, self.policy, precombined=True,
            may_be_missing=(self.partition_col,), evolve=self.evolve)
        return self._commit(merged, listing.join(touched, same, "left_anti"), current + 1)

    def snapshot(self, spark: SparkSession, version: int | None = None, where: Column | None = None) -> DataFrame:
        """The rows as of the last, or the given, version.

        ``where`` is a condition on the partition column alone. It picks partitions from the
        listing, so folders of others are not opened; a partition column that is an instant
        is compared row by row instead, because its text depends on the session's zone.
        """
        at = self.version(spark) if version is None else version
        if not self._complete(spark, at):
            raise ValueError(f"no committed version{'' if version is None else f' {version}'} under {self.path}")
        listing = self._listing(spark, at)
        if where is None:
            return self._rows(spark, listing, at)
        kind = self._schema(spark, at)[self.partition_col].dataType
        if not isinstance(kind, T.TimestampType):
            value = F.when(F.col("_part") != "n", F.expr("substring(_part, 2)")).cast(kind)
            listing = listing.withColumn(self.partition_col, value).where(where).select("_part", "version")
        return self._rows(spark, listing, at).where(where)

    def may_hold(self, batch: DataFrame) -> Column:
        """A condition that every row of the table with a key of ``batch`` meets and that Spark
        pushes to the scan: each key column lies between the least and the greatest of the batch,
        and is one of its values where there are few (``FEW_KEYS``)."""
        kinds = {k: batch.schema[k].dataType for k in self.keys}
        listed = [k for k in self.keys if isinstance(kinds[k], LISTED)]
        few = batch.select(*map(quoted, listed)).limit(FEW_KEYS + 1).collect() if listed else []
        ranged = [k for k in self.keys if isinstance(kinds[k], RANGED)]
        met = [F.lit(True)]
        if ranged:
            ends = batch.agg(*[end(quoted(k)).alias(f"{i}{end.__name__}") for i, k in enumerate(ranged) for end in (F.min, F.max)]).first()
            met += [quoted(k).between(F.lit(ends[2 * i]).cast(kinds[k]), F.lit(ends[2 * i + 1]).cast(kinds[k]))
                    for i, k in enumerate(ranged)]
        if len(few) <= FEW_KEYS:
            met += [quoted(k).isin(sorted({row[i] for row in few})) for i, k in enumerate(listed)]
        return reduce(lambda a, b: a & b, met)

    def vacuum(self, spark: SparkSession, versions: int = 1) -> int:
        """Remove all but the last ``versions`` versions, and data that none of those names;
        returns the number of data folders removed.

        Old versions stop being readable first, then their data goes, then their listings,
        so a vacuum that was cut off is finished by the next one. Not to be run beside a writer
        or while an old version is being read.
        """
        if versions < 1:
            raise ValueError("the last version has to stay")
        numbers = self._numbers(spark, "versions")
        done = [n for n in numbers if self._complete(spark, n)]
        if not done:
            return 0
        kept, old = done[-versions:], [n for n in numbers if n < done[-versions:][0]]
        named = reduce(DataFrame.union, [self._listing(spark, n) for n in kept]).distinct()
        whole = {row["version"] for row in named.select("version").distinct().collect()}  # one number per version
        for n in old:
            paths.remove(spark, f"{self.path}/versions/{n}/_SUCCESS")
        gone = [n for n in self._numbers(spark, "data", "version=") if n not in whole]
        for n in gone:
            paths.remove(spark, f"{self.path}/data/version={n}")
        removed = len(gone)
        for n in sorted(whole):
            found = [(unquote(name.removeprefix("_part=")), path) for name, path in
                     paths.folders(spark, f"{self.path}/data/version={n}", "_part=*").items()]
            held = named.where(F.col("version") == n).select("_part")
            stale = spark.createDataFrame(found, "_part string, path string").join(held, "_part", "left_anti")
            removed += sum(paths.remove(spark, row["path"]) for row in stale.toLocalIterator())
        for n in old:
            paths.remove(spark, f"{self.path}/versions/{n}")
            paths.remove(spark, f"{self.path}/schemas/{n}")
        return removed

    def version(self, spark: SparkSession) -> int:
        """The last complete version, 0 when there is none."""
        return max((n for n in self._numbers(spark, "versions") if self._complete(spark, n)), default=0)

    def _numbers(self, spark: SparkSession, folder: str, mark: str = "") -> list[int]:
        names = [name.removeprefix(mark) for name in paths.folders(spark, f"{self.path}/{folder}", f"{mark}*")]
        return sorted(int(name) for name in names if name.isdigit())

    def _complete(self, spark: SparkSession, version: int) -> bool:
        return paths.exists(spark, f"{self.path}/versions/{version}/_SUCCESS")

    def _bloom_filters(self) -> dict[str, str]:
        """Writer options for Bloom filters of the keys, sized by the keys of each row group."""
        options = {"parquet.bloom.filter.adaptive.enabled": "true"}
        return options | {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.keys}

    def _part(self) -> Column:
        """The partition's folder name: text after a mark, so that NULL, blank and any text differ."""
        value = quoted(self.partition_col).cast("string")
        return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value)).alias("_part")

    def _listing(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.schema("_part string, version int").parquet(f"{self.path}/versions/{version}")

    def _schema(self, spark: SparkSession, version: int) -> T.StructType:
        """The table's columns as of a version."""
        return T.StructType.fromJson(json.loads(spark.read.text(f"{self.path}/schemas/{version}").first()[0]))

    def _rows(self, spark: SparkSession, listing: DataFrame, at: int) -> DataFrame:
        """The rows of the listed partitions with the columns of version ``at``.

        The join with the listing is on folder columns only and the listing is filtered, so
        Spark prunes folders by it before any file is opened.
        """
        folder = {"_part": "_part", "version": "version"}
        fields = self._schema(spark, at).fields
        schema = T.StructType([*fields, T.StructField("_part", T.StringType()), T.StructField("version", T.IntegerType())])
        rows = spark.read.schema(schema).parquet(f"{self.path}/data")
        wanted = if_small(listing.where(F.col("version") <= at).select(*[F.col(c).alias(f"_listed_{c}") for c in folder]))
        same = reduce(lambda a, b: a & b, [rows[c] == wanted[f"_listed_{c}"] for c in folder])
        return rows.join(wanted, same).select(*[quoted(f.name) for f in fields])

    def _commit(self, rows: DataFrame, rest: DataFrame | None, version: int) -> int:
        spark = rows.sparkSession
        folder = f"{self.path}/data/version={version}"
        # rebalancing brings a partition's rows together, yet splits a large partition
        (rows.withColumn("_part", self._part()).hint("rebalance", "_part").sortWithinPartitions("_part", *map(quoted, self.keys))
         .write.mode("overwrite").options(**self._bloom_filters()).partitionBy("_part").parquet(folder))
        # only folder names are asked for, so no column is read
        written = (spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.StringType())])).parquet(folder)
                   .select("_part", F.lit(version).alias("version")).distinct())
        if written.isEmpty():
            raise ValueError("no rows to commit")
        columns = json.dumps(rows.schema.jsonValue())
        spark.createDataFrame([(columns,)], "value string").write.mode("overwrite").text(f"{self.path}/schemas/{version}")
        listing = written if rest is None else written.unionByName(rest)
        listing.write.mode("overwrite").parquet(f"{self.path}/versions/{version}")
        return version
