"""Keyed state in increments: a version holds the keys that changed, and a read merges versions."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.operators.jumping import tagged
from wattledger.session import children, discard, exists

#: The key as text that is never NULL, by which the files are bucketed.
KEY = "_key"


@dataclass(frozen=True)
class Saved:
    """The rows of a state at one version: bucketed tables, the newest first, of which the first that has a key counts.

    `keep` is a condition on a row; a row that does not meet it counts as missing.
    """

    tables: tuple[DataFrame, ...]
    folders: tuple[str, ...]
    schema: T.StructType
    key: str
    buckets: int
    keep: Column | None = None

    def tag(self, key: str) -> Column:
        """A key as the state has it."""
        return tagged(F.col(key))

    def placed(self, df: DataFrame, key: str, name: str = KEY) -> DataFrame:
        """Add the key as text and put rows where the state's rows of their key lie."""
        return df.withColumn(name, self.tag(key)).repartition(self.buckets, name)

    def joined(self, df: DataFrame, name: str, by: str = KEY) -> DataFrame:
        """Add the saved row of a key as a struct. Where `df` is `placed` no table is shuffled, nor `df` again."""
        values = []
        for i, table in enumerate(self.tables):
            row = F.struct(*self.schema.names)
            if self.keep is not None:
                # An older row of the key must not come up in its place.
                row = F.struct(row.alias("row"), self.keep.alias("kept"))
            part = table.select(F.col(KEY).alias(f"_by{i}"), row.alias(f"_saved{i}"))
            df = df.join(part, F.col(by) == F.col(f"_by{i}"), "left").drop(f"_by{i}")
            values.append(F.col(f"_saved{i}"))
        found = F.coalesce(*values)
        if self.keep is not None:
            found = F.when(found["kept"], found["row"])
        return df.withColumn(name, found).drop(*[f"_saved{i}" for i in range(len(values))])

    def read(self) -> DataFrame:
        """All rows, merged in one shuffle by the buckets."""
        merged = _merged(self.tables[0].sparkSession, self.folders, self.schema, self.buckets)
        return (merged if self.keep is None else merged.where(self.keep)).select(*self.schema.names)


def _merged(spark: SparkSession, folders: tuple[str, ...], schema: T.StructType, buckets: int) -> DataFrame:
    # Read as plain files: a union of bucketed scans is not merged rightly by Spark 4.1 in every plan.
    stored = T.StructType([*schema.fields, T.StructField(KEY, T.StringType())])
    rows = None
    for age, folder in enumerate(folders):
        part = spark.read.schema(stored).parquet(folder).withColumn("_age", F.lit(-age))
        rows = part if rows is None else rows.unionByName(part)
    row = F.max_by(F.struct(*schema.names), F.col("_age")).alias("_row")
    return rows.repartition(buckets, KEY).groupBy(KEY).agg(row).select("_row.*", KEY)


@dataclass(frozen=True)
class Increments:
    """A state under `path`: one row per key, of which version n, counted from 0, holds those that run n has changed.

    Every `fanout` versions are merged into one folder, every `fanout` such folders into a larger one, and so on. So N runs
    leave at most (fanout - 1) * log(N) folders to read, and a row is rewritten at most log(N) times, however large
    the state is. Folders that a merge replaces are deleted by `tidy`, once the merging run cannot be repeated.
    `buckets` may change between runs; until the older folders have been merged, joins with them shuffle.
    """

    path: str
    schema: T.StructType
    key: str
    buckets: int = 64
    fanout: int = 4

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/{first}-{last}-{self.buckets}"

    def _complete(self, spark: SparkSession) -> dict[tuple[int, int], tuple[str, int]]:
        """Folders and their numbers of buckets, by the first and the last version they hold."""
        found = {}
        for name in children(spark, self.path):
            first, last, buckets = map(int, name.split("-"))
            if exists(spark, f"{self.path}/{name}/_SUCCESS"):
                found[first, last] = (f"{self.path}/{name}", buckets)
        return found

    def _cover(self, spark: SparkSession, first: int, last: int) -> list[tuple[str, int]]:
        """Fewest folders that hold these versions, the newest first."""
        folders, picked, at = self._complete(spark), [], first
        while at <= last:
            ends = [b for a, b in folders if a == at and b <= last]
            if not ends:
                raise ValueError(f"{self.path} has no state of run {at}")
            picked.append(folders[at, max(ends)])
            at = max(ends) + 1
        return picked[::-1]

    def _bucketed(self, spark: SparkSession, folder: str, buckets: int) -> DataFrame:
        # Only a catalog table knows its buckets; its name is needed no longer than until the scan is resolved.
        name = f"state_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema)
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"create table {name} ({columns}, {KEY} string) using parquet "
            f"clustered by ({KEY}) into {buckets} buckets location '{place}'"
        )
        try:
            return spark.table(name)
        finally:
            spark.sql(f"drop table {name}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        spark, name = rows.sparkSession, f"state_{uuid.uuid4().hex}"
        discard(spark, [folder])
        placed = rows.repartition(self.buckets, KEY)
        placed.write.format("parquet").bucketBy(self.buckets, KEY).option("path", folder).saveAsTable(name)
        spark.sql(f"drop table {name}")

    def put(self, changed: DataFrame, version: int, keep: Column | None = None) -> None:
        """Write the changed rows, one per key, and merge what is due. Rows that do not meet `keep` may be left out.

        Putting the last version again replaces it.
        """
        spark = changed.sparkSession
        discard(spark, [f for (_, last), (f, _) in self._complete(spark).items() if last >= version])
        rows = changed.select(*self.schema.names).withColumn(KEY, tagged(F.col(self.key)))
        self._write(rows, self._folder(version, version))
        span = 1
        while (version + 1) % (span * self.fanout) == 0:
            span *= self.fanout
        if span == 1:
            return
        first = version + 1 - span
        folders = tuple(f for f, _ in self._cover(spark, first, version))
        merged = _merged(spark, folders, self.schema, self.buckets)
        self._write(merged if keep is None else merged.where(keep), self._folder(first, version))

    def at(self, spark: SparkSession, version: int, keep: Column | None = None) -> Saved:
        """The state after a version."""
        cover = self._cover(spark, 0, version)
        tables = tuple(self._bucketed(spark, *part) for part in cover)
        # The oldest folder is the largest, so rows are placed by its buckets.
        return Saved(tables, tuple(f for f, _ in cover), self.schema, self.key, cover[-1][1], keep)

    def tidy(self, spark: SparkSession, version: int) -> None:
        """Delete the folders that are not needed to read this version or later ones."""
        needed = {f for f, _ in self._cover(spark, 0, version)}
        old = [f for (_, last), (f, _) in self._complete(spark).items() if last <= version and f not in needed]
        discard(spark, old)
