"""A table in which a later row of a key replaces the earlier one, on plain files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.session import children, discard, exists

_BUCKET, _VERSION, _ROW = "bucket", "_version", "_row"


@dataclass(frozen=True)
class KeyedTable:
    """Rows by `key` in `buckets` hash buckets under `path`.

    A put writes only its own rows, to a folder of its version; putting a version again replaces it, so a repeated
    micro-batch adds nothing. A read merges versions: of a key the row of the latest one counts. `compact` merges
    what has been put into a base, from which later reads start. Versions are put in ascending order.
    """

    path: str
    key: str
    buckets: int = 64

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, folder: str) -> None:
        # One shuffle by bucket; REBALANCE splits a bucket that is too large for one file.
        rows = rows.withColumn(_BUCKET, self._bucket(F.col(self.key))).hint("rebalance", _BUCKET)
        rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")

    def put(self, rows: DataFrame, version: int, order: tuple[str, ...] = ()) -> None:
        """Put one row per key; of several the last by `order` counts, or else the greatest. `order` is not kept."""
        kept = [c for c in rows.columns if c not in order]
        last = F.max(F.struct(*order, F.struct(*kept).alias(_ROW))).alias("_last")
        one = rows.groupBy(F.col(self.key).alias("_key")).agg(last).select(f"_last.{_ROW}.*")
        self._write(one, f"put/version={version}")

    def _complete(self, spark: SparkSession, kind: str) -> list[int]:
        names = children(spark, f"{self.path}/{kind}")
        found = [n for n in names if exists(spark, f"{self.path}/{kind}/{n}/_SUCCESS")]
        return sorted(int(n.partition("=")[2]) for n in found)

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The table up to a version, by default the last one, with its `bucket`; None if nothing has been put."""
        base = [v for v in self._complete(spark, "base") if version is None or v <= version]
        start = base[-1] if base else None
        after = [
            v
            for v in self._complete(spark, "put")
            if (start is None or v > start) and (version is None or v <= version)
        ]
        folders = [("base", start)] * bool(base) + [("put", v) for v in after]
        if not folders:
            return None
        parts = [
            spark.read.parquet(f"{self.path}/{kind}/version={v}").withColumn(_VERSION, F.lit(v))
            for kind, v in folders
        ]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        if len(parts) == 1:
            return rows.drop(_VERSION)
        names = [c for c in rows.columns if c not in (_VERSION, _BUCKET)]
        # The bucket is a grouping column too, so a filter on it reaches the scans.
        merged = rows.groupBy(_BUCKET, F.col(self.key).alias("_key")).agg(
            F.max_by(F.struct(*names), F.col(_VERSION)).alias(_ROW)
        )
        return merged.select(f"{_ROW}.*", _BUCKET)

    def get(self, spark: SparkSession, key) -> DataFrame | None:
        """The row of one key, from its bucket."""
        rows = self.read(spark)
        if rows is None:
            return None
        wanted = F.lit(key)
        bucket = spark.range(1).select(self._bucket(wanted)).first()[0]
        return rows.where((F.col(_BUCKET) == bucket) & (F.col(self.key) == wanted))

    def compact(self, spark: SparkSession, version: int) -> None:
        """Merge up to a version into a base. What it replaces stays for readers until `clean`."""
        rows = self.read(spark, version)
        if rows is not None and version not in self._complete(spark, "base"):
            self._write(rows.drop(_BUCKET), f"base/version={version}")

    def clean(self, spark: SparkSession) -> None:
        """Delete what the last base has replaced. Versions before it can no longer be read."""
        base = self._complete(spark, "base")
        if not base:
            return
        old = [f"{self.path}/base/version={v}" for v in base[:-1]]
        old += [f"{self.path}/put/version={v}" for v in self._complete(spark, "put") if v <= base[-1]]
        discard(spark, old)
