"""A table of uploads that can be read by day of arrival and by the time of their records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.timeslots import epoch_seconds, utc_date
from wattledger.operators.readings import FUTURE_SECONDS, PAST_SECONDS
from wattledger.sources.sinks import MAX_RECORDS_PER_FILE

DAY = "upload_date"


def write_uploads(record_sets: DataFrame, path: str, mode: str = "append") -> None:
    """Record sets with `processed_at`, one folder per UTC day of arrival.

    `first_ts` and `last_ts` bound the times of an upload's records; both are NULL where a record has no usable
    time. Within a file uploads are sorted by `last_ts`, so a bound on it skips row groups. Uploads without
    `processed_at` are in the folder of NULL, which `prune_uploads` reads and a chain of days refuses.
    """
    seconds = F.transform("record", lambda r: epoch_seconds(r["timestamp"]))
    odd = F.exists("_seconds", lambda s: s.isNull())
    (
        record_sets.withColumn("_seconds", seconds)
        .withColumn("first_ts", F.when(~odd, F.array_min("_seconds")))
        .withColumn("last_ts", F.when(~odd, F.array_max("_seconds")))
        .withColumn(DAY, utc_date(F.col("processed_at")))
        .drop("_seconds")
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, "last_ts")
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(DAY)
        .parquet(path)
    )


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def prune_uploads(uploads: DataFrame, now: int) -> DataFrame:
    """Uploads of which a record can lie in the accepted time range, or has no usable time, as a filter of the scan.

    A run over the others gives nothing but counts of records left out.
    """
    last, first = F.col("last_ts"), F.col("first_ts")
    meets = (last >= now - PAST_SECONDS) & (first <= now + FUTURE_SECONDS)
    return uploads.where(last.isNull() | meets).drop("first_ts", "last_ts", DAY)
