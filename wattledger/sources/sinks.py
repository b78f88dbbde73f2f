"""Writers for the job's outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.timeslots import utc_date
from wattledger.sources.keyed_table import KeyedTable
from wattledger.sources.shard_log import append_messages

MAX_RECORDS_PER_FILE = 5_000_000


def _write_by_date(df: DataFrame, path: str, mode: str) -> None:
    # REBALANCE lets AQE give each day a fitting number of files, whatever its size.
    (
        df.hint("rebalance", "event_date")
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy("event_date")
        .parquet(path)
    )


def write_energy(energy: DataFrame, path: str, mode: str = "append") -> None:
    """Energy table with its routing key, one folder per UTC day."""
    _write_by_date(energy.withColumn("event_date", utc_date(F.col("timestamp_utc"))), path, mode)


def write_partner(partner: DataFrame, path: str, mode: str = "append") -> None:
    """Partner telemetry with its routing key, one folder per UTC day."""
    _write_by_date(partner.withColumn("event_date", utc_date(F.col("timestamp_utc"))), path, mode)


def write_dead_letters(dead_letters: DataFrame, path: str, mode: str = "append") -> None:
    """Dead letters as JSON lines, one folder per UTC day of the slot."""
    (
        dead_letters.select(
            F.substring_index("dlq_key", "/", 1).alias("event_date"), "dlq_key", "body"
        )
        .hint("rebalance", "event_date")
        .write.mode(mode)
        .partitionBy("event_date")
        .json(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def keyed_messages(df: DataFrame, key: str = "partition_key") -> DataFrame:
    """Rows as (key, value) messages for `format("kafka")`.

    The key brings a device's rows to one partition of the topic. They are not sorted, as that
    would put a large device into one task; readers order by `timestamp_utc`.
    """
    fields = [c for c in df.columns if c != key]
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def message_writer(fmt: str = "kafka", **options: str) -> Callable[[DataFrame, str, str], None]:
    """Writer of keyed messages for `MicroBatchJob.writers`.

    Options for Kafka are its servers and topic. Kafka appends and knows no path, so a repeated
    batch sends its messages again; other formats write to the path of the batch.
    """

    def write(df: DataFrame, path: str, mode: str = "append") -> None:
        out = keyed_messages(df).write.format(fmt).options(**options)
        if fmt == "kafka":
            out.save()
        else:
            out.mode(mode).save(path)

    return write


def log_writer(
    log: str, shards: int, order: tuple[str, ...] = ("timestamp_utc",), key: str = "partition_key"
) -> Callable[[DataFrame, str, str], None]:
    """Writer into a log of keyed messages for `MicroBatchJob.writers`.

    A batch is one commit and a repeated batch adds nothing. Within a batch the messages of a shard, hence of a key, are in
    the given order. The log belongs to one output of one stream.
    """

    def write(df: DataFrame, path: str, mode: str = "append") -> None:
        values = F.to_json(F.struct(*[c for c in df.columns if c != key]))
        messages = df.select(F.col(key).cast("string").alias("key"), values.alias("value"), *order)
        append_messages(messages, log, shards, order, "stream", int(path.rpartition("=")[2]))

    return write


def upsert_writer(table: KeyedTable) -> Callable[[DataFrame, str, str], None]:
    """Writer into a keyed table for `MicroBatchJob.writers`, with the id of the batch as version.

    For `dead_letters` the key is `dlq_key`: a second letter under a key replaces the first. Of two in one batch the
    one with the greater body stays, whichever came first.
    """

    def write(df: DataFrame, path: str, mode: str = "append") -> None:
        table.put(df, int(path.rpartition("=")[2]))

    return write
