"""Batch and streaming readers for uploaded record sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.schema import RECORD_SETS
from wattledger.session import first_time, stage


def number_rows(df: DataFrame, *order: str, name: str = "arrival_seq") -> DataFrame:
    """Number the rows densely from 0 in the order of columns that tell all rows apart.

    The rows are sorted by range and staged; their place in a partition plus the number of
    rows in the partitions before gives the number.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), place.alias("_place")),
        "placed",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    offsets = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: `payload` text, and a dense `arrival_seq` by time of change, then path.

    Only names and times are sorted; the texts are joined to them.
    """
    name = F.col("_metadata.file_path").alias("_path")
    changed = F.col("_metadata.file_modification_time").alias("_changed")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    numbered = number_rows(files.select(name, changed), "_changed", "_path").drop("_changed")
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    texts = texts.select(name, F.col("value").alias("payload"))
    return texts.join(numbered, "_path").select("arrival_seq", "payload")


def stream_record_sets(
    spark: SparkSession,
    path: str,
    start: str = "earliest",
    max_files_per_trigger: int = 1000,
    schema: T.StructType = RECORD_SETS,
    fmt: str = "parquet",
    started: str | None = None,
) -> DataFrame:
    """Record sets as they arrive in a folder.

    `start` is "earliest", "latest" (files changed after the query is first built) or an
    ISO timestamp. `max_files_per_trigger` bounds the size of a micro-batch. `started` names a
    folder, best beside the checkpoint, that keeps the time of the first "latest": a restart
    reads it back, so files that arrive while the job is down are not lost.
    """
    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )
    if start == "earliest":
        return stream
    if start == "latest":
        # Fixed when the stream is built, so that later micro-batches use the same start.
        since = first_time(spark, started) if started else spark.sql("select current_timestamp()").first()[0]
    else:
        since = start
    changed = F.col("_metadata.file_modification_time")
    return stream.where(changed >= F.lit(since).cast("timestamp"))


def from_kafka(messages: DataFrame) -> DataFrame:
    """Messages of one topic as `arrival_seq` and `payload`, for `decode.decode_record_sets`.

    The number is the offset with the partition in its lowest 12 bits: unique, and in order
    within a partition, hence within a message key. Greater partitions or offsets fail. A
    message without value has a NULL payload, which counts as malformed.
    """
    offset, partition = F.col("offset").cast("bigint"), F.col("partition").cast("bigint")
    fits = partition.between(0, (1 << 12) - 1) & offset.between(0, (1 << 51) - 1)
    failure = F.raise_error(F.lit("partition or offset out of range")).cast("boolean")
    return messages.where(F.when(fits, True).otherwise(failure)).select(
        F.shiftleft(offset, 12).bitwiseOR(partition).alias("arrival_seq"),
        F.col("value").cast("string").alias("payload"),
    )


def kafka_start_options(start: str = "earliest", max_offsets_per_trigger: int = 1_000_000) -> dict:
    """Options for `readStream.format("kafka")`; `start` as in `stream_record_sets`, with
    epoch milliseconds for a point in time. Needs the Kafka package on the classpath."""
    position = (
        {"startingOffsets": start}
        if start in ("earliest", "latest")
        else {"startingTimestamp": str(int(start))}
    )
    return {**position, "maxOffsetsPerTrigger": str(max_offsets_per_trigger)}
