"""From record sets to keyed readings, and the stateless filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wattledger.functions.channels import (
    UNKNOWN_HOST,
    has_inverter_with_id,
    host_rcpn,
    output_channel,
    raw_reading,
)
from wattledger.functions.text import is_blank
from wattledger.functions.timeslots import epoch_seconds

PAST_SECONDS = 7 * 24 * 3600
FUTURE_SECONDS = 30 * 60

# Position of a reading in the order of arrival: upload first, then place in the upload.
ARRIVAL = ("arrival_seq", "record_pos")


def explode_records(
    record_sets: DataFrame, counts: Observation | None = None, malformed: str | None = None
) -> DataFrame:
    """One row per record with its key `host_rcpn`.

    The first record without a usable key ends its record set: it and all later
    records of the set are dropped. `counts` is told how many, as `unusable_key`. A record set for which the
    column `malformed` holds gives one row without a record, under a key of its own.
    """
    hosts = F.transform("record", lambda r: host_rcpn(r["channel"]))
    first_bad = F.array_position(
        F.transform("_hosts", lambda h: (h == UNKNOWN_HOST) | is_blank(h)), True
    )
    usable = F.when(first_bad == 0, F.size("record")).otherwise((first_bad - 1).cast("int"))
    others = [c for c in record_sets.columns if c != "record"]
    rows = F.slice(F.arrays_zip("record", F.col("_hosts").alias("host")), 1, F.col("_usable"))
    if malformed is not None:
        record = F.lit(None).cast(record_sets.schema["record"].dataType.elementType)
        own = F.concat(F.lit("?"), F.col(ARRIVAL[0]).cast("string"))
        alone = F.array(F.struct(record.alias("record"), own.alias("host")))
        rows = F.when(F.col(malformed), alone).otherwise(rows)
    # The keys and their number get projections of their own, so each is computed once.
    found = record_sets.select(*others, "record", hosts.alias("_hosts")).select(
        *others, "record", "_hosts", usable.alias("_usable")
    )
    if counts is not None:
        left = F.sum(F.when(F.col("record").isNotNull(), F.size("record") - F.col("_usable")))
        more = [] if malformed is None else [F.count_if(F.col(malformed)).alias("malformed")]
        found = found.observe(counts, left.alias("unusable_key"), *more)
    return found.select(*others, F.posexplode(rows).alias("record_pos", "_row")).select(
        *others,
        "record_pos",
        F.col("_row.record").alias("record"),
        F.col("_row.host").alias("host_rcpn"),
    )


def with_raw_reading(records: DataFrame) -> DataFrame:
    """Add the flat reading columns of `raw_reading` next to the record."""
    record = F.col("record")
    return (
        records.withColumn("_output", output_channel(record))
        .select("*", *raw_reading(record, F.col("_output")))
        .drop("_output")
    )


def time_range_filter(
    records: DataFrame, now: Column | int | None = None, timestamp: str = "record.timestamp"
) -> DataFrame:
    """Keep readings from seven days ago to 30 minutes ahead, both ends included."""
    seconds = epoch_seconds(F.col(timestamp))
    first, last = _accepted(now)
    return records.where(seconds.between(first, last))


def _accepted(now: Column | int | None) -> tuple[Column, Column]:
    if now is None:
        now = F.unix_timestamp()
    elif not isinstance(now, Column):
        now = F.lit(now).cast("bigint")
    return now - PAST_SECONDS, now + FUTURE_SECONDS


def time_range_or_none(
    records: DataFrame, now: Column | int | None = None, counts: Observation | None = None
) -> DataFrame:
    """As `time_range_filter`, but records whose time is missing or no number of seconds stay, for quarantine.

    `counts` is told how many lie before and after the range (`too_old`, `too_new`), and how many have no time.
    """
    seconds = epoch_seconds(F.col("record.timestamp"))
    first, last = _accepted(now)
    if counts is not None:
        records = records.observe(
            counts,
            F.count_if(seconds < first).alias("too_old"),
            F.count_if(seconds > last).alias("too_new"),
            F.count_if(seconds.isNull() & F.col("record").isNotNull()).alias("no_time"),
        )
    return records.where(seconds.isNull() | seconds.between(first, last))


def prune_dates(
    records: DataFrame, now: int, date_column: str = "event_date", slack: int = 0, until: int | None = None
) -> DataFrame:
    """The days `time_range_filter` can keep with a clock from `now` to `until`, as a filter on a table's date partition.

    For tables with one record per row, partitioned by the UTC day of the record. `slack`
    moves the start back by some seconds.
    """
    first = F.date_from_unix_date(F.lit((now - PAST_SECONDS - slack) // 86400))
    last = F.date_from_unix_date(F.lit(((now if until is None else until) + FUTURE_SECONDS) // 86400))
    return records.where(F.col(date_column).between(first, last))


def valid_records(records: DataFrame, record: str = "record") -> DataFrame:
    """Keep records in which some inverter-output channel names its inverter."""
    return records.where(has_inverter_with_id(F.col(f"{record}.channel")))


def require_counters(rows: DataFrame) -> DataFrame:
    """Fail on a reading of which a counter or a delta is missing."""
    missing = F.col("raw_imported_ws").isNull() | F.col("raw_exported_ws").isNull()
    missing = missing | F.col("delta_imported_ws").isNull() | F.col("delta_exported_ws").isNull()
    failure = F.raise_error(
        F.concat(F.lit("missing counter of "), F.coalesce("host_rcpn", F.lit("null")))
    ).cast("boolean")
    return rows.where(F.when(missing, failure).otherwise(True))


def registered(enriched: DataFrame) -> DataFrame:
    return enriched.where("is_registered")


def unregistered(enriched: DataFrame) -> DataFrame:
    """Readings of unregistered systems, which are never corrected."""
    return pass_unregistered(enriched.where("not is_registered"))


def pass_unregistered(enriched: DataFrame) -> DataFrame:
    """Mark readings of unregistered systems as not swapped; the others stay open (NULL)."""
    return enriched.withColumn("swapped", F.when(~F.col("is_registered"), False))
