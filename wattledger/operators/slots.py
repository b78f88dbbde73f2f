"""Slot classification and energy deltas per device.

A reading is accepted when its 5-minute slot is later than every slot accepted before
it, in order of arrival. The last accepted reading is therefore the earlier reading with
the latest slot (the first to arrive, if several share it): a running maximum, which
needs no sequential pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.timeslots import iso_utc, slot_floor
from wattledger.operators.readings import ARRIVAL
from wattledger.operators.skew import SAVED_SEQ, HotKeys, find_hot_keys, previous_max
from wattledger.schema import SLOT_SECONDS, SLOT_STATE
from wattledger.sources.increments import Saved

FIRST, DUPLICATE, LATE, GAP, EMIT = "FIRST", "DUPLICATE", "LATE", "GAP", "EMIT"


def _accepted_rank() -> Column:
    """Struct whose maximum is the last accepted reading; NULL without a usable time."""
    rank = F.struct(
        F.col("slot"),
        (-F.col(ARRIVAL[0])).alias("neg_seq"),
        (-F.col(ARRIVAL[1])).alias("neg_pos"),
        F.col("event_timestamp"),
        F.col("raw_imported_ws"),
        F.col("raw_exported_ws"),
    )
    return F.when(F.col("slot").isNotNull(), rank)


def _with_slots(readings: DataFrame) -> DataFrame:
    return readings.withColumn("slot", slot_floor(F.col("event_timestamp")))


def _saved_rank(row: Column) -> Column:
    rank = F.struct(
        row["slot"].alias("slot"),
        F.lit(-SAVED_SEQ).cast("bigint").alias("neg_seq"),
        F.lit(0).alias("neg_pos"),
        *[row[c].alias(c) for c in ("event_timestamp", "raw_imported_ws", "raw_exported_ws")],
    )
    return F.when(row["slot"].isNotNull(), rank)


def _state_rows(state: DataFrame) -> DataFrame:
    return state.select(
        *[f.name for f in SLOT_STATE],
        F.lit(SAVED_SEQ).cast("bigint").alias(ARRIVAL[0]),
        F.lit(0).alias(ARRIVAL[1]),
        F.lit(True).alias("_saved"),
    )


def slot_classify(
    readings: DataFrame,
    state: DataFrame | Saved | None = None,
    hot: HotKeys | None = None,
    materialize: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `slot`, `slot_class` and `previous` (the last accepted reading before the row).

    `readings` needs host_rcpn, event_timestamp, raw_imported_ws, raw_exported_ws and the
    arrival columns. A reading without a usable time gets no class. `state` holds the last
    accepted reading per host of earlier runs.
    `hot` lists devices too large for one task; they are looked up when not given.
    `materialize` is as in `previous_max`.
    """
    if hot is None:
        hot = find_hot_keys(readings, "host_rcpn")
    rows = _with_slots(readings)
    saved = state if isinstance(state, Saved) else None
    if saved is not None:
        state = None
    if state is not None:
        rows = rows.withColumn("_saved", F.lit(False)).unionByName(
            _state_rows(state), allowMissingColumns=True
        )
    rows = previous_max(
        rows,
        "host_rcpn",
        _accepted_rank(),
        "previous",
        hot,
        materialize=materialize,
        saved=saved,
        saved_value=_saved_rank,
    )
    if state is not None:
        rows = rows.where("not _saved").drop("_saved")
    before, slot = F.col("previous.slot"), F.col("slot")
    return rows.withColumn(
        "slot_class",
        F.when(slot.isNull(), F.lit(None))
        .when(before.isNull(), FIRST)
        .when(slot == before, DUPLICATE)
        .when(slot < before, LATE)
        .when(slot > before + SLOT_SECONDS, GAP)
        .otherwise(EMIT),
    )


def slot_changes(classified: DataFrame) -> DataFrame:
    """The rows of the state that a run has changed: accepted readings are later than what was saved of their host."""
    return slot_state(classified.where(F.col("slot_class").isin(FIRST, GAP, EMIT)))


def slot_state(readings: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Last accepted reading per host after a run, for the next run."""
    needed = ["host_rcpn", "slot", "event_timestamp", "raw_imported_ws", "raw_exported_ws"]
    rows = _with_slots(readings).select(*needed, *ARRIVAL)
    if state is not None:
        rows = rows.unionByName(_state_rows(state).drop("_saved"))
    return (
        rows.groupBy("host_rcpn")
        .agg(F.max(_accepted_rank()).alias("last"))
        .where("last is not null")
        .select("host_rcpn", *[F.col(f"last.{c}") for c in needed[1:]])
    )


def energy_delta(classified: DataFrame) -> DataFrame:
    """Deltas of consecutive slots.

    Counters missing on either side give NULL. Negative deltas are legal: a counter that
    goes back is reported as it is. `time_delta_seconds` is the distance of the raw times.
    """
    previous = F.col("previous")
    return (
        classified.where(F.col("slot_class") == EMIT)
        .withColumn("timestamp_utc", F.col("slot") - 1)
        .withColumn(
            "time_delta_seconds",
            (F.col("event_timestamp") - previous["event_timestamp"]).try_cast("int"),
        )
        .withColumn(
            "delta_imported_ws",
            F.try_subtract(F.col("raw_imported_ws"), previous["raw_imported_ws"]),
        )
        .withColumn(
            "delta_exported_ws",
            F.try_subtract(F.col("raw_exported_ws"), previous["raw_exported_ws"]),
        )
        .drop("slot", "slot_class", "previous")
    )


def quality_events(classified: DataFrame) -> DataFrame:
    """Log entries for late readings and for gaps."""
    expected = F.col("previous.slot") + SLOT_SECONDS
    return classified.where(F.col("slot_class").isin(LATE, GAP)).select(
        F.col("host_rcpn").alias("identifier"),
        *ARRIVAL,
        F.when(F.col("slot_class") == LATE, "Late_Event").otherwise("Future_Event").alias(
            "event_type"
        ),
        expected.alias("expected_slot"),
        F.col("slot").alias("actual_slot"),
        F.format_string(
            "Was expecting %s timestamp, but got %s", iso_utc(expected), iso_utc(F.col("slot"))
        ).alias("message"),
    )
