"""The stateful operators on the streaming state store: one Python call per key and micro-batch.

They give what the batch operators give on the same rows, for streams in which few readings of a device arrive at a
time: state is read and written for the keys of a micro-batch only, and the store keeps its versions beside the
checkpoint. A micro-batch's rows of one key are held and sorted in one Python worker, some hundred bytes each, so a
trigger should take no more than some million rows of the largest device; `job.MicroBatchJob` has no such limit.

Micro-batches must follow the order of arrival, and rows within one are sorted by it. `chained` runs the job as three
queries: uploads to deltas, deltas to corrected readings, deltas to reported misses. Each reads whole micro-batches of
the one before from its commit log, so their order holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wattledger.functions.channels import has_inverter_with_id
from wattledger.functions.timeslots import slot_floor
from wattledger.operators import ct, enrich, jumping, readings, slots, throttle
from wattledger.plans import daily
from wattledger.plans.outputs import energy_dataframe, partner_record, partner_telemetry
from wattledger.schema import SLOT_SECONDS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_KEY = "_key"
_CARRIED = "_carried"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on the executors' disks instead of their heaps, and upload changes only. For new checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def _given(column: Column, name: str) -> list[Column]:
    """A nullable number as two columns: pandas would make it a float, which cannot hold all of a counter."""
    number = column.cast("bigint")
    return [F.coalesce(number, F.lit(0)).alias(name), number.isNotNull().alias(f"{name}_given")]


def _numbers(rows: pd.DataFrame, name: str) -> list[int | None]:
    return [int(v) if given else None for v, given in zip(rows[name], rows[f"{name}_given"])]


def _by_key(
    rows: DataFrame,
    key: Column,
    needed: list[Column],
    added: str,
    state: str,
    step: Callable[[pd.DataFrame, tuple | None], tuple[dict, tuple | None]],
) -> DataFrame:
    """Add the columns `added` that `step` makes of a key's rows in order of arrival and its state.

    All columns of `rows` travel as one JSON text that Python never looks into.
    """
    carried = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    narrow = rows.select(jumping.tagged(key).alias(_KEY), *needed, *readings.ARRIVAL, carried.alias(_CARRIED))
    names = [f.name for f in T.StructType.fromDDL(added)]

    def run(_, parts: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        mine = pd.concat(list(parts), ignore_index=True).sort_values(list(readings.ARRIVAL), ignore_index=True)
        columns, after = step(mine, tuple(kept.get) if kept.exists else None)
        if after is not None:
            kept.update(after)
        keep = columns.pop("_keep", None)
        out = pd.DataFrame({_CARRIED: mine[_CARRIED], **{n: pd.array(columns[n], dtype=_DTYPES[n]) for n in names}})
        yield out if keep is None else out[keep]

    found = narrow.groupBy(_KEY).applyInPandasWithState(
        run, f"{_CARRIED} string, {added}", state, "append", GroupStateTimeout.NoTimeout
    )
    again = F.from_json(_CARRIED, rows.schema)
    return found.select(again.alias("_r"), *names).select("_r.*", *names)


_DTYPES = {
    "slot": "Int64",
    "slot_class": "string",
    "p_slot": "Int64",
    "p_time": "Int64",
    "p_imported": "Int64",
    "p_exported": "Int64",
    "swapped": "boolean",
    "checked": "boolean",
    "reported": "boolean",
}


def _classes(mine: pd.DataFrame, last: tuple | None) -> tuple[dict, tuple | None]:
    out: dict[str, list] = {n: [] for n in ("slot", "slot_class", "p_slot", "p_time", "p_imported", "p_exported")}
    rows = zip(mine["slot"].tolist(), mine["time"].tolist(), _numbers(mine, "imported"), _numbers(mine, "exported"))
    for row in rows:
        slot = row[0]
        if last is None:
            found = slots.FIRST
        elif slot <= last[0]:
            found = slots.DUPLICATE if slot == last[0] else slots.LATE
        else:
            found = slots.GAP if slot > last[0] + SLOT_SECONDS else slots.EMIT
        out["slot"].append(slot)
        out["slot_class"].append(found)
        for name, value in zip(("p_slot", "p_time", "p_imported", "p_exported"), last or (None,) * 4):
            out[name].append(value)
        if last is None or slot > last[0]:
            last = row
    return out, last


def classified(rows: DataFrame) -> DataFrame:
    """`slots.slot_classify` on a stream. Readings without a usable time, which get no class, are left out."""
    timed = rows.withColumn("slot", slot_floor(F.col("event_timestamp"))).where("slot is not null")
    found = _by_key(
        timed.drop("slot"),
        F.col("host_rcpn"),
        [
            slot_floor(F.col("event_timestamp")).alias("slot"),
            F.col("event_timestamp").alias("time"),
            *_given(F.col("raw_imported_ws"), "imported"),
            *_given(F.col("raw_exported_ws"), "exported"),
        ],
        "slot bigint, slot_class string, p_slot bigint, p_time bigint, p_imported bigint, p_exported bigint",
        "slot bigint, time bigint, imported bigint, exported bigint",
        _classes,
    )
    previous = F.struct(
        F.col("p_slot").alias("slot"),
        F.col("p_time").alias("event_timestamp"),
        F.col("p_imported").alias("raw_imported_ws"),
        F.col("p_exported").alias("raw_exported_ws"),
    )
    return found.withColumn("previous", F.when(F.col("p_slot").isNotNull(), previous)).drop(
        "p_slot", "p_time", "p_imported", "p_exported"
    )


def flagged(
    rows: DataFrame, interval: int = ct.CHECK_INTERVAL_SECONDS, where: Column | None = None
) -> DataFrame:
    """`ct.ct_inversion` on a stream of `ct.ess_lookup`'s rows.

    Rows for which `where` does not hold pass unflagged. They are dealt by device, so that they make no large key.
    """
    system, sign = F.col("system_id"), ct.meter_sign()
    if where is not None:
        system, sign = F.when(where, system).otherwise(F.col("host_rcpn")), F.when(where, sign).otherwise(0)

    def step(mine: pd.DataFrame, state: tuple | None) -> tuple[dict, tuple | None]:
        out: dict[str, list] = {"swapped": [], "checked": []}
        for ts, sign, outcome in zip(mine["ts"].tolist(), mine["sign"].tolist(), mine["outcome"].tolist()):
            due = sign != 0 and (state is None or ts >= state[1])
            swapped = sign != 0 and outcome != ct.EQUAL
            if due and outcome == ct.MISSING:
                state = state or (False, ts + interval)
            elif due and outcome != ct.EQUAL:
                state = ((1 if outcome == ct.POS else -1) != sign, ts + interval)
            # Between checks the decision holds whatever the reference says; a check it leaves open flags nothing.
            out["swapped"].append(bool(state[0]) if sign != 0 and state and (swapped or not due) else False)
            out["checked"].append(due)
        return out, state

    return _by_key(
        rows,
        system,
        [
            (F.col("timestamp_utc") + 1).alias("ts"),
            sign.alias("sign"),
            F.col("ess_outcome").alias("outcome"),
        ],
        "swapped boolean, checked boolean",
        "swapped boolean, valid_until bigint",
        step,
    )


def suppressed(misses: DataFrame, jitter: tuple[int, int] | None = None, seed: int = 0) -> DataFrame:
    """`throttle.suppress_misses` on a stream. Within a second the first miss to arrive counts, and so within a
    micro-batch; a later micro-batch's miss of an earlier time finds the expiry of the later one."""
    host = F.col("raw_host_rcpn")

    def step(mine: pd.DataFrame, state: tuple | None) -> tuple[dict, tuple | None]:
        limit = state[0] if state else None
        report = pd.Series(False, index=mine.index)
        for i in mine.sort_values(["at", *readings.ARRIVAL]).index:
            if limit is None or mine["at"][i] > limit:
                report[i], limit = True, int(mine["until"][i])
        return {"reported": report.tolist(), "_keep": report}, (limit,)

    at = F.col("processed_at").cast("bigint")
    until = at + throttle.jittered_ttl(host, at, jitter, seed)
    found = _by_key(
        throttle.with_times(misses),
        host,
        [at.alias("at"), until.alias("until")],
        "reported boolean",
        "expires_at bigint",
        step,
    )
    return found.drop("reported")


@dataclass
class Chained:
    """The job as chained queries under `path`, each with its own checkpoint. `systems` is read when a query starts;
    `ess` likewise."""

    path: str
    systems: DataFrame
    ess: DataFrame
    now: Column | int | None = None
    local_mode: bool = False
    jitter: tuple[int, int] | None = None
    deployment: str = "dev"

    def _write(self, df: DataFrame, name: str) -> StreamingQuery:
        return (
            df.writeStream.format("parquet")
            .queryName(name)
            .option("path", f"{self.path}/{name}")
            .option("checkpointLocation", f"{self.path}/checkpoints/{name}")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )

    def deltas(self, record_sets: DataFrame) -> StreamingQuery:
        """Uploads to classified readings; `processed_at` must be a column, as a restart has another clock."""
        rows = daily.to_readings(record_sets, self.now, self.local_mode)
        return self._write(classified(rows), "classified")

    def _deltas(self) -> DataFrame:
        spark = self.systems.sparkSession
        folder = f"{self.path}/classified"
        rows = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
        emitted = slots.energy_delta(rows)
        return enrich.lookup_systems(emitted, self.systems)

    def corrected(self) -> StreamingQuery:
        """Deltas of known systems, checked and corrected: what `energy_dataframe` and `partner_telemetry` take."""
        known = enrich.matched(self._deltas())
        if not self.local_mode:
            known = known.where(has_inverter_with_id(F.col("record.channel")))
        known = ct.ess_lookup(known, self.ess, ct.comparable()).drop("ess_imported_ws", "ess_exported_ws")
        known = known.withColumn("record", partner_record(F.col("record")))
        checked = flagged(known, where=F.col("is_registered"))
        return self._write(ct.ct_correct(checked), "corrected")

    def reported(self) -> StreamingQuery:
        """Misses to report: what `dead_letters` and `not_found_metrics` take."""
        return self._write(suppressed(enrich.missed(self._deltas()), self.jitter), "reported")

    def run(self, record_sets: DataFrame, timeout: int | None = None) -> None:
        """Handle what has arrived, query by query."""
        for begin in (lambda: self.deltas(record_sets), self.corrected, self.reported):
            query = begin()
            query.awaitTermination(timeout)
            if query.exception() is not None:
                raise query.exception()

    def _table(self, name: str) -> DataFrame:
        return self.systems.sparkSession.read.parquet(f"{self.path}/{name}")

    def energy(self) -> DataFrame:
        return energy_dataframe(self._table("corrected"))

    def partner(self) -> DataFrame:
        return partner_telemetry(self._table("corrected"))

    def quality(self) -> DataFrame:
        return slots.quality_events(self._table("classified"))

    def dead_letters(self) -> DataFrame:
        return enrich.dead_letters(self._table("reported"))

    def metrics(self) -> DataFrame:
        return enrich.not_found_metrics(self._table("reported"), self.deployment)
