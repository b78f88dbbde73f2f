"""The whole job over a batch of record sets."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wattledger.functions.channels import has_inverter_with_id
from wattledger.operators import ct, enrich, readings, slots, throttle
from wattledger.operators.skew import NO_HOT_KEYS, ROWS_PER_TASK, HotKeys, find_hot_keys
from wattledger.plans.outputs import energy_dataframe, partner_record, partner_telemetry
from wattledger.session import discard, keeping_empty_stages, recorded, stage
from wattledger.sources.decode import decode_flagged, record_json
from wattledger.sources.increments import Saved


@dataclass(frozen=True)
class State:
    """What one run leaves for the next; every part may be missing."""

    slots: DataFrame | Saved | None = None
    ct: DataFrame | Saved | None = None
    misses: DataFrame | None = None


def to_readings(
    record_sets: DataFrame, now: Column | int | None = None, local_mode: bool = False
) -> DataFrame:
    """Keyed readings within the accepted time range; local mode accepts any time."""
    records = readings.explode_records(record_sets)
    if not local_mode:
        records = readings.time_range_filter(records, now)
    return readings.with_raw_reading(records)


HOT_SAMPLE = 0.01


def hot_devices(record_sets: DataFrame) -> HotKeys:
    """Devices with more readings than one task should order, judged by a sample of uploads."""
    sample = record_sets.sample(HOT_SAMPLE, seed=0)
    if "record" not in sample.columns:
        sample = decode_flagged(sample).where("not malformed")
    sample = readings.explode_records(sample)
    with recorded() as paths:
        keys = stage(sample.select("host_rcpn", *readings.ARRIVAL), "hot_sample")
    found = find_hot_keys(keys, "host_rcpn", fraction=HOT_SAMPLE)
    discard(record_sets.sparkSession, paths)
    return found


def split_and_correct(
    enriched: DataFrame,
    state: DataFrame | Saved | None = None,
    decisions: DataFrame | None = None,
    hot: HotKeys | None = None,
    checks: DataFrame | None = None,
) -> DataFrame:
    """Correct registered systems, pass unregistered ones, and unite both.

    Without `checks`, the table of `ct.check_rows`, the rows carry their outcome themselves.
    """
    known = readings.registered(enriched)
    if checks is None:
        flagged = ct.ct_inversion(known, state, decisions=decisions, hot=hot)
    else:
        flagged = ct.ct_apply(known, checks, state, decisions=decisions, hot=hot)
    corrected = ct.ct_correct(flagged)
    others = readings.unregistered(enriched).withColumn("checked", F.lit(False))
    return corrected.unionByName(others)


def _narrowed(classified: DataFrame) -> DataFrame:
    """What later steps read: duplicates leave no trace, and only deltas and readings without a time need the record."""
    kind = F.col("slot_class")
    return classified.where(kind.isNull() | (kind != slots.DUPLICATE)).withColumn(
        "record", F.when(kind.isNull() | (kind == slots.EMIT), F.col("record"))
    )


def _classify(rows: DataFrame, state: DataFrame | Saved | None, hot: HotKeys) -> DataFrame:
    """Classified readings that are cheap to read again, from one pass over the uploads."""
    if not hot.cuts:
        return stage(_narrowed(slots.slot_classify(rows, state, hot)), "classified")

    def table(chunks: DataFrame) -> DataFrame:
        # A reading not accepted within its chunk is not accepted at all.
        slot = F.col("slot")
        accepted = F.col("previous").isNull() | slot.isNull() | (slot > F.col("previous.slot"))
        return stage(chunks.withColumn("record", F.when(accepted, F.col("record"))), "chunks")

    return _narrowed(slots.slot_classify(rows, state, hot, table))


def expire(state: State, before: int) -> State:
    """Forget devices and systems last heard of before a time. Off by default: a device that
    returns later starts over with a first reading."""

    def keep(df: DataFrame | None, column: str) -> DataFrame | None:
        return None if df is None else df.where(F.col(column) >= before)

    return State(
        slots=keep(state.slots, "slot"),
        ct=keep(state.ct, "valid_until"),
        misses=keep(state.misses, "expires_at"),
    )


def _rows(state: DataFrame | Saved | None) -> DataFrame | None:
    return state.read() if isinstance(state, Saved) else state


class Outputs:
    """The job's outputs, planned when first asked for.

    `classified`, `looked_up` and `checks` are tables, so several outputs share their work. With `share`
    the corrected rows, the decisions and the reported misses become tables too, when first
    asked for. Call `close` when all outputs and the state have been written. `clock` is the clock of the
    run where it gave the times of the misses, else None.
    """

    def __init__(
        self,
        classified: DataFrame,
        looked_up: DataFrame,
        checks: DataFrame,
        state: State,
        jitter: tuple[int, int] | None,
        deployment: str,
        local_mode: bool,
        strict: bool,
        share: bool,
        paths: list[str],
        clock: int | None = None,
        bounded: bool = False,
        counts: tuple[Observation, ...] = (),
    ):
        self._classified = classified
        self._looked_up = looked_up
        self._checks = checks
        self._before = state
        self._jitter = jitter
        self._deployment = deployment
        self._local_mode = local_mode
        self._strict = strict
        self._share = share
        self._paths = paths
        self.clock = clock
        self._bounded = bounded
        self._counts = counts

    def close(self) -> None:
        """Delete the staged tables. The outputs, and a state not yet written, end with them."""
        discard(self._looked_up.sparkSession, self._paths)
        self._paths.clear()

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        if not self._share:
            return df
        with recorded() as paths:
            table = stage(df, name)
        self._paths += paths
        return table

    @cached_property
    def _enriched(self) -> DataFrame:
        rows = enrich.matched(self._looked_up)
        if not self._local_mode:
            rows = rows.where("is_valid")
        return readings.require_counters(rows) if self._strict else rows

    @cached_property
    def _decisions(self) -> DataFrame:
        with recorded() as paths:
            made = ct.ct_decisions(self._checks, self._before.ct, bounded=self._bounded)
        self._paths += paths
        return self._kept(made, "decisions")

    @cached_property
    def _missed(self) -> DataFrame:
        return enrich.missed(self._looked_up)

    @cached_property
    def _report_times(self) -> DataFrame:
        with recorded() as paths:
            times = throttle.reported_misses(self._missed, self._before.misses, self._jitter)
        self._paths += paths
        return self._kept(times, "report_times")

    @cached_property
    def _reported(self) -> DataFrame:
        kept = throttle.suppress_misses(self._missed, reported=self._report_times)
        return self._kept(kept, "reported")

    @cached_property
    def corrected(self) -> DataFrame:
        # In a small table no system can be too large; counting it reads file footers only.
        small = self._looked_up.count() <= ROWS_PER_TASK
        hot = NO_HOT_KEYS if small else None
        rows = split_and_correct(self._enriched, self._before.ct, self._decisions, hot, self._checks)
        return self._kept(rows, "corrected")

    @cached_property
    def energy(self) -> DataFrame:
        return energy_dataframe(self.corrected)

    @cached_property
    def partner(self) -> DataFrame:
        return partner_telemetry(self.corrected)

    @cached_property
    def dead_letters(self) -> DataFrame:
        # Only here the whole record is needed, and only of few readings.
        key = ["host_rcpn", *readings.ARRIVAL]
        emitted = self._classified.where(F.col("slot_class") == slots.EMIT)
        whole = emitted.select(*key, "record")
        return enrich.dead_letters(self._reported.drop("record").join(whole, key))

    @cached_property
    def metrics(self) -> DataFrame:
        return enrich.not_found_metrics(self._reported, self._deployment)

    @cached_property
    def quality(self) -> DataFrame:
        return slots.quality_events(self._classified)

    @cached_property
    def quarantine(self) -> DataFrame:
        """What could not be read: arrival_seq, record_pos, reason, and the payload or the record as JSON."""
        bad = self._classified.where("slot_class is null")
        payload = F.col("payload") if "payload" in bad.columns else F.lit(None).cast("string")
        malformed = F.col("record").isNull()
        return bad.select(
            *readings.ARRIVAL,
            F.when(malformed, "malformed").otherwise("no_time").alias("reason"),
            F.when(malformed, payload).otherwise(record_json(F.col("record"))).alias("body"),
        )

    @cached_property
    def dropped(self) -> dict[str, int]:
        """How many uploads (`malformed`) and records were left out, by reason, counted in the passes of the run:
        `unusable_key`, `no_time`, `too_old`, `too_new`, and `not_valid` for deltas of known devices."""
        return {k: v or 0 for c in self._counts for k, v in c.get.items()}

    @cached_property
    def state(self) -> State:
        """State for the next run. Where the clock of the run gave the times of the misses, entries it
        has passed are dropped: a later run, whose clock is not earlier, reports with or without them."""
        misses = throttle.miss_state(self._report_times, self._before.misses)
        if self.clock is not None:
            misses = misses.where(F.col("expires_at") >= self.clock)
        return State(
            slots=slots.slot_state(self._classified, _rows(self._before.slots)),
            ct=ct.ct_state(self._decisions, _rows(self._before.ct)),
            misses=misses,
        )

    @cached_property
    def changed(self) -> State:
        """The rows of the state that this run has changed, each newer than the row it replaces."""
        return State(
            slots=slots.slot_changes(self._classified),
            ct=ct.ct_state(self._decisions),
            misses=throttle.miss_state(self._report_times),
        )


def run(
    record_sets: DataFrame,
    systems: DataFrame,
    ess: DataFrame,
    now: Column | int | None = None,
    state: State = State(),
    hot: HotKeys | None = None,
    jitter: tuple[int, int] | None = None,
    deployment: str = "dev",
    local_mode: bool = False,
    strict: bool = False,
    share: bool = False,
    ess_date_column: str | None = None,
) -> Outputs:
    """Run the job up to the tables its outputs are made from.

    They are staged in the shared folder: the classified readings, one row of metadata per host, the
    enriched deltas, and the few fields of comparable ones with the outcome of their reference meter. `now` is the clock
    of the whole run, by default the time of the call. `processed_at` (whole seconds) is taken
    from the record sets where they have it, else from the clock. Local mode leaves out the
    time range and the validation.

    `record_sets` may have a JSON `payload` instead of `sensorId` and `record`. Payloads that cannot be
    decoded go to `Outputs.quarantine`, as do records whose time is no number. Strict fails on readings
    without counters, which otherwise pass with NULLs. `share` suits callers that write several outputs.
    `ess_date_column` names a partition of the reference readings by UTC day.
    """
    if now is None:
        now = int(time.time())
    with recorded() as paths:
        if hot is None:
            hot = hot_devices(record_sets)
        exploded, timed, known_deltas = (Observation() for _ in range(3))
        counts = [exploded, known_deltas]
        flag = None
        if "record" not in record_sets.columns:
            flag = "malformed"
            record_sets = decode_flagged(record_sets)
            record_sets = record_sets.withColumn("payload", F.when(F.col(flag), F.col("payload")))
        rows = readings.explode_records(record_sets, exploded, flag)
        if not local_mode:
            rows = readings.time_range_or_none(rows, now, timed)
            counts.insert(1, timed)
        rows = readings.with_raw_reading(rows)
        if flag:
            rows = rows.drop(flag)
        passed = None
        clock = (now if isinstance(now, Column) else F.lit(now)).cast("bigint")
        if "processed_at" not in rows.columns:
            rows = rows.withColumn("processed_at", clock)
            passed = None if isinstance(now, Column) else now
        else:
            rows = rows.withColumn("processed_at", F.coalesce(F.col("processed_at").cast("bigint"), clock))
        with keeping_empty_stages(rows.sparkSession):
            classified = _classify(rows, state.slots, hot)
        # Judged here, so that only a part of the record has to travel on.
        deltas = slots.energy_delta(classified).withColumns(
            {
                "is_valid": has_inverter_with_id(F.col("record.channel")),
                "record": partner_record(F.col("record")),
            }
        )
        known = stage(enrich.latest_systems(systems), "systems")
        looked_up = enrich.lookup_systems(deltas, known, reduced=True)
        if not local_mode and not isinstance(now, Column):
            ess = ct.prune_ess(ess, now, ess_date_column)
        invalid = F.lit(False) if local_mode else F.col("system_host_rcpn").isNotNull() & ~F.col("is_valid")
        looked_up = looked_up.observe(known_deltas, F.count_if(invalid).alias("not_valid"))
        looked_up = stage(looked_up, "looked_up")
        checked = enrich.matched(looked_up) if local_mode else enrich.matched(looked_up).where("is_valid")
        checks = stage(ct.check_rows(checked, ess), "checks")
    return Outputs(
        classified,
        looked_up,
        checks,
        state,
        jitter,
        deployment,
        local_mode,
        strict,
        share,
        list(paths),
        passed,
        bounded=not local_mode and not isinstance(now, Column),
        counts=tuple(counts),
    )


def daily_summary(energy: DataFrame) -> DataFrame:
    """Totals of the energy table per UTC day and kind of system."""
    day = F.date_format(F.timestamp_seconds(F.col("timestamp_utc")), "yyyy-MM-dd")
    return energy.groupBy(
        day.alias("event_date"), F.col("system_registration_type").alias("registration")
    ).agg(
        F.count("*").alias("n_rows"),
        F.sum("delta_data.inverter_energy_imported_ws").alias("imported_ws"),
        F.sum("delta_data.inverter_energy_exported_ws").alias("exported_ws"),
        F.sum(F.col("rgm_data.is_inverter_output_swapped").cast("int")).alias("n_swapped"),
        F.sum("delta_data.time_diff_in_seconds").alias("seconds"),
    )
