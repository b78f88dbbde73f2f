"""Inverted current transformers: detection against a reference meter, and correction.

A system is checked at most once per interval. Between checks the last decision holds, so
each decision depends on when the one before it was made. Only these readings can make a
decision that stays: the first to arrive per system and slot whose own counters and whose
reference counters both differ, as a decision only moves the limit on. `jumping` chooses
among those; where the time range bounds their number, one fold over an array per system does.
Every reading then picks up the last decision before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.timeslots import slot_floor
from wattledger.operators.jumping import acting, greedy_actions, tagged, untagged
from wattledger.operators.readings import ARRIVAL, FUTURE_SECONDS, PAST_SECONDS, prune_dates
from wattledger.operators.skew import SAVED_SEQ, HotKeys, find_hot_keys, previous_max
from wattledger.schema import CT_STATE, SLOT_SECONDS
from wattledger.session import stage
from wattledger.sources.increments import KEY, Saved

CHECK_INTERVAL_SECONDS = 6 * 3600

MISSING, EQUAL, POS, NEG = "MISSING", "EQUAL", "POS", "NEG"

_DECISION = (
    f"struct<{ARRIVAL[0]}:bigint,{ARRIVAL[1]}:int,swapped:boolean,at:bigint,until:bigint>"
)


def ess_slots(ess: DataFrame) -> DataFrame:
    """First reference reading per system and slot, with its direction.

    Counters that are not given count as 0. Partial aggregation keeps this independent of
    how many readings a slot has.
    """
    imported = F.coalesce("lifetime_imported_ws", F.lit(0.0))
    exported = F.coalesce("lifetime_exported_ws", F.lit(0.0))
    first = F.min(F.struct("start_ts", imported.alias("imported"), exported.alias("exported")))
    return (
        ess.groupBy(
            F.col("system_id").alias("ess_system_id"),
            slot_floor(F.col("start_ts")).alias("ess_slot"),
        )
        .agg(first.alias("_first"))
        .select(
            "ess_system_id",
            "ess_slot",
            F.col("_first.imported").alias("ess_imported_ws"),
            F.col("_first.exported").alias("ess_exported_ws"),
        )
    )


def comparable() -> Column:
    """Readings the check can use; only registered systems are checked."""
    return (meter_sign() != 0) & F.col("is_registered")


def prune_ess(ess: DataFrame, now: int, date_column: str | None = None, until: int | None = None) -> DataFrame:
    """Reference readings that readings within the accepted time range can meet, for a clock from `now` to `until`.

    The bounds reach the scan; `date_column` names a partition by UTC day of `start_ts`.
    """
    slack, until = 2 * SLOT_SECONDS, now if until is None else until
    if date_column is not None:
        ess = prune_dates(ess, now, date_column, slack, until)
    return ess.where(F.col("start_ts").between(now - PAST_SECONDS - slack, until + FUTURE_SECONDS))


def ess_lookup(deltas: DataFrame, ess: DataFrame, where: Column | None = None) -> DataFrame:
    """Attach the reference meter's outcome for the slot before each reading.

    Where `where` does not hold nothing is looked up, and the outcome is MISSING.
    """
    system = F.col("system_id") if where is None else F.when(where, F.col("system_id"))
    checked_slot = slot_floor(F.col("timestamp_utc") + 1 - SLOT_SECONDS)
    outcome = (
        F.when(F.col("ess_slot").isNull(), MISSING)
        .when(F.col("ess_imported_ws") > F.col("ess_exported_ws"), POS)
        .when(F.col("ess_imported_ws") < F.col("ess_exported_ws"), NEG)
        .otherwise(EQUAL)
    )
    return (
        deltas.withColumn("_checked_slot", checked_slot)
        .withColumn("_checked_system", system)
        .join(
            ess_slots(ess),
            (F.col("_checked_system") == F.col("ess_system_id"))
            & (F.col("_checked_slot") == F.col("ess_slot")),
            "left",
        )
        .withColumn("ess_outcome", outcome)
        .drop("_checked_slot", "_checked_system", "ess_system_id", "ess_slot")
    )


def meter_sign() -> Column:
    imported, exported = F.col("raw_imported_ws"), F.col("raw_exported_ws")
    return F.when(imported > exported, 1).when(imported < exported, -1).otherwise(0)


def _opposite() -> Column:
    return F.when(F.col("ess_outcome") == POS, 1).otherwise(-1) != F.col("meter_sign")


def _with_sign(rows: DataFrame) -> DataFrame:
    return rows.withColumn("meter_sign", meter_sign()).withColumn(
        "_ts", F.col("timestamp_utc") + 1
    )


def _per_slot(rows: DataFrame) -> DataFrame:
    """Per system and slot the first reading to arrive that could decide, and the first without a reference."""
    compared = F.col("ess_outcome").isin(POS, NEG)
    return (
        _with_sign(rows)
        .where((F.col("meter_sign") != 0) & (F.col("ess_outcome") != EQUAL))
        .groupBy("system_id", "_ts")
        .agg(
            F.min(F.when(compared, F.struct(*ARRIVAL, _opposite().alias("swapped")))).alias("hit"),
            F.min(F.when(~compared, F.struct(*ARRIVAL))).alias("miss"),
        )
    )


def _starts_with_miss(state_until: Column, miss: Column, first_hit: Column) -> Column:
    """Without a reference reading the first reading of all settles on "not swapped"."""

    def order(c: Column) -> Column:
        return F.struct(*[c[name] for name in ARRIVAL])

    return state_until.isNull() & miss.isNotNull() & (first_hit.isNull() | (order(miss) < order(first_hit)))


_DECIDED = ("decided_system", *ARRIVAL, "swapped", "at", "until")


def ct_decisions(
    rows: DataFrame,
    state: DataFrame | Saved | None = None,
    interval: int = CHECK_INTERVAL_SECONDS,
    bounded: bool = False,
) -> DataFrame:
    """The decisions made: decided_system, the reading that made it, swapped, at, until.

    `rows` is the output of `ess_lookup`. `bounded` says that they lie within the accepted time range, so that a
    system has no more slots than fit into an array; then nothing is computed here but a plan. Otherwise the
    choice by pointer jumping runs over any range.
    """
    if state is None:
        state = rows.sparkSession.createDataFrame([], CT_STATE)
    return (_folded if bounded else _jumped)(_per_slot(rows), state, interval)


def _folded(per_slot: DataFrame, state: DataFrame | Saved, interval: int) -> DataFrame:
    until = F.col("_ts") + interval

    def decision(source: str, swapped: Column) -> Column:
        return F.struct(
            F.col(f"{source}.{ARRIVAL[0]}"),
            F.col(f"{source}.{ARRIVAL[1]}"),
            swapped.alias("swapped"),
            F.col("_ts").alias("at"),
            until.alias("until"),
        )

    hit = F.when(F.col("hit").isNotNull(), decision("hit", F.col("hit.swapped")))
    miss = F.when(F.col("miss").isNotNull(), decision("miss", F.lit(False)))
    found = F.array_sort(F.collect_list(hit)).alias("hits"), F.min(miss).alias("miss")
    if isinstance(state, Saved):
        grouped = state.placed(per_slot, "system_id").groupBy(KEY).agg(F.first("system_id").alias("system_id"), *found)
        per_system = state.joined(grouped, "_state").withColumn("start_until", F.col("_state.valid_until"))
    else:
        saved = state.select(F.col("system_id").alias("_state_system"), F.col("valid_until").alias("start_until"))
        same = F.col("system_id").eqNullSafe(F.col("_state_system"))
        per_system = per_slot.groupBy("system_id").agg(*found).join(saved, same, "left")
    starts_with_miss = _starts_with_miss(F.col("start_until"), F.col("miss"), F.try_element_at("hits", F.lit(1)))
    candidates = F.when(
        starts_with_miss, F.array_prepend("hits", F.col("miss").cast(_DECISION))
    ).otherwise(F.col("hits"))
    made = greedy_actions(
        candidates.cast(f"array<{_DECISION}>"),
        F.col("start_until"),
        lambda c, limit: c["at"] >= limit,
        lambda c: c["until"],
        _DECISION,
    )
    return per_system.select(F.col("system_id").alias("decided_system"), F.inline(made))


def _jumped(per_slot: DataFrame, state: DataFrame | Saved, interval: int) -> DataFrame:
    slots = stage(per_slot.withColumn("key", tagged(F.col("system_id"))).drop("system_id"), "per_slot")
    until = (F.col("_ts") + interval).alias("until")
    nodes = slots.where(F.col("hit").isNotNull()).select(
        "key",
        F.col("_ts").alias("at"),
        F.col(f"hit.{ARRIVAL[0]}").alias("seq"),
        F.col(f"hit.{ARRIVAL[1]}").alias("pos"),
        until.alias("free"),
        "hit.swapped",
    )
    per_system = slots.groupBy("key").agg(
        F.min("hit").alias("hit"),
        F.min(F.when(F.col("miss").isNotNull(), F.struct("miss.*", F.col("_ts").alias("at")))).alias("miss"),
    )
    if isinstance(state, Saved):
        per_system = state.joined(per_system.repartition(state.buckets, "key"), "_state", "key")
        per_system = per_system.withColumn("start_until", F.col("_state.valid_until"))
    else:
        known = state.select(tagged(F.col("system_id")).alias("key"), F.col("valid_until").alias("start_until"))
        per_system = per_system.join(known, "key", "left")
    first_is_miss = _starts_with_miss(F.col("start_until"), F.col("miss"), F.col("hit"))
    start = per_system.select(
        "key", F.when(first_is_miss, F.col("miss.at") + interval).otherwise(F.col("start_until")).alias("free")
    )
    found = acting(nodes.drop("swapped"), start)
    made = found.join(nodes, ["key", "seq", "pos"]).select(
        untagged(F.col("key")), "seq", "pos", "swapped", "at", F.col("free")
    )
    settled = per_system.where(first_is_miss).select(
        untagged(F.col("key")),
        *[F.col(f"miss.{c}") for c in ARRIVAL],
        F.lit(False),
        "miss.at",
        F.col("miss.at") + interval,
    )
    return made.toDF(*_DECIDED).unionByName(settled.toDF(*_DECIDED))


def ct_state(decisions: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Decision per system after a run, for the next run."""
    latest = decisions.select(
        F.col("decided_system").alias("system_id"), "swapped", F.col("until").alias("valid_until")
    )
    if state is not None:
        latest = latest.unionByName(state)
    return (
        latest.groupBy("system_id")
        .agg(F.max(F.struct("valid_until", "swapped")).alias("_s"))
        .select("system_id", "_s.swapped", "_s.valid_until")
    )


def _decision_rows(decisions: DataFrame, state: DataFrame | None) -> DataFrame:
    """Decisions as rows that follow the reading they were made on; saved ones come first."""

    def decision(seq: Column, pos: Column, swapped: Column, until: Column) -> list[Column]:
        fields = [
            seq.cast("bigint").alias(ARRIVAL[0]),
            pos.cast("int").alias(ARRIVAL[1]),
            swapped.alias("swapped"),
            until.alias("until"),
        ]
        return [*fields[:2], F.struct(*fields).alias("_decision"), F.lit(1).alias("_kind")]

    made = decisions.select(
        F.col("decided_system").alias("system_id"),
        *decision(*[F.col(c) for c in (*ARRIVAL, "swapped", "until")]),
    )
    if state is None:
        return made
    saved = state.select(
        "system_id",
        *decision(F.lit(SAVED_SEQ), F.lit(0), F.col("swapped"), F.col("valid_until")),
    )
    return made.unionByName(saved)


def _saved_decision(row: Column) -> Column:
    fields = (
        F.lit(SAVED_SEQ).cast("bigint").alias(ARRIVAL[0]),
        F.lit(0).alias(ARRIVAL[1]),
        row["swapped"].alias("swapped"),
        row["valid_until"].alias("until"),
    )
    return F.when(row.isNotNull(), F.struct(*fields))


def _saved_event(row: Column) -> Column:
    fields = (
        F.lit(SAVED_SEQ).cast("bigint").alias(ARRIVAL[0]),
        F.lit(0).alias(ARRIVAL[1]),
        F.lit(1).alias("kind"),
        row["swapped"].alias("swapped"),
        row["valid_until"].alias("until"),
    )
    return F.when(row.isNotNull(), F.struct(*fields))


def ct_inversion(
    rows: DataFrame,
    state: DataFrame | Saved | None = None,
    interval: int = CHECK_INTERVAL_SECONDS,
    decisions: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add `swapped` and `checked` (whether the reference meter was asked) to each reading.

    `rows` is the output of `ess_lookup` and is read more than once; pass a table, or stage it.
    Equal or missing counters are never comparable: not swapped, nothing decided. A check
    without a reference reading keeps the decision in force and does not extend it; one with
    equal reference counters leaves it for later readings but does not apply it.

    The decision in force is the latest one before the reading, a running maximum. `hot`
    lists systems too large for one task; they are looked up when not given.
    """
    judged = _judged(rows, state, interval, decisions, hot)
    return judged.drop("meter_sign", "_ts", "_kind", "_decision", "_last")


def _judged(
    rows: DataFrame,
    state: DataFrame | Saved | None,
    interval: int,
    decisions: DataFrame | None,
    hot: HotKeys | None,
) -> DataFrame:
    """`ct_inversion` with the decision in force, `_last`."""
    if decisions is None:
        decisions = ct_decisions(rows, state, interval)
    if hot is None:
        hot = find_hot_keys(rows, "system_id")
    saved = state if isinstance(state, Saved) else None
    if saved is not None:
        state = None
    both = (
        _with_sign(rows)
        .withColumn("_kind", F.lit(0))
        .unionByName(_decision_rows(decisions, state), allowMissingColumns=True)
    )
    joined = previous_max(
        both,
        "system_id",
        F.col("_decision"),
        "_last",
        hot,
        (*ARRIVAL, "_kind"),
        saved=saved,
        saved_value=_saved_decision,
    ).where("_kind = 0")

    comparable = F.col("meter_sign") != 0
    until = F.col("_last.until")
    due = until.isNull() | (F.col("_ts") >= until)
    in_force = F.coalesce("_last.swapped", F.lit(False))
    swapped = (
        F.when(~comparable, F.lit(False))
        .when(~due | (F.col("ess_outcome") == MISSING), in_force)
        .when(F.col("ess_outcome") == EQUAL, F.lit(False))
        .otherwise(_opposite())
    )
    return joined.withColumn("swapped", swapped).withColumn("checked", comparable & due)


def check_rows(rows: DataFrame, ess: DataFrame) -> DataFrame:
    """The readings a check can use, with nothing but what it needs of them, and their reference meter's outcome.

    Only these narrow rows are shuffled by system and slot. The table goes to `ct_decisions` and `ct_apply`.
    """
    needed = ("system_id", *ARRIVAL, "timestamp_utc", "raw_imported_ws", "raw_exported_ws")
    found = ess_lookup(rows.where(comparable()).select(*needed), ess)
    return found.drop("ess_imported_ws", "ess_exported_ws")


def _events(checks: DataFrame) -> DataFrame:
    """What readings meet at checks with a reference reading: rows just before the reading, and where its reference
    counters were equal, rows just after it that put the decision in force back."""
    checked = checks.where(F.col("checked") & F.col("ess_outcome").isin(EQUAL, POS, NEG))

    def event(kind: int, swapped: str) -> Column:
        return F.struct(
            *ARRIVAL,
            F.lit(kind).alias("kind"),
            F.col(swapped).alias("swapped"),
            F.col("_last.until").alias("until"),
        )

    both = F.when(F.col("ess_outcome") == EQUAL, F.array(event(-1, "swapped"), event(1, "_last.swapped")))
    return checked.select(
        "system_id", F.explode(F.coalesce(both, F.array(event(-1, "swapped")))).alias("_event")
    )


def ct_apply(
    rows: DataFrame,
    checks: DataFrame,
    state: DataFrame | Saved | None = None,
    interval: int = CHECK_INTERVAL_SECONDS,
    decisions: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """`ct_inversion` of rows that carry no outcome: it comes from `check_rows`, a table, which holds the comparable ones.

    The checks are judged on the narrow table. A reading then meets the last event before it: the decision
    in force, or what its own check has found.
    """
    if decisions is None:
        decisions = ct_decisions(checks, state, interval)
    if hot is None:
        hot = find_hot_keys(rows, "system_id")
    judged = _judged(checks, state, interval, decisions, hot)

    def after(df: DataFrame, system: str, seq: Column, pos: Column, until: str) -> DataFrame:
        fields = (
            seq.cast("bigint").alias(ARRIVAL[0]),
            pos.cast("int").alias(ARRIVAL[1]),
            F.lit(1).alias("kind"),
            F.col("swapped").alias("swapped"),
            F.col(until).alias("until"),
        )
        return df.select(F.col(system).alias("system_id"), F.struct(*fields).alias("_event"))

    events = _events(judged).unionByName(after(decisions, "decided_system", *[F.col(c) for c in ARRIVAL], "until"))
    saved = state if isinstance(state, Saved) else None
    if state is not None and saved is None:
        events = events.unionByName(after(state, "system_id", F.lit(SAVED_SEQ), F.lit(0), "valid_until"))
    order = (*ARRIVAL, "_kind")
    events = events.select(
        "system_id", "_event", *[F.col(f"_event.{c}") for c in ARRIVAL], F.col("_event.kind").alias("_kind")
    )
    both = _with_sign(rows).withColumn("_kind", F.lit(0)).unionByName(events, allowMissingColumns=True)
    met = previous_max(
        both, "system_id", F.col("_event"), "_last", hot, order, saved=saved, saved_value=_saved_event
    ).where("_kind = 0")
    known, until = F.col("meter_sign") != 0, F.col("_last.until")
    return (
        met.withColumn("swapped", known & F.coalesce("_last.swapped", F.lit(False)))
        .withColumn("checked", known & (until.isNull() | (F.col("_ts") >= until)))
        .drop("meter_sign", "_ts", "_kind", "_event", "_last")
    )


def ct_correct(flagged: DataFrame) -> DataFrame:
    """Exchange imported and exported, raw values and deltas, where the flag is set."""

    def pick(name: str, other: str) -> Column:
        return F.when(F.col("swapped"), F.col(other)).otherwise(F.col(name))

    return flagged.withColumns(
        {
            "raw_imported_ws": pick("raw_imported_ws", "raw_exported_ws"),
            "raw_exported_ws": pick("raw_exported_ws", "raw_imported_ws"),
            "delta_imported_ws": pick("delta_imported_ws", "delta_exported_ws"),
            "delta_exported_ws": pick("delta_exported_ws", "delta_imported_ws"),
        }
    )
