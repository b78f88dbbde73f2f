"""System metadata: lookup, misses, dead letters and the miss count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.functions.text import is_blank
from wattledger.functions.timeslots import slot_floor
from wattledger.operators.jumping import acting, tagged, untagged
from wattledger.operators.skew import find_hot_keys, previous_max
from wattledger.operators.throttle import jittered_ttl, with_times
from wattledger.schema import CACHE_STATE, SLOT_SECONDS
from wattledger.session import stage
from wattledger.sources.decode import record_json

UNKNOWN_TIMEZONE = "UNKNOWN"
MISS_METRIC = "delta.rgm.resourceNotFoundCount"
# How long an answer about a known host is used before it is asked for again.
KNOWN_TTL_SECONDS = 4 * 3600


def latest_systems(systems: DataFrame) -> DataFrame:
    """One normalised row per host.

    With an `updated_at` column the latest version of a host wins, and of equal ones (or
    without that column) the one with the greatest values. A blank time zone becomes UNKNOWN
    and a missing registration flag means unregistered.
    """
    return _normalised(systems, ["host_rcpn"])


def system_versions(versions: DataFrame) -> DataFrame:
    """One normalised row per host and `valid_from` (whole seconds), chosen as in `latest_systems`."""
    return _normalised(versions, ["host_rcpn", "valid_from"])


def _normalised(systems: DataFrame, key: list[str]) -> DataFrame:
    order = ["updated_at"] if "updated_at" in systems.columns else []
    fields = [c for c in systems.columns if c not in (*key, *order)]
    systems = (
        systems.groupBy(*key)
        .agg(F.max(F.struct(*order, *fields)).alias("_latest"))
        .select(*key, *[F.col(f"_latest.{c}") for c in fields])
    )
    zone = F.col("timezone")
    return systems.select(
        *key,
        "system_id",
        "site_id",
        F.coalesce("is_registered", F.lit(False)).alias("is_registered"),
        F.when(zone.isNull() | is_blank(zone), UNKNOWN_TIMEZONE).otherwise(zone).alias("timezone"),
        "location_id",
    )


def _system_columns(systems: DataFrame, reduced: bool) -> DataFrame:
    systems = systems if reduced else latest_systems(systems)
    return systems.withColumnRenamed("host_rcpn", "system_host_rcpn")


def lookup_systems(readings: DataFrame, systems: DataFrame, reduced: bool = False) -> DataFrame:
    """Attach metadata by the device id of the reading; misses have `system_host_rcpn` NULL.

    No broadcast hint: Spark broadcasts the systems when they are small enough, by their
    table statistics or by their size at run time, and shuffles both sides otherwise. AQE splits
    a large device only where the other side is a plain exchange, not an aggregate: stage
    `latest_systems` and pass it as `reduced` where devices may be large.
    """
    return readings.join(
        _system_columns(systems, reduced), F.col("raw_host_rcpn") == F.col("system_host_rcpn"), "left"
    )


def matched(looked_up: DataFrame) -> DataFrame:
    return looked_up.where(F.col("system_host_rcpn").isNotNull())


def missed(looked_up: DataFrame) -> DataFrame:
    return looked_up.where(F.col("system_host_rcpn").isNull())


def enrich_systems(readings: DataFrame, systems: DataFrame, reduced: bool = False) -> DataFrame:
    """Readings of known devices with their system's metadata; `reduced` as in `lookup_systems`."""
    return readings.join(
        _system_columns(systems, reduced), F.col("raw_host_rcpn") == F.col("system_host_rcpn")
    )


def unmatched_systems(readings: DataFrame, systems: DataFrame) -> DataFrame:
    """Readings of devices without metadata, including those without a device id."""
    return readings.join(
        systems.select(F.col("host_rcpn").alias("_known_host")),
        F.col("raw_host_rcpn") == F.col("_known_host"),
        "left_anti",
    )


_LINE = ("at", "kind")
_SYSTEM = ("system_id", "site_id", "is_registered", "timezone", "location_id")


def enrich_systems_asof(
    readings: DataFrame,
    versions: DataFrame,
    state: DataFrame | None = None,
    jitter: tuple[int, int] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Attach to each reading the metadata that a cache of answers would give at its `processed_at`.

    An answer is the version of the host with the greatest `valid_from` up to the time of asking. A host that has one
    is asked about again after `KNOWN_TTL_SECONDS`, one without after the time a miss stays known; until then a change
    of its metadata is not seen. Adds `asked_at`, `expires_at`, `valid_from` and the fields of the system; those and
    `valid_from` are NULL for a miss. `state` holds the answers in force after earlier runs (see `answers`).

    Whom to ask when is the choice of `jumping` over one candidate per host and second. The version of a time and
    the last answer before it are running maxima, in which large hosts are cut.
    """
    key, host = tagged(F.col("raw_host_rcpn")), untagged(F.col("key"))
    if state is None:
        state = readings.sparkSession.createDataFrame([], CACHE_STATE)
    asked = with_times(readings).select(key.alias("key"), F.col("processed_at").cast("bigint").alias("at")).distinct()
    saved = state.select(
        tagged(F.col("host_rcpn")).alias("key"), F.col("asked_at").alias("at"), (F.col("expires_at") + 1).alias("free")
    )
    version = F.struct("valid_from", *_SYSTEM)
    known = system_versions(versions).where("host_rcpn is not null and valid_from is not null").select(
        tagged(F.col("host_rcpn")).alias("key"),
        F.col("valid_from").cast("bigint").alias("at"),
        F.lit(0).alias("kind"),
        version.alias("version"),
    )
    times = asked.withColumn("kind", F.lit(1)).unionByName(saved.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    line = stage(times.unionByName(known, allowMissingColumns=True), "versions")
    hot = find_hot_keys(line, "key", order=_LINE)
    # A version counts from its own second on, so it comes before the questions of that second.
    seen = previous_max(line, "key", F.col("version"), "found", hot, _LINE).where("kind > 0")
    ttl = F.when(
        F.col("found").isNull(), jittered_ttl(host, F.col("at"), jitter, seed)
    ).otherwise(jittered_ttl(host, F.col("at"), jitter, seed, KNOWN_TTL_SECONDS))
    seen = stage(seen.withColumn("free", F.coalesce("free", F.col("at") + ttl + 1)).drop("version"), "seen")
    candidates = seen.where("kind = 1")
    nodes = candidates.select("key", "at", F.col("at").alias("seq"), F.lit(0).alias("pos"), "free")
    acts = acting(nodes, saved.select("key", "free")).select("key", F.col("seq").alias("at"))
    answer = F.struct("at", F.col("free").alias("until"), "found")
    given = candidates.join(acts, ["key", "at"]).unionByName(seen.where("kind = 2"))
    given = given.select("key", "at", F.lit(0).alias("kind"), answer.alias("answer"))
    both = candidates.select("key", "at", "kind").unionByName(given, allowMissingColumns=True)
    carried = previous_max(both, "key", F.col("answer"), "last", hot, _LINE).where("kind = 1")
    carried = carried.select(
        F.col("key").alias("_key"),
        F.col("at").alias("_at"),
        F.col("last.at").alias("asked_at"),
        (F.col("last.until") - 1).alias("expires_at"),
        F.col("last.found.valid_from").alias("valid_from"),
        *[F.col(f"last.found.{c}").alias(c) for c in _SYSTEM],
    )
    same = (key == F.col("_key")) & (F.col("processed_at") == F.col("_at"))
    return readings.join(carried, same).drop("_key", "_at")


def answers(enriched: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The last answer per host after a run, for the next run."""
    last = enriched.select(F.col("raw_host_rcpn").alias("host_rcpn"), "asked_at", "expires_at")
    if state is not None:
        last = last.unionByName(state)
    return (
        last.groupBy("host_rcpn")
        .agg(F.max(F.struct("asked_at", "expires_at")).alias("_last"))
        .select("host_rcpn", "_last.*")
    )


def dead_letters(misses: DataFrame) -> DataFrame:
    """Object key and JSON body per miss. Needs the UTC session time zone."""
    slot = F.col("timestamp_utc") + 1
    host = F.coalesce("raw_host_rcpn", F.lit("null"))
    error = F.concat(F.lit("No system information found for "), host)
    return misses.select(
        F.concat_ws(
            "/",
            F.date_format(F.timestamp_seconds(slot), "yyyy-MM-dd"),
            host,
            F.concat(slot.cast("string"), F.lit(".json")),
        ).alias("dlq_key"),
        F.to_json(
            F.struct(record_json(F.col("record")).alias("record"), error.alias("error"))
        ).alias("body"),
    )


def not_found_metrics(
    misses: DataFrame, deployment: str = "dev", interval: int = SLOT_SECONDS
) -> DataFrame:
    """Count of reported misses per device and interval of processing time."""
    return (
        misses.groupBy(
            F.col("raw_host_rcpn"),
            slot_floor(F.col("processed_at"), interval).alias("interval_start"),
        )
        .agg(F.count("*").alias("value"))
        .select(
            F.lit(f"{MISS_METRIC}.{deployment}").alias("name"),
            F.lit("count").alias("type"),
            (F.col("interval_start") * 1000).alias("timestamp"),
            F.lit(interval * 1000).cast("bigint").alias("interval_ms"),
            "value",
            F.create_map(F.lit("hostRcpn"), F.col("raw_host_rcpn")).alias("attributes"),
        )
    )
