"""Misses of system metadata: report one per host, then none until its entry has expired.

Which misses are reported depends on earlier reports. A report at time t stops further ones until t plus an
interval, so of all misses of a host in one second only the first to arrive can be one, and the rest is the choice
of `jumping` over one candidate per host and second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.operators.jumping import acting, tagged, untagged
from wattledger.operators.readings import ARRIVAL
from wattledger.session import stage

MISS_TTL_SECONDS = 15 * 60


def jittered_ttl(
    host: Column,
    at: Column,
    jitter: tuple[int, int] | None,
    seed: int = 0,
    seconds: int = MISS_TTL_SECONDS,
) -> Column:
    """Seconds an answer stays known. `jitter` is (lower, upper): an extra of lower up to
    lower + upper, the same in every run for the same answer."""
    base = F.lit(seconds).cast("bigint")
    if jitter is None:
        return base
    lower, upper = jitter
    extra = F.pmod(F.xxhash64(host, at, F.lit(seed)), F.lit(max(upper, 1)).cast("bigint"))
    return base + extra + F.lit(lower)


def with_times(misses: DataFrame) -> DataFrame:
    """Fail on a miss without a time: it could neither be reported nor be kept back."""
    failure = F.raise_error(F.lit("a miss has no processed_at")).cast("boolean")
    return misses.where(F.when(F.col("processed_at").isNotNull(), True).otherwise(failure))


def reported_misses(
    misses: DataFrame,
    state: DataFrame | None = None,
    jitter: tuple[int, int] | None = None,
    seed: int = 0,
) -> DataFrame:
    """The misses to report as (raw_host_rcpn, reported_at, expires_at), a row for each.

    `processed_at` is in whole seconds, so a host has at most one candidate per second, however many
    misses it has. `state` holds the expiry per host of earlier runs; the greatest `expires_at` of a
    host is the expiry after this one. Days without misses cost nothing, nor do stray times.
    """
    host = untagged(F.col("key"))

    def expiry(at: Column) -> Column:
        return at + jittered_ttl(host, at, jitter, seed)

    at = F.col("at")
    times = with_times(misses).select(
        tagged(F.col("raw_host_rcpn")).alias("key"), F.col("processed_at").cast("bigint").alias("at")
    )
    # The next report comes after the expiry, not at it.
    nodes = times.distinct().select(
        "key", "at", at.alias("seq"), F.lit(0).alias("pos"), (expiry(at) + 1).alias("free")
    )
    start = None
    if state is not None:
        start = state.select(tagged(F.col("host_rcpn")).alias("key"), (F.col("expires_at") + 1).alias("free"))
    found = acting(stage(nodes, "candidates"), start)
    return found.select(
        host.alias("raw_host_rcpn"), F.col("seq").alias("reported_at"), expiry(F.col("seq")).alias("expires_at")
    )


def miss_state(reported: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Expiry per host after a run, for the next run."""
    latest = reported.select(F.col("raw_host_rcpn").alias("host_rcpn"), "expires_at")
    if state is not None:
        latest = latest.unionByName(state)
    return latest.groupBy("host_rcpn").agg(F.max("expires_at").alias("expires_at"))


def suppress_misses(
    misses: DataFrame,
    state: DataFrame | None = None,
    jitter: tuple[int, int] | None = None,
    seed: int = 0,
    reported: DataFrame | None = None,
) -> DataFrame:
    """Keep the misses to report: one per host, then none until its entry has expired.

    Of several misses of a host in one second the first to arrive is kept. `reported` is the
    outcome of `reported_misses`, if known. A miss without a time fails.
    """
    if reported is None:
        reported = reported_misses(misses, state, jitter, seed)
    times = reported.select(F.col("raw_host_rcpn").alias("_host"), F.col("reported_at").alias("_at"))
    in_time = misses.join(
        times,
        F.col("raw_host_rcpn").eqNullSafe(F.col("_host"))
        & (F.col("processed_at") == F.col("_at")),
        "left_semi",
    )
    return (
        in_time.groupBy("raw_host_rcpn", "processed_at")
        .agg(F.min_by(F.struct(*misses.columns), F.struct(*ARRIVAL)).alias("_first"))
        .select("_first.*")
    )
