from __future__ import annotations

import random

import pytest
from fixtures import C1, E1, F1, channel, record, second_day, series, uploads
from machines import cut_every, slot_machine
from pyspark.sql import functions as F

from wattledger.operators import skew, slots
from wattledger.plans.daily import hot_devices, to_readings
from wattledger.schema import SLOT_STATE
from wattledger.session import stage

READING = (
    "host_rcpn string, arrival_seq bigint, record_pos int, event_timestamp bigint, "
    "raw_imported_ws bigint, raw_exported_ws bigint"
)
NOW = 1616546431


def random_rows(seed, n=3000, hosts=("a", "b", "c", "d")):
    """A third and more of all rows belong to host a."""
    rng = random.Random(seed)
    clock = dict.fromkeys(hosts, 300_000)
    rows = []
    for seq in range(n):
        host = "a" if rng.random() < 0.4 else rng.choice(hosts)
        clock[host] += rng.choice([0, 100, 200, 300, 300, 300, 900])
        t = clock[host] - rng.choice([0, 0, 0, 300, 1500])
        counters = [None if rng.random() < 0.1 else rng.randrange(10**6) for _ in range(2)]
        rows.append((host, seq // 2, seq % 2, t, *counters))
    return rows


def expected_classes(rows):
    out = {}
    for host in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == host), key=lambda r: r[1:3])
        classes, _ = slot_machine([(r[3] - r[3] % 300, *r[3:]) for r in mine])
        for r, (name, previous) in zip(mine, classes):
            out[r[:3]] = (name, previous[1:] if previous else None)
    return out


def result_classes(df):
    return {
        (r["host_rcpn"], r["arrival_seq"], r["record_pos"]): (
            r["slot_class"],
            tuple(r["previous"])[3:] if r["previous"] else None,
        )
        for r in df.collect()
    }


def cuts(rows):
    return [
        skew.NO_HOT_KEYS,
        cut_every("a", 100),
        cut_every("ac", 7),
        cut_every("abcd", 50),
    ]


@pytest.mark.parametrize("table", [None, lambda df: stage(df, "chunks")])
@pytest.mark.parametrize("cut", range(4))
@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_the_sequential_rule(spark, seed, cut, table):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, READING)
    got = result_classes(slots.slot_classify(df, hot=cuts(rows)[cut], materialize=table))
    assert got == expected_classes(rows)
    assert {c for c, _ in got.values()} == {"FIRST", "DUPLICATE", "LATE", "GAP", "EMIT"}


@pytest.mark.parametrize("hot", [skew.NO_HOT_KEYS, cut_every("a", 60)])
def test_runs_with_state_equal_one_run(spark, hot):
    rows = random_rows(3, n=1200)
    rng = random.Random(4)
    at = sorted(rng.sample(range(1, 600), 3))
    parts = [
        [r for r in rows if lo <= r[1] < hi] for lo, hi in zip([0, *at], [*at, 10**9])
    ]
    state, got = None, {}
    for part in parts:
        df = spark.createDataFrame(part, READING)
        got |= result_classes(slots.slot_classify(df, state, hot))
        after = slots.slot_state(df, state).collect()
        state = spark.createDataFrame(after, SLOT_STATE)
    assert got == expected_classes(rows)


def test_a_reading_without_a_time_is_neither_classified_nor_remembered(spark):
    rows = [("a", 0, 0, 300, 1, 1), ("a", 1, 0, None, 2, 2), ("a", 2, 0, 600, 3, 3)]
    df = spark.createDataFrame(rows, READING)
    got = result_classes(slots.slot_classify(df))
    assert [got[("a", i, 0)][0] for i in range(3)] == ["FIRST", None, "EMIT"]
    assert slots.slot_state(df).first()["slot"] == 600


def test_hot_keys_are_found_and_split_evenly(spark):
    rows = random_rows(5)
    df = spark.createDataFrame(rows, READING)
    hot = skew.find_hot_keys(df, "host_rcpn", rows_per_task=1000)
    assert hot.keys == ("a",)
    chunks = hot.split(df.where("host_rcpn = 'a'"), "host_rcpn", "chunk").groupBy("chunk").count()
    sizes = [r["count"] for r in chunks.collect()]
    assert len(sizes) > 1 and max(sizes) <= 1100
    assert skew.find_hot_keys(df, "host_rcpn") == skew.NO_HOT_KEYS


def test_a_burst_is_cut_by_rows(spark):
    """99 of 100 rows of a device, NULL included, lie in a thousandth of its arrival numbers."""
    burst = F.when(F.col("id") % 100 == 0, F.col("id") * 1000).otherwise(10**7 + F.col("id") % 40_000)
    df = spark.range(80_000).select(
        F.when(F.col("id") % 2 == 0, "a").alias("host_rcpn"), burst.alias("arrival_seq"),
        (F.col("id") % 7).cast("int").alias("record_pos"),
    )
    hot = skew.find_hot_keys(df, "host_rcpn", rows_per_task=2_000)
    assert set(hot.keys) == {"a", None}
    sizes = hot.split(df, "host_rcpn", "chunk").groupBy("host_rcpn", "chunk").count().collect()
    assert len(sizes) > 30 and max(r["count"] for r in sizes) <= 4_000


def test_many_hot_keys_keep_the_list_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "LISTED_CUTS", 6)
    rows = random_rows(6)
    df = spark.createDataFrame(rows, READING)
    hot = skew.find_hot_keys(df, "host_rcpn", rows_per_task=100)
    assert 0 < sum(len(c) for _, c in hot.cuts) <= 6
    assert result_classes(slots.slot_classify(df, hot=hot)) == expected_classes(rows)


def test_large_devices_share_one_exchange(spark):
    df = spark.createDataFrame(random_rows(7), READING)
    plan = (
        slots.slot_classify(df, hot=cut_every("a", 100))
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # rows by (host, chunk), chunk maxima by (host, chunk), then by host
    assert plan.count("Exchange hashpartitioning") <= 4


@pytest.mark.parametrize(
    "rows, deltas, seconds, imported, exported",
    [
        (series(C1), 8, {300, 301, 303}, 1_640_416, 0),
        (series(E1), 8, {300, 301, 303}, 1_640_416, 0),
        (second_day(C1), 1, {300}, 147_936, -300),
    ],
)
def test_sample_series(spark, rows, deltas, seconds, imported, exported):
    df = slots.energy_delta(slots.slot_classify(to_readings(uploads(spark, rows), NOW)))
    got = df.collect()
    assert len(got) == deltas
    assert {r["time_delta_seconds"] for r in got} == seconds
    assert sum(r["delta_imported_ws"] for r in got) == imported
    assert sum(r["delta_exported_ws"] for r in got) == exported
    assert all(r["timestamp_utc"] % 300 == 299 for r in got)


def test_missing_and_falling_counters(spark):
    rows = [
        ("s", [record(300, channel("a", 100, 50))]),
        ("s", [record(600, channel("a", 90, None))]),
        ("s", [record(901, channel("a", None, 70))]),
        ("s", [record(1200, channel("a", 2**63 - 1, 80))]),
        ("s", [record(1500, channel("a", -5, 80))]),
    ]
    df = slots.energy_delta(slots.slot_classify(to_readings(uploads(spark, rows), 1500)))
    got = [
        (r["time_delta_seconds"], r["delta_imported_ws"], r["delta_exported_ws"])
        for r in df.orderBy("timestamp_utc").collect()
    ]
    # The last difference does not fit a bigint.
    assert got == [(300, -10, None), (301, None, None), (299, None, 10), (300, None, 0)]


def test_quality_events(spark):
    rows = [("s", [record(t, channel("a", 1, 1))]) for t in (300, 1500, 900)]
    df = slots.quality_events(slots.slot_classify(to_readings(uploads(spark, rows), 1500)))
    got = [tuple(r) for r in df.orderBy("arrival_seq").drop("arrival_seq", "record_pos").collect()]
    late = "Was expecting 1970-01-01T00:30:00Z timestamp, but got 1970-01-01T00:15:00Z"
    gap = "Was expecting 1970-01-01T00:10:00Z timestamp, but got 1970-01-01T00:25:00Z"
    assert got == [("a", "Future_Event", 600, 1500, gap), ("a", "Late_Event", 1800, 900, late)]


def test_hot_devices_from_uploads(spark, monkeypatch):
    from wattledger.plans import daily

    monkeypatch.setattr(daily, "HOT_SAMPLE", 1.0)
    monkeypatch.setattr(daily.find_hot_keys, "__defaults__", (5, 1.0, ("arrival_seq", "record_pos")))
    sets = uploads(spark, series(F1) + second_day(C1))
    assert hot_devices(sets).keys == (F1,)
