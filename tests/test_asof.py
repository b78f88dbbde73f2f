from __future__ import annotations

import random

import pytest

from wattledger.operators import enrich, jumping, skew
from wattledger.schema import CACHE_STATE, SYSTEMS

READING = "raw_host_rcpn string, processed_at bigint, arrival_seq bigint, record_pos int"
VERSION = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SYSTEMS) + ", valid_from bigint"


def version(host, at, name):
    return (host, f"s-{host}", name, True, "Z", None, at)


def cached(rows, versions, memory):
    """The sequential rule: an answer is kept for its time, whatever happens to the table meanwhile."""
    out = {}
    for host, at, seq, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        kept = memory.get(host)
        if kept is None or at > kept[1]:
            known = [v for v in versions if v[0] == host and host is not None and v[-1] <= at]
            found = max(known, key=lambda v: v[-1]) if known else None
            memory[host] = kept = (at, at + (14_400 if found else 900), found and found[2])
        out[seq] = kept
    return out


def result(df):
    return {r.arrival_seq: (r.asked_at, r.expires_at, r.site_id) for r in df.collect()}


def test_a_change_is_seen_at_the_next_question_and_not_before(spark):
    versions = spark.createDataFrame([version("h", 100, "old"), version("h", 200, "new")], VERSION)
    times = [99, 998, 999, 1_000, 15_400, 15_401]
    rows = [("h", t, i, 0) for i, t in enumerate(times)]
    got = result(enrich.enrich_systems_asof(spark.createDataFrame(rows, READING), versions))
    # Unknown at 99 for 900 seconds; then known for four hours.
    assert [got[i] for i in range(6)] == [
        (99, 999, None),
        (99, 999, None),
        (99, 999, None),
        (1_000, 15_400, "new"),
        (1_000, 15_400, "new"),
        (15_401, 29_801, "new"),
    ]
    early = result(enrich.enrich_systems_asof(spark.createDataFrame([("h", 150, 0, 0), ("h", 14_550, 1, 0), ("h", 14_551, 2, 0)], READING), versions))
    assert [early[i][2] for i in range(3)] == ["old", "old", "new"]


def test_equals_the_sequential_rule_over_runs(spark, monkeypatch):
    rng = random.Random(3)
    versions = [version(h, at, f"{h}{at}") for h in ("a", "b") for at in sorted(rng.sample(range(2_000, 200_000), 25))]
    rows, clock = [], 0
    for seq in range(1_500):
        clock += rng.choice([0, 1, 60, 400])
        rows.append((rng.choice(["a", "a", "b", "x", None]), clock, seq, 0))
    table, memory, state = spark.createDataFrame(versions, VERSION), {}, None
    for lo, hi, longest in [(0, 400, 4_096), (400, 410, 4_096), (410, 1_500, 100)]:
        monkeypatch.setattr(jumping, "FOLDED", longest)
        df = spark.createDataFrame(rows[lo:hi], READING)
        got = enrich.enrich_systems_asof(df, table, state)
        assert result(got) == cached(rows[lo:hi], versions, memory)
        after = enrich.answers(got, state).collect()
        state = spark.createDataFrame(after, CACHE_STATE)
    assert {r.host_rcpn: (r.asked_at, r.expires_at) for r in state.collect()} == {h: m[:2] for h, m in memory.items()}


def test_a_large_host_is_cut(spark, monkeypatch):
    original = skew.find_hot_keys
    monkeypatch.setattr(enrich, "find_hot_keys", lambda df, key, order: original(df, key, 300, order=order))
    rows = [("big" if i % 3 else f"h{i % 50}", i * 20, i, 0) for i in range(3_000)]
    versions = [version("big", at, f"v{at}") for at in range(0, 60_000, 7_000)]
    table = spark.createDataFrame(versions, VERSION)
    got = result(enrich.enrich_systems_asof(spark.createDataFrame(rows, READING), table))
    assert got == cached(rows, versions, {})


def test_jitter_prolongs_and_missing_times_fail(spark):
    table = spark.createDataFrame([version("h", 0, "v")], VERSION)
    rows = spark.createDataFrame([("h", 10, 0, 0), ("x", 10, 1, 0)], READING)
    got = result(enrich.enrich_systems_asof(rows, table, jitter=(5, 1)))
    assert got == {0: (10, 14_415, "v"), 1: (10, 915, None)}
    with pytest.raises(Exception, match="no processed_at"):
        enrich.enrich_systems_asof(spark.createDataFrame([("h", None, 0, 0)], READING), table).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], VERSION)
    assert enrich.enrich_systems_asof(spark.createDataFrame([], READING), none).collect() == []
    one = spark.createDataFrame([("h", 1, 0, 0)], READING)
    assert result(enrich.enrich_systems_asof(one, none)) == {0: (1, 901, None)}
