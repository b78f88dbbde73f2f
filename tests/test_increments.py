from __future__ import annotations

import random

import pytest
import test_ct
import test_slots
from fixtures import channel, record
from machines import cut_every
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import SCHEMA

from wattledger.operators import ct, skew, slots
from wattledger.plans import daily
from wattledger.schema import CT_STATE, ESS_ENERGY, SLOT_STATE, SYSTEMS
from wattledger.session import children, stage
from wattledger.sources.increments import Increments
from wattledger.streaming.job import MicroBatchJob

ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def content(df):
    return {r.k: r.v for r in df.collect()}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fanout", [2, 3])
def test_versions_merge_into_what_was_put(spark, tmp_path, fanout):
    rng, want, at = random.Random(fanout), {}, {}
    table = Increments(str(tmp_path / "it's"), ROW, "k", 3, fanout)
    with pytest.raises(ValueError, match="no state of run 0"):
        table.at(spark, 0)
    for version in range(10):
        changed = {rng.choice(["a", "b", "", None, "é", f"n{version}"]): 10 * version + i for i in range(3)}
        for _ in range(2 if version in (2, 3, 7) else 1):
            table.put(spark.createDataFrame(list(changed.items()), ROW), version)
        want |= changed
        at[version] = dict(want)
        if version in (3, 5, 8):
            assert content(table.at(spark, version - 1).read()) == at[version - 1]
            table.tidy(spark, version - 1)
            assert content(table.at(spark, version).read()) == want
    assert content(table.at(spark, 9).read()) == want
    assert len(children(spark, table.path)) <= 2 * (fanout - 1) * 4

    saved = table.at(spark, 9)
    keys = [*want, "unknown"]
    rows = spark.createDataFrame([(k, n) for n in range(3) for k in keys], "k string, n int")
    got = saved.joined(saved.placed(rows, "k"), "s").collect()
    assert sorted((str(r.k), r.n, str(r.s and r.s.v)) for r in got) == sorted(
        (str(k), n, str(want.get(k))) for k in keys for n in range(3)
    )


def test_a_row_that_is_not_kept_hides_older_rows(spark, tmp_path):
    table = Increments(str(tmp_path / "t"), ROW, "k", 2)
    table.put(spark.createDataFrame([("a", 9), ("b", 9)], ROW), 0)
    table.put(spark.createDataFrame([("a", 1)], ROW), 1)
    saved = table.at(spark, 1, F.col("v") >= 5)
    assert content(saved.read()) == {"b": 9}
    rows = saved.joined(saved.placed(spark.createDataFrame([("a",), ("b",)], "k string"), "k"), "s")
    assert {r.k: r.s and r.s.v for r in rows.collect()} == {"a": None, "b": 9}


def test_an_unfinished_folder_and_another_number_of_buckets(spark, tmp_path):
    table = Increments(str(tmp_path / "t"), ROW, "k", 4)
    table.put(spark.createDataFrame([("a", 1), ("b", 1)], ROW), 0)
    wider = Increments(str(tmp_path / "t"), ROW, "k", 6)
    wider.put(spark.createDataFrame([("a", 2)], ROW), 1)
    wider.put(spark.createDataFrame([("c", 3)], ROW), 2)
    saved = wider.at(spark, 2)
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = saved.joined(saved.placed(rows, "k"), "s").collect()
    assert {r.k: r.s.v for r in got} == content(saved.read()) == {"a": 2, "b": 1, "c": 3}
    (tmp_path / "t" / "2-2-6" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="no state of run 2"):
        wider.at(spark, 2)


def _saved(spark, path, state, schema):
    """A state in two versions, the first of which also holds older rows."""
    rows, key = [tuple(r) for r in state.collect()], schema.names[0]
    table = Increments(path, schema, key, 3)
    old = [tuple(0 if type(v) is int else v for v in r) for r in rows[::2]] + rows[1::2]
    table.put(spark.createDataFrame(old, schema), 0)
    table.put(spark.createDataFrame(rows[::2], schema), 1)
    return table.at(spark, 1)


@pytest.mark.parametrize("hot", [skew.NO_HOT_KEYS, cut_every("ac", 70), cut_every(["a", None], 900)])
def test_slots_from_saved_increments(spark, tmp_path, hot):
    rows = test_slots.random_rows(5, n=900, hosts=("a", "b", "c", None, "e"))
    first, second = (spark.createDataFrame(r, test_slots.READING) for r in (rows[:400], rows[400:]))
    before = slots.slot_classify(first, hot=hot)
    state = slots.slot_changes(before)
    assert sorted(map(str, state.collect())) == sorted(map(str, slots.slot_state(first).collect()))
    saved = _saved(spark, str(tmp_path / "s"), state, SLOT_STATE)
    want = slots.slot_classify(second, slots.slot_state(first), hot)
    for table in (None, lambda df: stage(df, "chunks")):
        got = slots.slot_classify(second, saved, hot, table)
        assert test_slots.result_classes(got) == test_slots.result_classes(want)
        assert sorted(got.columns) == sorted(want.columns)
    # What has changed, over what was saved, is the whole state.
    whole = {r.host_rcpn: r for r in state.collect()} | {r.host_rcpn: r for r in slots.slot_changes(got).collect()}
    assert sorted(map(str, whole.values())) == sorted(
        map(str, slots.slot_state(second, slots.slot_state(first)).collect())
    )


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("hot", test_ct.CUTS)
def test_checks_from_saved_increments(spark, tmp_path, hot, bounded):
    rows = test_ct.random_rows(8, n=1200)
    first, second = (spark.createDataFrame(r, test_ct.ROW) for r in (rows[:600], rows[600:]))
    state = ct.ct_state(ct.ct_decisions(first, interval=3600))
    saved = _saved(spark, str(tmp_path / "s"), state, CT_STATE)
    made = ct.ct_decisions(second, saved, 3600, bounded)
    want = ct.ct_decisions(second, state, 3600, bounded)
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
    got = ct.ct_inversion(second, saved, 3600, made, hot)
    assert test_ct.result_flags(got) == test_ct.result_flags(ct.ct_inversion(second, state, 3600, want, hot))


def test_the_state_is_not_shuffled(spark, tmp_path):
    rows = test_slots.random_rows(5, n=200)
    state = slots.slot_state(spark.createDataFrame(rows, test_slots.READING))
    table = Increments(str(tmp_path / "s"), SLOT_STATE, "host_rcpn", 5)
    for version in range(3):
        table.put(state, version)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        saved = table.at(spark, 2)
        readings = stage(spark.createDataFrame(rows, test_slots.READING), "readings")
        narrow = plan(slots.slot_classify(readings, saved, skew.NO_HOT_KEYS))
        merged = plan(slots.slot_classify(readings, saved.read(), skew.NO_HOT_KEYS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # One shuffle, of the readings, and one sort of them for the window and the three joins.
    assert narrow.count("Exchange") == 1 < merged.count("Exchange") and narrow.count("Bucketed: true") == 3
    assert narrow.count("Sort [") == 1 + 3


def test_a_batch_writes_only_changed_keys(spark, tmp_path):
    def batch(number, hosts, at):
        records = [record(at, channel(h, number * 10, 1)) for h in hosts]
        return spark.createDataFrame(
            [(number * 100 + i, "s", [r], at) for i, r in enumerate(records)], SCHEMA
        )

    def job(path, **options):
        known = [(h, f"s-{h}", "t", True, "Z", None) for h in "ab"]
        return MicroBatchJob(
            str(tmp_path / path),
            systems=lambda s: s.createDataFrame(known, SYSTEMS),
            ess=lambda s: s.createDataFrame([], ESS_ENERGY),
            now=40_000,
            outputs=("energy", "quality"),
            state_buckets=2,
            **options,
        )

    batches = [("abc", 3_000), ("ab", 3_300), ("b", 3_600), ("b", 3_000), ("abc", 3_900)]
    run, state = job("out"), daily.State()
    systems, ess = run.systems(spark), run.ess(spark)
    for n, (hosts, at) in enumerate(batches):
        for _ in range(2 if n in (1, 3) else 1):
            run(batch(n, hosts, at), n)
        after = daily.run(batch(n, hosts, at), systems, ess, 40_000, state).state
        state = daily.State(*(stage(getattr(after, part), part) for part in ("slots", "ct", "misses")))
        saved = run._read_state(spark, n + 1)
        assert sorted(map(str, saved.slots.read().collect())) == sorted(map(str, state.slots.collect()))
        assert sorted(map(str, saved.ct.read().collect())) == sorted(map(str, state.ct.collect()))
        folder = str(tmp_path / "out" / "state" / "slots" / f"{n}-{n}-2")
        written = {r.host_rcpn for r in spark.read.schema(SLOT_STATE).parquet(folder).collect()}
        # The fourth batch is late: it changes nothing.
        assert written == (set(hosts) if n != 3 else set())

    # Nothing of a batch is accepted: what it left out is counted all the same, with a state and without one.
    excluded = spark.conf.get("spark.sql.adaptive.optimizer.excludedRules", None)
    for before in (saved, daily.State()):
        out = daily.run(stage(batch(9, "ab", 40_000 + 3_600), "late"), systems, ess, 40_000, before)
        assert out.dropped["too_new"] == 2 and not out.changed.slots.count()
    assert spark.conf.get("spark.sql.adaptive.optimizer.excludedRules", None) == excluded

    # Devices that are too old start over.
    old = job("old", state_max_age=36_700)
    for n, (hosts, at) in enumerate(batches[:3]):
        old(batch(n, hosts, at), n)
    assert {r.host_rcpn for r in old._read_state(spark, 3).slots.read().collect()} == {"a", "b"}
