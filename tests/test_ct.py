from __future__ import annotations

import random

import pytest
from fixtures import C1, E1, F1, SERIES, ess
from machines import ct_machine, cut_every

from wattledger.operators import ct, skew
from wattledger.schema import CT_STATE, ESS_ENERGY
from wattledger.sources.increments import Increments

ROW = (
    "system_id string, arrival_seq bigint, record_pos int, timestamp_utc bigint, "
    "raw_imported_ws bigint, raw_exported_ws bigint, ess_outcome string"
)


def random_rows(seed, n=2500):
    rng = random.Random(seed)
    rows = []
    clock = 300_000
    for seq in range(n):
        clock += rng.choice([0, 0, 300, 300, 1800])
        ts = clock - rng.choice([0, 0, 0, 600, 30_000])
        imported, exported = rng.choice([(5, 1), (1, 5), (3, 3), (None, 1), (9, 2)])
        outcome = rng.choice(["MISSING", "MISSING", "EQUAL", "POS", "NEG"])
        system = "s0" if rng.random() < 0.4 else rng.choice(["s0", "s1", "s2", "s3", "s4", None])
        rows.append((system, seq // 3, seq % 3, ts - 1, imported, exported, outcome))
    return rows


def sign(row):
    imported, exported = row[4], row[5]
    if imported is None or exported is None or imported == exported:
        return 0
    return 1 if imported > exported else -1


def expected_flags(rows, interval):
    out, states = {}, {}
    for system in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == system), key=lambda r: r[1:3])
        flags, state = ct_machine([(r[3] + 1, sign(r), r[6]) for r in mine], None, interval)
        out |= {r[:3]: flag for r, flag in zip(mine, flags)}
        if state:
            states[system] = state
    return out, states


def result_flags(df):
    return {
        (r["system_id"], r["arrival_seq"], r["record_pos"]): (r["swapped"], r["checked"])
        for r in df.collect()
    }


CUTS = [skew.NO_HOT_KEYS, cut_every(["s0"], 60), cut_every(["s0", "s1", "s2", None], 33)]


@pytest.mark.parametrize("hot", CUTS)
@pytest.mark.parametrize("seed, interval", [(1, 300), (1, 21600), (2, 3600), (2, 21600)])
def test_flags_equal_the_sequential_rule(spark, seed, interval, hot):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, ROW)
    flags, states = expected_flags(rows, interval)
    assert result_flags(ct.ct_inversion(df, interval=interval, hot=hot)) == flags
    for bounded in (True, False):
        after = ct.ct_state(ct.ct_decisions(df, interval=interval, bounded=bounded)).collect()
        assert {r["system_id"]: (r["swapped"], r["valid_until"]) for r in after} == states


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("hot", CUTS)
def test_runs_with_state_equal_one_run(spark, hot, bounded):
    rows = random_rows(3)
    flags, states = expected_flags(rows, 21600)
    state, got = None, {}
    for lo, hi in [(0, 40), (40, 45), (45, 400), (400, 10**9)]:
        df = spark.createDataFrame([r for r in rows if lo <= r[1] < hi], ROW)
        decisions = ct.ct_decisions(df, state, bounded=bounded)
        got |= result_flags(ct.ct_inversion(df, state, decisions=decisions, hot=hot))
        after = ct.ct_state(decisions, state).collect()
        state = spark.createDataFrame(after, CT_STATE)
    assert got == flags
    assert {r["system_id"]: (r["swapped"], r["valid_until"]) for r in state.collect()} == states


def test_saved_decision_holds_where_nothing_new_is_decided(spark):
    state = spark.createDataFrame([("s", True, 10_000), ("t", True, 0)], CT_STATE)
    rows = [
        ("s", 0, 0, 2_999, 5, 1, "POS"),
        ("s", 1, 0, 10_199, 5, 1, "MISSING"),
        ("s", 2, 0, 10_499, 5, 1, "EQUAL"),
        ("s", 3, 0, 10_799, 5, 1, "MISSING"),
        ("t", 0, 0, 2_999, 5, 5, "POS"),
    ]
    df = spark.createDataFrame(rows, ROW)
    got = result_flags(ct.ct_inversion(df, state))
    assert [got[("s", i, 0)] for i in range(4)] == [
        (True, False),
        (True, True),
        (False, True),
        (True, True),
    ]
    assert got[("t", 0, 0)] == (False, False)
    kept = ct.ct_state(ct.ct_decisions(df, state), state).collect()
    assert sorted(map(tuple, kept)) == [("s", True, 10_000), ("t", True, 0)]


def spaced_rows(host, exported=None):
    """Eight readings half an hour apart."""
    start = 1616545800
    return [
        (f"systemId-{host}", i, 0, start + 1800 * i - 1, e, exported or 1318551904)
        for i, (_, e, _) in enumerate(SERIES[1:])
    ]


def looked_up(spark, rows, outcomes):
    schema = ROW.rsplit(",", 1)[0]
    return ct.ess_lookup(spark.createDataFrame(rows, schema), outcomes)


@pytest.mark.parametrize("host, swapped", [(E1, True), (C1, False)])
def test_checks_are_made_once_per_interval(spark, host, swapped):
    rows = spaced_rows(host)
    reference = ess(spark, [r[3] + 1 - 300 for r in rows])
    got = result_flags(ct.ct_inversion(looked_up(spark, rows, reference), interval=3600))
    assert len(got) == 8
    assert {f for f, _ in got.values()} == {swapped}
    assert sum(c for _, c in got.values()) == 4


@pytest.mark.parametrize(
    "counters, checks", [((1318551904, 1318551904), 0), ((40481738496, 1318551604), 1)]
)
def test_equal_counters_decide_nothing(spark, counters, checks):
    rows = [(f"systemId-{F1}", 0, 0, 1616544299, *counters)]
    df = looked_up(spark, rows, ess(spark, [1616544000]))
    assert list(result_flags(ct.ct_inversion(df)).values()) == [(False, checks == 1)]
    assert ct.ct_state(ct.ct_decisions(df)).count() == 0


def test_first_reference_reading_of_the_slot_before(spark):
    reference = spark.createDataFrame(
        [
            ("s", 310, 1.0, 2.0),
            ("s", 305, 2.0, 1.0),
            ("s", 600, 1.0, 9.0),
            ("t", 300, None, 0.0),
            ("u", 0, 5.0, 1.0),
        ],
        ESS_ENERGY,
    )
    rows = [(s, i, 0, 599, 1, 2) for i, s in enumerate("stuv")]
    got = looked_up(spark, rows, reference).collect()
    assert {r["system_id"]: r["ess_outcome"] for r in got} == {
        "s": "POS",
        "t": "EQUAL",
        "u": "MISSING",
        "v": "MISSING",
    }


def test_correction_exchanges_everything(spark):
    schema = (
        "raw_imported_ws bigint, raw_exported_ws bigint, delta_imported_ws bigint, "
        "delta_exported_ws bigint, swapped boolean"
    )
    df = spark.createDataFrame([(1, 2, 3, None, True), (1, 2, 3, None, False)], schema)
    assert sorted(map(tuple, ct.ct_correct(df).collect()), key=str) == [
        (1, 2, 3, None, False),
        (2, 1, None, 3, True),
    ]


@pytest.mark.parametrize("form", ["none", "rows", "saved"])
@pytest.mark.parametrize("hot", CUTS)
@pytest.mark.parametrize("seed", [4, 5])
def test_narrow_checks_give_the_same_flags(spark, tmp_path, seed, hot, form):
    rows = random_rows(seed, 1200)
    first, second = (spark.createDataFrame(r, ROW) for r in (rows[:500], rows[500:]))
    state = saved = None
    if form != "none":
        state = saved = ct.ct_state(ct.ct_decisions(first, interval=3600))
    if form == "saved":
        table = Increments(str(tmp_path / "s"), CT_STATE, "system_id", 3)
        table.put(state, 0)
        saved = table.at(spark, 0)
    want = result_flags(ct.ct_inversion(second, state, 3600, hot=hot))
    needed = [c for c in second.columns if c != "ess_outcome"]
    checks = second.where("raw_imported_ws != raw_exported_ws")
    got = ct.ct_apply(second.select(needed), checks, saved, 3600, hot=hot)
    assert result_flags(got) == want and sorted(got.columns) == sorted([*needed, "swapped", "checked"])
    assert len({f for f in want.values()}) == 4


def test_only_narrow_rows_are_looked_up(spark):
    rows = spark.createDataFrame(
        [("s", 1, 0, 3_299, 5, 1, True, "x"), ("s", 2, 0, 3_299, 3, 3, True, "x"), ("s", 3, 0, 3_299, 5, 1, False, "x")],
        "system_id string, arrival_seq bigint, record_pos int, timestamp_utc bigint, raw_imported_ws bigint, "
        "raw_exported_ws bigint, is_registered boolean, record string",
    )
    got = ct.check_rows(rows, spark.createDataFrame([("s", 3_000, 1.0, 2.0)], ESS_ENERGY))
    assert [(r.arrival_seq, r.ess_outcome) for r in got.collect()] == [(1, "NEG")]
    assert "record" not in got.columns
