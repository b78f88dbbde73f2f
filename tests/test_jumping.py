from __future__ import annotations

import random

import pytest
from machines import ct_machine, cut_every

from wattledger.operators import ct, jumping
from wattledger.operators.skew import NO_HOT_KEYS, find_hot_keys

NODE = "key string, at bigint, seq bigint, pos int, free bigint"


def random_nodes(seed, n=3000):
    rng, rows, clock = random.Random(seed), [], 0
    for seq in range(n):
        clock += rng.choice([0, 1, 5, 300])
        at = clock - rng.choice([0, 0, 40, 2_000])
        key = "hot" if rng.random() < 0.5 else rng.choice(["=a", "=b", "=c", ""])
        rows.append((key, at, seq // 2, seq % 2, at + rng.choice([1, 30, 900, 5_000])))
    return rows


def chosen(rows, start=None):
    limit, out = dict(start or {}), set()
    for key, at, seq, pos, free in sorted(rows, key=lambda r: r[2:4]):
        if key not in limit or at >= limit[key]:
            out.add((key, seq, pos))
            limit[key] = free
    return out


@pytest.mark.parametrize("seed, width", [(1, None), (2, 500)])
def test_equals_the_sequential_rule(spark, seed, width):
    rows = random_nodes(seed)
    # Places on the line that is cut run from late times to early ones.
    cuts = NO_HOT_KEYS if width is None else cut_every(["hot", ""], width, 400_000)
    if width:
        cuts = type(cuts)(tuple((k, tuple(sorted(-c for c in at))) for k, at in cuts.cuts))
    got = jumping.jumped(spark.createDataFrame(rows, NODE), hot=cuts)
    assert {tuple(r) for r in got.collect()} == chosen(rows)


def test_limits_of_earlier_runs(spark):
    rows = random_nodes(5, 400)
    start = {"hot": 9_000, "=a": -5, "": 10**9, "=z": 1}
    limits = spark.createDataFrame(list(start.items()), "key string, free bigint")
    for way in (jumping.jumped, jumping.folded):
        got = way(spark.createDataFrame(rows, NODE), limits)
        assert {tuple(r) for r in got.collect()} == chosen(rows, start)


def test_long_keys_jump_and_short_ones_are_folded(spark, monkeypatch):
    monkeypatch.setattr(jumping, "FOLDED", 200)
    rows = random_nodes(6, 1_500)
    assert sorted({sum(r[0] == k for r in rows) > 200 for k in ("hot", "=a")}) == [False, True]
    got = jumping.acting(spark.createDataFrame(rows, NODE))
    assert {tuple(r) for r in got.collect()} == chosen(rows)


def test_no_candidates(spark):
    assert jumping.acting(spark.createDataFrame([], NODE)).collect() == []
    assert jumping.jumped(spark.createDataFrame([], NODE)).collect() == []


def test_keys_are_text_that_is_never_null(spark):
    df = spark.createDataFrame([("a",), ("",), ("=",), (None,)], "k string")
    back = df.select("k", jumping.untagged(jumping.tagged(df["k"])).alias("again"), jumping.tagged(df["k"]).alias("t"))
    assert all(r.k == r.again and r.t is not None for r in back.collect())


def test_number_of_jobs_is_the_logarithm_of_the_path(spark):
    """A path of n candidates takes as many staged tables as n has base-4 digits, give or take one."""

    def tables(n):
        seen = []
        original, jumping.stage = jumping.stage, lambda df, name: seen.append(name) or original(df, name)
        try:
            rows = spark.range(n).selectExpr("'=x' as key", "id * 10 as at", "id as seq", "0 as pos", "id * 10 + 10 as free")
            assert jumping.jumped(rows).count() == n
        finally:
            jumping.stage = original
        return len(seen)

    assert [tables(n) for n in (1, 4, 256)] == [1, 2, 5]


def test_large_key_is_cut(spark):
    rows = spark.range(20_000).selectExpr("'=x' as key", "id * 7 as at", "id as seq", "0 as pos", "id * 7 + 500 as free")
    line = rows.selectExpr("key", "-at as back", "0 as late")
    cut = find_hot_keys(line, "key", 5_000, order=("back", "late"))
    assert len(cut.cuts) == 1 and len(cut.cuts[0][1]) >= 3
    assert all(c <= 0 for _, at in cut.cuts for c in at)
    assert jumping.jumped(rows, hot=cut).count() == len({i for i in range(20_000) if i % 72 == 0})


def test_meter_checks_over_400_days(spark):
    rng, rows = random.Random(4), []
    for seq in range(9_000):
        ts = seq * 3_840 // 300 * 300 - rng.choice([0, 0, 0, 7_200])
        rows.append(("s" if seq % 5 else None, seq, 0, ts - 1, *rng.choice([(5, 1), (1, 5)]), rng.choice(["POS", "NEG", "MISSING"])))
    schema = (
        "system_id string, arrival_seq bigint, record_pos int, timestamp_utc bigint, "
        "raw_imported_ws bigint, raw_exported_ws bigint, ess_outcome string"
    )
    got = {r.arrival_seq: (r.swapped, r.checked) for r in ct.ct_inversion(spark.createDataFrame(rows, schema)).collect()}
    for system in ("s", None):
        mine = [r for r in rows if r[0] == system]
        flags, _ = ct_machine([(r[3] + 1, 1 if r[4] > r[5] else -1, r[6]) for r in mine])
        assert [got[r[1]] for r in mine] == flags
