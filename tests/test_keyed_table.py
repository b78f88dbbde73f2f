from __future__ import annotations

import random

from fixtures import channel, record
from test_streaming import SCHEMA

from wattledger.schema import ESS_ENERGY, SYSTEMS
from wattledger.sources import sinks
from wattledger.sources.keyed_table import KeyedTable
from wattledger.streaming.job import MicroBatchJob

ROW = "k string, seq bigint, v string"


def content(df):
    return {} if df is None else {r.k: r.v for r in df.collect()}


def test_later_versions_replace_earlier_ones(spark, tmp_path):
    rng, table, want, at = random.Random(1), KeyedTable(str(tmp_path / "t"), "k", 4), {}, {}
    assert table.read(spark) is None and table.get(spark, "k1") is None
    for version in range(5):
        rows = [(rng.choice(["k1", "k2", "k3", "é", None, f"n{version}"]), seq, f"{version}.{seq}") for seq in range(8)]
        rng.shuffle(rows)
        for k, _, v in sorted(rows, key=lambda r: r[1]):
            want[k] = v
        at[version] = dict(want)
        for _ in range(2 if version in (1, 4) else 1):
            table.put(spark.createDataFrame(rows, ROW), version, ("seq",))
        if version == 2:
            table.compact(spark, 2)
            table.compact(spark, 2)
        assert content(table.read(spark)) == want
    assert [content(table.read(spark, v)) for v in range(5)] == [at[v] for v in range(5)]
    found = table.get(spark, "k2")
    assert content(found) == {"k2": want["k2"]}
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().toString()
    table.clean(spark)
    assert content(table.read(spark)) == want and table.read(spark, 1) is None


def test_an_unfinished_put_is_not_read(spark, tmp_path):
    table = KeyedTable(str(tmp_path), "k")
    table.put(spark.createDataFrame([("a", 1, "x")], ROW), 0)
    table.put(spark.createDataFrame([("a", 2, "y")], ROW), 1)
    (tmp_path / "put" / "version=1" / "_SUCCESS").unlink()
    assert content(table.read(spark)) == {"a": "x"}


def test_two_letters_of_one_key_leave_one(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "letters"), "dlq_key")
    job = MicroBatchJob(
        str(tmp_path / "out"),
        systems=lambda s: s.createDataFrame([], SYSTEMS),
        ess=lambda s: s.createDataFrame([], ESS_ENERGY),
        now=40_000,
        outputs=("dead_letters",),
        writers={"dead_letters": sinks.upsert_writer(table)},
    )

    def batch(device, number, mode):
        # Two devices whose outputs name no inverter: both letters lie under the key of an unknown host.
        solar = channel("s", 1, 1, deviceType="SOLAR")
        records = [record(t, channel(device, 1, 1), solar, mode=mode) for t in (3_000, 3_300)]
        return spark.createDataFrame([(number, "s", records, 1_000 * number)], SCHEMA)

    job(batch("d1", 1, "SELL"), 0)
    job(batch("d2", 2, "GRID_TIE"), 1)
    job(batch("d2", 2, "GRID_TIE"), 1)
    letters = table.read(spark).collect()
    assert [r.dlq_key for r in letters] == ["1970-01-01/null/3300.json"]
    assert "GRID_TIE" in letters[0].body
