from __future__ import annotations

import json

import pytest
from fixtures import channel, record
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_streaming import KNOWN, NOW, SCHEMA, random_uploads, reference_rows

from wattledger.operators import readings
from wattledger.plans import daily
from wattledger.schema import ESS_ENERGY, SYSTEMS
from wattledger.sources import derived
from wattledger.sources.decode import record_json
from wattledger.sources.snapshots import FileTable
from wattledger.streaming.job import MicroBatchJob

PAYLOADS = "arrival_seq bigint, processed_at bigint, payload string"


def tables(spark):
    return spark.createDataFrame(KNOWN, SYSTEMS), spark.createDataFrame(reference_rows(), ESS_ENERGY)


def payloads_of(df):
    records = F.array_join(F.transform("record", record_json), ",")
    body = F.concat(F.lit('{"sensorId":"s","record":['), records, F.lit("]}"))
    return df.select("arrival_seq", "processed_at", body.alias("payload"))


def text(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("cut", [False, True])
def test_bad_payloads_and_times_are_set_aside(spark, cut):
    rows = random_uploads(1)
    good = spark.createDataFrame(rows, SCHEMA)
    nan = (900, "s", [record(float("nan"), channel("a", 1, 2)), record(3_300, channel("a", 3, 4))], 90_000)
    bad = [(901, 90_100, '{"sensorId":'), (902, 90_200, None), (903, 90_300, '{"record":[{"timestamp":"x"}]}')]
    mixed = payloads_of(good).unionByName(spark.createDataFrame(bad, PAYLOADS))
    timeless = payloads_of(spark.createDataFrame([nan], SCHEMA))
    hot = None
    if cut:
        from machines import cut_every

        hot = cut_every(["a", "b"], 20)
    out = daily.run(mixed.unionByName(timeless), *tables(spark), NOW, hot=hot)
    found = {(r.arrival_seq, r.record_pos): (r.reason, r.body) for r in out.quarantine.collect()}
    assert found[901, 0] == ("malformed", '{"sensorId":') and found[902, 0] == ("malformed", None)
    assert found[903, 0][0] == "malformed"
    reason, body = found[900, 0]
    assert reason == "no_time" and json.loads(body)["channel"][0]["exportedEnergyWs"] == "1"
    assert len(found) == 4
    late = (900, "s", [nan[2][1]], 90_000)
    want = daily.run(good.unionByName(spark.createDataFrame([late], SCHEMA)), *tables(spark), NOW)
    for name in ("energy", "partner", "metrics", "dead_letters"):
        assert text(getattr(out, name)) == text(getattr(want, name)), name


def test_counts_by_reason(spark):
    def up(seq, *records):
        return (seq, "s", list(records), seq)

    unnamed = channel("x", 1, 1, deviceType="SOLAR")
    rows = [
        up(0, record(NOW - 8 * 86_400, channel("a", 1, 1)), record(NOW + 1_801, channel("a", 1, 1))),
        up(1, record(float("nan"), channel("a", 1, 1)), record(NOW, channel(None, 1, 1)), record(NOW, channel("a", 1, 1))),
        up(2, record(NOW, channel("unknown", 1, 1)), record(NOW, channel("a", 1, 1))),
        up(3, record(NOW - 600, channel("b", 1, 1), unnamed), record(NOW - 300, channel("b", 1, 1), unnamed)),
    ]
    out = daily.run(spark.createDataFrame(rows, SCHEMA), *tables(spark), NOW)
    assert out.dropped == {
        "unusable_key": 4,
        "too_old": 1,
        "too_new": 1,
        "no_time": 1,
        "not_valid": 0,
    }


def test_counts_equal_further_scans(spark):
    sf = "/root/testdata/sf0.001"
    sets = derived.record_sets(spark, sf)
    now = derived.BASE_US // 1_000_000 + 18 * 3600
    out = daily.run(sets, derived.systems(spark, sf), derived.ess_energy(spark, sf), now)
    exploded = readings.explode_records(sets)
    all_records = sets.select(F.sum(F.size("record"))).first()[0]
    assert out.dropped["unusable_key"] == all_records - exploded.count() > 0
    assert out.dropped["too_new"] == exploded.count() - readings.time_range_filter(exploded, now).count() > 0
    assert out.dropped["too_old"] == out.dropped["no_time"] == 0
    valid = out._looked_up.where("system_host_rcpn is not null and not is_valid").count()
    assert out.dropped["not_valid"] == valid


def test_a_repeated_batch_reads_the_tables_as_they_were(spark, tmp_path):
    systems, ess = tables(spark)
    systems.write.parquet(str(tmp_path / "systems"))
    by_day = ess.withColumn("day", F.expr("start_ts div 86400"))
    by_day.write.partitionBy("day").parquet(str(tmp_path / "ess table"))
    job = MicroBatchJob(
        path=str(tmp_path / "out"),
        systems=FileTable(str(tmp_path / "systems")),
        ess=FileTable(str(tmp_path / "ess table")),
        now=NOW,
        outputs=("energy", "metrics"),
    )
    batch = spark.createDataFrame(random_uploads(2, 80), SCHEMA)

    def energy():
        return text(spark.read.parquet(str(tmp_path / "out" / "energy")))

    job(batch, 0)
    first = energy()
    more = [("x", "s-x", "t", True, "Z", None)]
    spark.createDataFrame(more, SYSTEMS).write.mode("append").parquet(str(tmp_path / "systems"))
    turned = ess.selectExpr(
        "system_id", "start_ts - 1 as start_ts", "lifetime_exported_ws as lifetime_imported_ws",
        "lifetime_imported_ws as lifetime_exported_ws", "start_ts div 86400 as day",
    )
    turned.write.mode("append").partitionBy("day").parquet(str(tmp_path / "ess table"))
    job(batch, 0)
    assert energy() == first and first
    other = MicroBatchJob(str(tmp_path / "fresh"), job.systems, job.ess, NOW, ("energy",))
    other(batch, 0)
    assert text(spark.read.parquet(str(tmp_path / "fresh" / "energy"))) != first


def test_pinned_table_without_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    table = FileTable(str(tmp_path / "none"), schema=SYSTEMS)
    assert table.pinned(spark, str(tmp_path / "manifest")).count() == 0
    spark.createDataFrame(KNOWN, SYSTEMS).write.mode("append").parquet(str(tmp_path / "none"))
    assert table.pinned(spark, str(tmp_path / "manifest")).count() == 0
    assert table(spark).count() == 3


def test_stream_of_payloads_goes_on_past_a_bad_one(spark, tmp_path):
    good = payloads_of(spark.createDataFrame(random_uploads(3, 40), SCHEMA))
    bad = spark.createDataFrame([(77, 7_700, "no json")], PAYLOADS)
    job = MicroBatchJob(
        str(tmp_path / "out"), systems=lambda s: tables(s)[0], ess=lambda s: tables(s)[1], now=NOW
    )
    good.unionByName(bad).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(T.StructType.fromDDL(PAYLOADS)).parquet(str(tmp_path / "in"))
    from wattledger.streaming.job import start

    query = start(stream, job, str(tmp_path / "checkpoint"))
    query.awaitTermination(300)
    assert query.exception() is None
    aside = spark.read.parquet(str(tmp_path / "out" / "quarantine")).collect()
    assert [(r.arrival_seq, r.reason, r.body) for r in aside] == [(77, "malformed", "no json")]
    counts = {r.reason: r.n for r in spark.read.parquet(str(tmp_path / "out" / "dropped")).collect()}
    assert counts["malformed"] == 1 and counts["no_time"] == 0
    whole = daily.run(spark.createDataFrame(random_uploads(3, 40), SCHEMA), *tables(spark), NOW)
    got = spark.read.parquet(str(tmp_path / "out" / "energy")).select(whole.energy.columns)
    assert text(got) == text(whole.energy)


def test_misses_without_a_time_take_the_clock(spark):
    rows = [
        (0, "s", [record(0, channel("h", 1, 1)), record(300, channel("h", 1, 1))], None),
        (1, "s", [record(600, channel("h", 1, 1))], None),
        (2, "s", [record(0, channel("g", 1, 1)), record(300, channel("g", 1, 1))], 5),
    ]
    none = spark.createDataFrame([], SYSTEMS), spark.createDataFrame([], ESS_ENERGY)
    out = daily.run(spark.createDataFrame(rows, SCHEMA), *none, 1_000, local_mode=True)
    got = sorted((r.attributes["hostRcpn"], r.timestamp, r.value) for r in out.metrics.collect())
    assert got == [("g", 0, 1), ("h", 900_000, 1)]
    assert out.dead_letters.count() == 2


