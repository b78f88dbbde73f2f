from __future__ import annotations

import json
import random

import pytest
from fixtures import channel, record
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.plans import daily
from wattledger.schema import ESS_ENERGY, RECORD_SETS, SYSTEMS
from wattledger.sources import sinks
from wattledger.sources.record_sets import stream_record_sets
from wattledger.streaming.job import MicroBatchJob, start

NOW = 40_000
KNOWN = [(h, f"s-{h}", "t", h != "c", "Z", None) for h in "abc"]


def random_uploads(seed, n=160):
    """Uploads of three known devices and an unknown one, with late and repeated slots."""
    rng = random.Random(seed)
    clock = dict.fromkeys("abcx", 3000)
    rows = []
    for seq in range(n):
        host = rng.choice("aaabcx")
        clock[host] += rng.choice([0, 300, 300, 900])
        ts = clock[host] - rng.choice([0, 0, 0, 600])
        rows.append((seq, "s", [record(ts, channel(host, seq * 10, rng.choice([5, 10**6])))], 100 * seq))
    return rows


SCHEMA = T.StructType([*RECORD_SETS.fields, T.StructField("processed_at", T.LongType())])


def reference_rows():
    return [
        (f"s-{h}", slot, *((1.0, 9.0) if (slot // 300) % 3 else (9.0, 1.0)))
        for h in "ab"
        for slot in range(2700, 40_000, 300)
        if slot % 1500
    ]


def test_micro_batches_equal_one_batch(spark, tmp_path):
    rows = random_uploads(1)
    folder, out = tmp_path / "in", tmp_path / "out"
    tables = {
        "systems": spark.createDataFrame(KNOWN, SYSTEMS),
        "ess": spark.createDataFrame(reference_rows(), ESS_ENERGY),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    job = MicroBatchJob(
        path=str(out),
        systems=lambda s: s.read.parquet(str(tmp_path / "systems")),
        ess=lambda s: s.read.parquet(str(tmp_path / "ess")),
        now=NOW,
    )
    for lo, hi in [(0, 50), (50, 57), (57, 160)]:
        spark.createDataFrame(rows[lo:hi], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        stream = stream_record_sets(spark, str(folder), max_files_per_trigger=1, schema=SCHEMA)
        query = start(stream, job, str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
        assert query.exception() is None

    whole = daily.run(spark.createDataFrame(rows, SCHEMA), tables["systems"], tables["ess"], NOW)
    for name in ("energy", "partner", "quality", "metrics"):
        streamed = spark.read.parquet(str(out / name)).select(getattr(whole, name).columns)
        got, want = (sorted(map(str, df.collect())) for df in (streamed, getattr(whole, name)))
        assert got == want and want, name
    letters = spark.read.json(str(out / "dead_letters")).select("dlq_key", "body")
    assert sorted(map(str, letters.collect())) == sorted(map(str, whole.dead_letters.select("dlq_key", "body").collect()))
    after = job._read_state(spark, 3)
    for name, saved in [("slots", after.slots.read()), ("ct", after.ct.read()), ("misses", after.misses)]:
        want = getattr(whole.state, name)
        saved = saved.select(want.columns)
        assert sorted(map(str, saved.collect())) == sorted(map(str, want.collect())), name


def test_a_repeated_micro_batch_gives_the_same_outcome(spark, tmp_path):
    rows = random_uploads(2, 60)
    job = MicroBatchJob(
        path=str(tmp_path),
        systems=lambda s: s.createDataFrame(KNOWN, SYSTEMS),
        ess=lambda s: s.createDataFrame(reference_rows(), ESS_ENERGY),
        now=NOW,
        outputs=("energy",),
    )

    def energy():
        return sorted(map(str, spark.read.parquet(str(tmp_path / "energy")).collect()))

    job(spark.createDataFrame(rows[:30], SCHEMA), 0)
    job(spark.createDataFrame(rows[30:], SCHEMA), 1)
    first = energy()
    job(spark.createDataFrame(rows[30:], SCHEMA), 1)
    assert energy() == first and first
    assert not (tmp_path / "partner").exists()
    with pytest.raises(Exception, match="has no state of run 2"):
        job(spark.createDataFrame(rows[30:], SCHEMA), 3)


def test_start_position(spark, tmp_path):
    spark.createDataFrame(random_uploads(3, 5), SCHEMA).write.parquet(str(tmp_path / "in"))

    def seen(start_at, name):
        stream = stream_record_sets(spark, str(tmp_path / "in"), start_at, schema=SCHEMA)
        query = (
            stream.select(F.col("arrival_seq"))
            .writeStream.format("memory")
            .queryName(name)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
        return spark.table(name).count()

    assert seen("earliest", "from_earliest") == 5
    assert seen("latest", "from_latest") == 0
    assert seen("2000-01-01T00:00:00Z", "from_2000") == 5
    assert seen("2999-01-01T00:00:00Z", "from_2999") == 0


def test_a_repeated_batch_keeps_its_clock(spark, tmp_path):
    rows = [(i, "s", [record(0, channel("x", 1, 1))]) for i in range(2)]
    job = MicroBatchJob(
        path=str(tmp_path),
        systems=lambda s: s.createDataFrame([], SYSTEMS),
        ess=lambda s: s.createDataFrame([], ESS_ENERGY),
        outputs=("metrics",),
        options={"local_mode": True},
    )
    clock = job._clock(spark, 0)
    job(spark.createDataFrame(rows, RECORD_SETS), 0)
    import time

    time.sleep(1.1)
    assert job._clock(spark, 0) == clock < job._clock(spark, 1)


def test_a_new_checkpoint_does_not_overwrite_an_old_stream(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame(random_uploads(5, 10), SCHEMA).write.parquet(str(folder))
    (tmp_path / "out" / "state").mkdir(parents=True)
    job = MicroBatchJob(str(tmp_path / "out"), systems=None, ess=None)
    stream = stream_record_sets(spark, str(folder), schema=SCHEMA)
    with pytest.raises(ValueError, match="another checkpoint"):
        start(stream, job, str(tmp_path / "checkpoint"))


def test_energy_as_keyed_messages(spark, tmp_path):
    rows = random_uploads(6, 40)
    job = MicroBatchJob(
        path=str(tmp_path),
        systems=lambda s: s.createDataFrame(KNOWN, SYSTEMS),
        ess=lambda s: s.createDataFrame(reference_rows(), ESS_ENERGY),
        now=NOW,
        outputs=("energy",),
        writers={"energy": sinks.message_writer("json")},
    )
    job(spark.createDataFrame(rows, SCHEMA), 0)
    whole = daily.run(spark.createDataFrame(rows, SCHEMA), *(f(spark) for f in (job.systems, job.ess)), NOW)
    want = sinks.keyed_messages(whole.energy).collect()
    got = spark.read.json(str(tmp_path / "energy" / "batch_id=0")).select("key", "value").collect()
    assert sorted(got) == sorted(want) and want


def test_expired_misses_leave_the_state(spark):
    uploads = [(i, "s", [record(0, channel(h, 1, 1)), record(300, channel(h, 2, 2))]) for i, h in enumerate("xy")]
    tables = spark.createDataFrame([], SYSTEMS), spark.createDataFrame([], ESS_ENERGY)

    def run(hosts, now, state):
        df = spark.createDataFrame([u for u, h in zip(uploads, "xy") if h in hosts], RECORD_SETS)
        out = daily.run(df, *tables, now, state, local_mode=True)
        known = [tuple(r) for r in out.state.misses.collect()]
        n = out.metrics.count()
        return n, sorted(known)

    n, known = run("xy", 1_000, daily.State())
    assert (n, known) == (2, [("x", 1_900), ("y", 1_900)])

    def saved(rows):
        return daily.State(misses=spark.createDataFrame(rows, "host_rcpn string, expires_at long"))

    assert run("x", 1_900, saved(known)) == (0, [("x", 1_900), ("y", 1_900)])
    assert run("x", 1_901, saved(known)) == (1, [("x", 2_801)])


def test_outputs_into_a_log_once_and_in_order(spark, tmp_path):
    from wattledger.sources.shard_log import read_messages

    rows = random_uploads(7, 60)
    logs = {name: str(tmp_path / f"{name}-log") for name in ("energy", "partner")}
    job = MicroBatchJob(
        path=str(tmp_path / "out"),
        systems=lambda s: s.createDataFrame(KNOWN, SYSTEMS),
        ess=lambda s: s.createDataFrame(reference_rows(), ESS_ENERGY),
        now=NOW,
        outputs=tuple(logs),
        writers={name: sinks.log_writer(path, 3) for name, path in logs.items()},
    )
    want = {name: [] for name in logs}
    for batch, part in enumerate((rows[:30], rows[30:])):
        df = spark.createDataFrame(part, SCHEMA)
        state = job._read_state(spark, batch)
        whole = daily.run(df, *(f(spark) for f in (job.systems, job.ess)), NOW, state)
        for name in logs:
            want[name] += [tuple(r) for r in sinks.keyed_messages(getattr(whole, name)).collect()]
        job(df, batch)
        if batch == 1:  # the batch is repeated after its outputs were written
            job(df, batch)
    for name, path in logs.items():
        found = read_messages(spark, path).orderBy("partition", "offset").collect()
        assert sorted((r.key, r.value) for r in found) == sorted(want[name]) and found
    times = {}
    for r in read_messages(spark, logs["energy"]).orderBy("partition", "offset").collect():
        times.setdefault(r.key, []).append(json.loads(r.value)["timestamp_utc"])
    assert times and all(t == sorted(t) for t in times.values())
