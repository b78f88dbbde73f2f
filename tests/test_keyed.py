from __future__ import annotations

import random

import pytest
from fixtures import channel, record
from pyspark.sql import functions as F
from test_ct import ROW
from test_ct import random_rows as ct_rows
from test_misses import MISS, expected_reports, random_misses
from test_streaming import KNOWN, NOW, SCHEMA, random_uploads, reference_rows

from wattledger.operators import ct, slots
from wattledger.plans import daily
from wattledger.schema import ESS_ENERGY, SYSTEMS
from wattledger.streaming import keyed

READING = (
    "host_rcpn string, arrival_seq bigint, record_pos int, event_timestamp bigint, "
    "raw_imported_ws bigint, raw_exported_ws bigint, note string"
)


def streamed(spark, tmp_path, parts, schema, operator):
    """Rows of `operator` over the parts, one micro-batch each, stopped and started again between them."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        query = (
            operator(stream)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(300)
        assert query.exception() is None
    return spark.read.parquet(out)


def split(rows, seed, n=3):
    at = sorted(random.Random(seed).sample(range(1, len(rows)), n - 1))
    return [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)])]


def same(got, want):
    names = sorted(want.columns)
    a, b = (sorted(map(str, df.select(names).collect())) for df in (got, want))
    assert a == b and a


@pytest.fixture(params=["memory", "rocksdb"])
def store(request, spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    if request.param == "rocksdb":
        keyed.use_rocksdb(spark)
    yield request.param
    spark.conf.unset(key)


def test_classes_equal_the_batch_form(spark, tmp_path, store):
    rng, rows, clock = random.Random(11), [], 10**6
    for seq in range(400):
        clock += rng.choice([0, 100, 300, 300, 900])
        t = None if rng.random() < 0.03 else clock - rng.choice([0, 0, 900])
        big = (1 << 62) + seq
        rows.append((rng.choice(["a", "a", "b", None]), seq, 0, t, rng.choice([None, big]), big, rng.choice([None, 'x"y'])))
    got = streamed(spark, tmp_path, split(rows, 1), READING, keyed.classified)
    want = slots.slot_classify(spark.createDataFrame(rows, READING)).where("slot_class is not null")
    narrow = F.struct(*[F.col(f"previous.{c}") for c in ("slot", "event_timestamp", "raw_imported_ws", "raw_exported_ws")])
    same(got, want.withColumn("previous", F.when(F.col("previous").isNotNull(), narrow)))


def test_flags_equal_the_batch_form(spark, tmp_path):
    rows = ct_rows(7, 900)
    got = streamed(spark, tmp_path, split(rows, 2), ROW, keyed.flagged)
    same(got, ct.ct_inversion(spark.createDataFrame(rows, ROW)))


def test_reports_equal_the_sequential_rule(spark, tmp_path):
    rows = random_misses(9, 600)
    got = streamed(spark, tmp_path, split(rows, 3), MISS, keyed.suppressed)
    assert set(map(tuple, got.collect())) == expected_reports(rows)[0]


def test_chained_queries_equal_one_batch(spark, tmp_path):
    rows = random_uploads(4, 150)
    rows += [(150 + i, "s", [record(9_000 + 300 * i, channel("a", None if i == 2 else 5, 6))], 20_000 + i) for i in range(5)]
    systems, ess = spark.createDataFrame(KNOWN, SYSTEMS), spark.createDataFrame(reference_rows(), ESS_ENERGY)
    job = keyed.Chained(str(tmp_path / "out"), systems, ess, now=NOW)
    for part in split(rows, 5, 2):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        job.run(stream, 300)
    whole = daily.run(spark.createDataFrame(rows, SCHEMA), systems, ess, NOW)
    for name in ("energy", "partner", "quality", "metrics"):
        same(getattr(job, name)(), getattr(whole, name))
    same(job.dead_letters(), whole.dead_letters)
