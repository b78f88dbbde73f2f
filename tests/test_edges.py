"""NULL keys, repeated metadata, pruned columns and restarts."""

from __future__ import annotations

import pytest
from machines import cut_every
from pyspark.sql import functions as F

from wattledger.operators import enrich, skew
from wattledger.sources.decode import decode_record_sets
from wattledger.sources.record_sets import stream_record_sets


def _previous(spark, hot):
    rows = [(key, seq, 0, (seq * 7) % 11) for seq in range(40) for key in ("a", None)]
    df = spark.createDataFrame(rows, f"k string, {skew.ARRIVAL[0]} long, {skew.ARRIVAL[1]} int, v long")
    return sorted(map(str, skew.previous_max(df, "k", F.col("v"), "m", hot).collect()))


@pytest.mark.parametrize("keys", [(None,), ("a",), ("a", None)])
def test_cutting_changes_nothing_for_null_keys(spark, keys):
    assert _previous(spark, cut_every(keys, 4)) == _previous(spark, skew.NO_HOT_KEYS)


@pytest.mark.parametrize("versions", ["", ", updated_at long"])
def test_one_row_for_each_host(spark, versions):
    schema = "host_rcpn string, system_id string, site_id string, is_registered boolean, timezone string, location_id string"
    row = ("h", "s", "t", True, "UTC", "l")
    rows = [row + (1,) * bool(versions), row + (1,) * bool(versions)]
    assert enrich.latest_systems(spark.createDataFrame(rows, schema + versions)).count() == 1


def test_malformed_payloads_fail_whatever_is_read(spark):
    payloads = spark.createDataFrame([(1, "no payload at all")], "arrival_seq long, payload string")
    with pytest.raises(Exception, match="malformed record set payload"):
        decode_record_sets(payloads).select("arrival_seq").collect()


def test_latest_keeps_its_first_start(spark, tmp_path):
    data, started, out, marks = (str(tmp_path / n) for n in ("data", "started", "out", "marks"))
    schema = "arrival_seq long"
    spark.range(1).select(F.lit(0).cast("long").alias("arrival_seq")).write.parquet(data)

    def go():
        df = stream_record_sets(spark, data, "latest", schema=schema, started=started)
        df.writeStream.format("parquet").option("checkpointLocation", marks).trigger(availableNow=True).start(
            out
        ).awaitTermination()

    import time

    time.sleep(1.1)  # file times may be whole seconds
    go()
    time.sleep(1.1)
    spark.range(2).select(F.lit(1).cast("long").alias("arrival_seq")).write.mode("append").parquet(data)
    go()
    assert [r.arrival_seq for r in spark.read.schema(schema).parquet(out).collect()] == [1, 1]
