from __future__ import annotations

import json

import pytest
from fixtures import channel, record, uploads
from pyspark.sql import functions as F

from wattledger.operators.readings import explode_records, prune_dates, time_range_filter, valid_records
from wattledger.sources.decode import (
    decode_record_sets,
    decode_with_quarantine,
    record_json,
    unsigned_to_long,
)
from wattledger.sources.record_sets import (
    from_kafka,
    kafka_start_options,
    number_rows,
    read_payload_files,
)

NOW = 1_700_000_000


def test_first_unusable_record_ends_its_set(spark):
    good, missing, blank = record(1, channel("a")), record(2), record(3, channel(" "))
    named = record(4, channel("unknown"))
    sets = uploads(
        spark,
        [
            ("s0", [good, good, missing, good]),
            ("s1", [blank, good]),
            ("s2", [good, named, good]),
            ("s3", []),
            ("s4", None),
            ("s5", [good, None, good]),
        ],
    )
    rows = explode_records(sets).select("sensorId", "record_pos", "host_rcpn").collect()
    assert sorted(map(tuple, rows)) == [
        ("s0", 0, "a"),
        ("s0", 1, "a"),
        ("s2", 0, "a"),
        ("s5", 0, "a"),
    ]


@pytest.mark.parametrize(
    "offset, kept",
    [
        (-90 * 86400, False),
        (-7 * 86400 + 60, True),
        (-7 * 86400, True),
        (-7 * 86400 - 1, False),
        (-7 * 86400 - 60, False),
        (0, True),
        (30 * 60, True),
        (30 * 60 + 0.9, True),
        (31 * 60, False),
    ],
)
def test_time_range(spark, offset, kept):
    records = explode_records(uploads(spark, [("s", [record(NOW + offset, channel("a"))])]))
    assert time_range_filter(records, NOW).count() == int(kept)


def test_time_range_uses_the_clock_by_default(spark):
    assert time_range_filter(explode_records(uploads(spark, [("s", [record(0, channel("a"))])]))).count() == 0


def test_date_filter_covers_the_time_range(spark):
    days = spark.sql("select explode(sequence(date'2023-11-01', date'2023-12-01')) as event_date")
    kept = [str(r[0]) for r in prune_dates(days, NOW).orderBy("event_date").collect()]
    assert kept == [f"2023-11-{d:02}" for d in range(7, 15)]


def test_valid_records(spark):
    records = uploads(spark, [("s", [record(1, channel("a")), record(2, channel(None))])]).select(
        F.explode("record").alias("record")
    )
    assert [r["record"]["timestamp"] for r in valid_records(records).collect()] == [1.0]


PAYLOAD = {
    "sensorId": "s",
    "record": [
        {
            "timestamp": 1616544027.0,
            "sysMode": "SELF_SUPPLY",
            "channel": [
                {
                    "channelType": "INVERTER_OUTPUT",
                    "deviceType": "INVERTER",
                    "deviceId": "a",
                    "exportedEnergyWs": "40481590560",
                    "importedEnergyWs": "18446744073709551615",
                }
            ],
        }
    ],
}


def changed(**more):
    copy = json.loads(json.dumps(PAYLOAD))
    copy["record"][0]["channel"][0].update(more)
    return json.dumps(copy)


def payloads(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "arrival_seq bigint, payload string")


def test_decode_reads_quoted_counters(spark):
    row = decode_record_sets(payloads(spark, json.dumps(PAYLOAD))).first()
    c = row["record"][0]["channel"][0]
    assert (c["exportedEnergyWs"], c["importedEnergyWs"], c["deviceId"]) == (40481590560, -1, "a")
    assert row["sensorId"] == "s"


BROKEN = [
    "  hello world.",
    '"  hello world."',
    "",
    None,
    "[1]",
    '{"sensorId": "s"',
    changed(exportedEnergyWs="abc"),
    changed(exportedEnergyWs="-1"),
    changed(exportedEnergyWs="18446744073709551616"),
    changed(channelType="NO_SUCH_TYPE"),
]


def test_malformed_payload_fails(spark):
    for text in BROKEN:
        with pytest.raises(Exception, match="malformed record set payload"):
            decode_record_sets(payloads(spark, text)).collect()


def test_malformed_payload_in_quarantine(spark):
    good, bad = decode_with_quarantine(payloads(spark, json.dumps(PAYLOAD), "{}", *BROKEN))
    assert sorted(r["arrival_seq"] for r in good.collect()) == [0, 1]
    assert {(r["arrival_seq"], r["payload"]) for r in bad.collect()} == {
        (i + 2, text) for i, text in enumerate(BROKEN)
    }


def test_unsigned_counters_wrap(spark):
    texts = ["0", "9223372036854775807", "9223372036854775808", "18446744073709551615"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(unsigned_to_long(F.col("t"))).collect()] == [
        0,
        2**63 - 1,
        -(2**63),
        -1,
    ]


def test_record_json_round_trip(spark):
    records = uploads(spark, [("s", [record(1, channel("a", 7, 8))])])
    text = records.select(record_json(F.col("record")[0]).alias("t")).first()["t"]
    assert json.loads(text)["channel"][0]["exportedEnergyWs"] == "7"
    again = decode_record_sets(payloads(spark, f'{{"record":[{text}]}}')).first()
    assert again["record"] == records.first()["record"]


def test_payload_files_are_read_whole(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(PAYLOAD, indent=2))
    rows = read_payload_files(spark, str(tmp_path)).collect()
    assert sorted(r["arrival_seq"] for r in rows) == [0, 1]
    assert all(json.loads(r["payload"]) == PAYLOAD for r in rows)


def test_files_of_one_time_are_numbered_densely(spark):
    df = spark.range(20_000).select(F.lit(5).alias("t"), F.concat(F.lit("f"), "id").alias("path"))
    rows = number_rows(df.repartition(7), "t", "path").orderBy("arrival_seq").collect()
    assert [r["arrival_seq"] for r in rows] == list(range(20_000))
    assert [r["path"] for r in rows] == sorted(r["path"] for r in rows)


def test_messages_become_record_sets(spark):
    rows = [("k", json.dumps(PAYLOAD).encode(), p, o) for p, o in [(0, 0), (1, 0), (0, 1), (4095, 7)]]
    schema = "key string, value binary, partition int, offset bigint"
    sets = from_kafka(spark.createDataFrame(rows, schema))
    assert [r["arrival_seq"] for r in sets.collect()] == [0, 1, 4096, 7 * 4096 + 4095]
    assert decode_record_sets(sets).count() == 4
    with pytest.raises(Exception, match="out of range"):
        from_kafka(spark.createDataFrame([("k", b"", 4096, 0)], schema)).select("payload").collect()


def test_kafka_positions():
    assert kafka_start_options("latest")["startingOffsets"] == "latest"
    assert kafka_start_options("1700000000000")["startingTimestamp"] == "1700000000000"
