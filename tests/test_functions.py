from __future__ import annotations

import pytest
from fixtures import channel, record, uploads
from pyspark.sql import functions as F

from wattledger.functions import channels as ch
from wattledger.functions.text import is_blank, sensor_id_or, sys_mode_code
from wattledger.functions.timeslots import epoch_seconds, iso_utc, slot_floor, slot_nearest, utc_date


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "ts, freq, expected",
    [(300, 300, 300), (300, 3600, 0), (599, 300, 300), (690, 300, 600), (-7, 300, 0), (-301, 300, -300)],
)
def test_slot_floor(spark, ts, freq, expected):
    assert value(spark, slot_floor(F.lit(ts).cast("bigint"), freq)) == expected


@pytest.mark.parametrize(
    "ts, expected", [(0, 0), (149, 0), (150, 300), (299, 300), (300, 300), (449, 300), (450, 600)]
)
def test_slot_nearest(spark, ts, expected):
    assert value(spark, slot_nearest(F.lit(ts).cast("bigint"))) == expected


def test_slot_nearest_handles_negative_times(spark):
    assert value(spark, slot_nearest(F.lit(-7).cast("bigint"))) == 0


@pytest.mark.parametrize(
    "ts, expected",
    [("1616544027.9", 1616544027), ("-1.9", -1), ("nan", None), ("1e300", None)],
)
def test_epoch_seconds_truncates(spark, ts, expected):
    assert value(spark, epoch_seconds(F.lit(ts).cast("double"))) == expected


def test_calendar_text(spark):
    assert value(spark, iso_utc(F.lit(0).cast("bigint"))) == "1970-01-01T00:00:00Z"
    assert str(value(spark, utc_date(F.lit(-1).cast("bigint")))) == "1969-12-31"
    assert str(value(spark, utc_date(F.lit(86400).cast("bigint")))) == "1970-01-02"


@pytest.mark.parametrize(
    "text, blank",
    [("", True), (" \t\n", True), ("\u2003", True), ("\u00a0", False), ("\u2007", False), (" x ", False)],
)
def test_blank(spark, text, blank):
    assert value(spark, is_blank(F.lit(text))) is blank


def test_codes_and_defaults(spark):
    assert value(spark, sys_mode_code(F.lit("SELL"), -1)) == 6
    assert value(spark, sys_mode_code(F.lit(None).cast("string"), -1)) == -1
    assert value(spark, sys_mode_code(F.lit("OTHER"), -1)) == -1
    assert value(spark, sensor_id_or(F.lit(None).cast("string"), "none")) == "none"


def one_record(spark, *channels):
    return uploads(spark, [("s", [record(0, *channels)])]).select(
        F.col("record")[0].alias("record")
    )


HOST_CASES = [
    ([channel("a"), channel("b")], "a"),
    ([channel(None)], ""),
    ([channel("a", channelType="NET"), channel("b")], "b"),
    ([channel("a", deviceType="SOLAR")], "unknown"),
    ([channel("a", deviceType=None)], "unknown"),
    ([], "unknown"),
]


@pytest.mark.parametrize("channels, expected", HOST_CASES)
def test_host_is_the_first_inverter(spark, channels, expected):
    df = one_record(spark, *channels)
    assert df.select(ch.host_rcpn(F.col("record.channel")).alias("h")).first()["h"] == expected


def test_channel_map_keeps_the_last(spark):
    df = one_record(
        spark,
        channel("a"),
        channel("n", channelType="NET", channel=5),
        channel("b", channel=2),
        channel("x", channelType=None),
    )
    m = df.select(ch.channel_map(F.col("record.channel")).alias("m")).first()["m"]
    assert {k: v["channel"] for k, v in m.items()} == {"INVERTER_OUTPUT": 2, "NET": 5}


def raw(df):
    return (
        df.withColumn("o", ch.output_channel(F.col("record")))
        .select(*ch.raw_reading(F.col("record"), F.col("o")))
        .first()
        .asDict()
    )


def test_raw_reading_reverses_directions_of_the_last_output(spark):
    row = raw(one_record(spark, channel("a", 1, 2), channel("b", 10, 20, realPowerW=3)))
    assert (row["raw_imported_ws"], row["raw_exported_ws"]) == (10, 20)
    assert (row["raw_host_rcpn"], row["real_power_w"], row["voltage_v"]) == ("b", 3, None)


def test_raw_reading_is_null_when_the_last_output_is_no_inverter(spark):
    row = raw(one_record(spark, channel("a", 1, 2), channel("b", 10, 20, deviceType="SOLAR")))
    assert row["event_timestamp"] == 0
    assert {v for k, v in row.items() if k != "event_timestamp"} == {None}


VALID_CASES = [
    ([], False),
    ([channel("a", channelType="GENERATION", deviceType="SOLAR")], False),
    ([channel(None)], False),
    ([channel("a")], True),
    ([channel("")], True),
    ([channel(None), channel("a")], True),
]


@pytest.mark.parametrize("channels, valid", VALID_CASES)
def test_validation(spark, channels, valid):
    df = one_record(spark, *channels)
    found = df.select(ch.has_inverter_with_id(F.col("record.channel")).alias("v")).first()["v"]
    assert found is valid


def test_validation_of_a_missing_record(spark):
    missing = F.lit(None).cast("array<struct<channelType:string,deviceType:string,deviceId:string>>")
    assert value(spark, ch.has_inverter_with_id(missing)) is False
