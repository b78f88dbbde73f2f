"""Meter data derived from the `events` table.

No driver table holds meter readings, so each event stands for one upload. Every user is
a device, and a third of all uploads come from one device. Times are compressed 36-fold,
which gives a device about one upload per four slots at every scale factor. All values
are arithmetic on the event, so nothing here needs a shuffle but the list of systems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.schema import RECORD
from wattledger.sources.decode import record_json

BASE_US = 1_704_067_200_000_000

_EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
)
_EM_SPACE = "\u2003"


def _spread(table: DataFrame) -> DataFrame:
    """A table read by fewer tasks than there are cores, or mostly by a few of its tasks, is
    spread over the cores; the records built from it are far larger than its rows.

    A row group is read by one task, so a file of few large ones leaves splits without rows.
    The rows of each split are counted from the footers; no column is read."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    splits = table.rdd.getNumPartitions()
    if splits >= cores:
        held = table.groupBy(F.spark_partition_id().alias("split")).count()
        most, rows = held.agg(F.max("count"), F.sum("count")).first()
        if (most or 0) * cores <= 1.2 * (rows or 0):
            return table
    return table.repartition(max(splits, cores))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the device `d`, its compressed time `us` and the meter increment `c`."""
    table = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")
    return _spread(table).select(
        F.col("event_id").alias("e"),
        F.expr("if(event_id % 3 = 0, 0L, user_id)").alias("d"),
        F.expr(
            f"{BASE_US} + (unix_micros(cast(ts as timestamp)) - {BASE_US}) div 36"
        ).alias("us"),
        F.expr("unix_micros(cast(ts as timestamp))").alias("raw_us"),
        F.expr("cast(round(value * 100) as bigint)").alias("c"),
        "event_type",
    )


def _channel(fields: dict[str, str]) -> str:
    """SQL of a channel struct; fields not given are NULL."""
    types = {f.name: f.dataType.simpleString() for f in RECORD["channel"].dataType.elementType}
    return (
        "named_struct("
        + ", ".join(
            f"'{name}', cast({fields.get(name, 'null')} as {kind})" for name, kind in types.items()
        )
        + ")"
    )


def _record(pos: int) -> str:
    """SQL of record number `pos` of an upload."""
    host = "concat('host-', d)"
    imported = f"if(d % 3 = 1, 1000000000, 40000000000) + e * 100 + c + {pos * 7}"
    exported = "if(d % 3 = 1, 40000000000, 1000000000) + e * 10 + d"
    power = "e % 5000 - 500"
    net = _channel(
        {
            "channel": "0",
            "channelType": "'NET'",
            "exportedEnergyWs": "1",
            "importedEnergyWs": "2",
            "deviceId": "'net'",
            "deviceType": "'OCTOPUS'",
        }
    )
    untyped = _channel({"channel": "9", "deviceId": "'x'", "deviceType": "'INVERTER'"})
    output = {
        "channelType": "'INVERTER_OUTPUT'",
        "deviceType": "'INVERTER'",
        "aggregateLevel": "'RAW'",
        "voltageV": "if(e % 53 = 0, null, 220 + (e % 40) * 0.25)",
        "reactivePowerVAR": "if(e % 59 = 0, null, e % 300 - 150)",
    }
    first = _channel(
        {
            **output,
            "channel": "1",
            "exportedEnergyWs": f"case when e % 97 = 0 then null when e % 101 = 0 then 5000000 else {imported} end",
            "importedEnergyWs": f"if(e % 101 = 0, 5000000, {exported})",
            "realPowerW": power,
            "deviceId": (
                "case when e % 31 = 5 then null when e % 37 = 9 then 'unknown' "
                f"when e % 41 = 3 then '{_EM_SPACE} ' else {host} end"
            ),
        }
    )
    second = _channel(
        {
            **output,
            "channel": "2",
            "exportedEnergyWs": f"{imported} + 11",
            "importedEnergyWs": f"{exported} + 13",
            "realPowerW": f"{power} + 1",
            "deviceId": host,
        }
    )
    solar = _channel(
        {
            **output,
            "channel": "3",
            "exportedEnergyWs": "1",
            "importedEnergyWs": "1",
            "deviceId": "concat('solar-', d)",
            "deviceType": "'SOLAR'",
        }
    )
    has_first = "e % 43 <> 8" if pos == 0 else "e % 5 <> 1"
    channels = ", ".join(
        [
            f"if(e % 2 = 0, {net}, null)",
            f"if(e % 19 = 4, {untyped}, null)",
            f"if({has_first}, {first}, null)",
            f"if({has_first} and e % 23 = 7, {second}, null)",
            f"if({has_first} and e % 29 = 11, {solar}, null)",
        ]
    )
    late = "if(e % 10 = 0, 900000000, 0)"
    modes = (
        "case when e % 61 = 17 then 'HOLIDAY' else element_at(array('SAFETY_SHUTDOWN', 'GRID_TIE', "
        "'SELF_SUPPLY', 'CLEAN_BACKUP', 'PRIORITY_BACKUP', 'REMOTE_ARBITRAGE', 'SELL', null, "
        "'SELF_SUPPLY'), cast(e % 9 + 1 as int)) end"
    )
    states = (
        "element_at(array('GRID_CONNECTED', 'ISLANDED', null, 'WAITING', 'GROUND_FAULT', "
        "'GRID_CONNECTED'), cast(e % 6 + 1 as int))"
    )
    return (
        f"named_struct('timestamp', (us - {late} + {pos * 300_000_000}) / 1e6D, "
        f"'systemTime', us / 1e6D, 'sysMode', {modes}, 'inverterState', {states}, "
        f"'channel', array_compact(array({channels})))"
    )


def record_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads of one or two records. `processed_at` is the time of the upload."""
    return events(spark, sf_dir).select(
        F.col("e").alias("arrival_seq"),
        F.expr("us div 1000000").alias("processed_at"),
        F.expr("concat('sensor-', d)").alias("sensorId"),
        F.expr(f"if(e % 4 = 1, array({_record(0)}, {_record(1)}), array({_record(0)}))").alias(
            "record"
        ),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same uploads as JSON text, some of them cut short."""
    body = F.concat(
        F.lit('{"sensorId":"'),
        F.col("sensorId"),
        F.lit('","record":['),
        F.array_join(F.transform("record", record_json), ","),
        F.lit("]}"),
    )
    return record_sets(spark, sf_dir).select(
        "arrival_seq",
        F.when(F.col("arrival_seq") % 71 == 3, F.substring(body, 1, 40))
        .otherwise(body)
        .alias("payload"),
    )


def _system_fields() -> list:
    """Metadata of device `d` that its version number `updated_at` decides."""
    return [
        F.expr("concat('host-', d)").alias("host_rcpn"),
        F.expr("concat('system-', d div 2)").alias("system_id"),
        F.expr("concat('site-', d)").alias("site_id"),
        F.expr("case when updated_at % 19 = 7 then null else updated_at % 7 <> 3 end").alias(
            "is_registered"
        ),
        F.expr(
            "element_at(array('America/New_York', 'America/Chicago', '', null, "
            f"'{_EM_SPACE}'), cast(updated_at % 5 + 1 as int))"
        ).alias("timezone"),
        F.expr("concat('location-', updated_at)").alias("location_id"),
        "updated_at",
    ]


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of system metadata; every eleventh device is not known."""
    return (
        events(spark, sf_dir)
        .where("d % 11 <> 5")
        .groupBy("d", "event_type")
        .agg(F.max("e").alias("updated_at"))
        .select(*_system_fields())
    )


def system_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 23rd upload comes with a new version of its device's metadata, valid from an hour later."""
    return (
        events(spark, sf_dir)
        .where("d % 11 <> 5 and e % 23 = 4")
        .withColumn("updated_at", F.col("e"))
        .select(*_system_fields(), F.expr("us div 1000000 + 3600").alias("valid_from"))
    )


def ess_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference-meter readings, one for four of five uploads, shortly before its slot."""
    late = "if(e % 10 = 0, 900, 0)"
    return (
        events(spark, sf_dir)
        .where("e % 5 <> 0")
        .select(
            F.expr("concat('system-', d div 2)").alias("system_id"),
            F.expr(f"us div 1000000 - {late} - 300 + e % 60").alias("start_ts"),
            F.expr("if(e % 13 = 0, null, if(e % 2 = 0, 40000, 1000) + e % 7)")
            .cast("double")
            .alias("lifetime_imported_ws"),
            F.expr("if(e % 13 = 0, null, if(e % 2 = 0, 1000, 40000))")
            .cast("double")
            .alias("lifetime_exported_ws"),
        )
    )
