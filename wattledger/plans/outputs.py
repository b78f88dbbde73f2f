"""Projections of corrected readings into the two published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.text import enum_code
from wattledger.schema import (
    INVERTER,
    INVERTER_OUTPUT,
    INVERTER_STATE_CODES,
    SYS_MODE_CODES,
)

DATAFRAME_TYPE = "RGM"

_PARTNER_CHANNEL = (
    "array<struct<channel:int,channel_type:string,delta_exported_energy_ws:bigint,"
    "delta_imported_energy_ws:bigint,exported_energy_ws:bigint,imported_energy_ws:bigint,"
    "device_type:string,device_id:string,real_power_w:int,is_revenue_grade:boolean>>"
)
_PARTNER_RECORDS = (
    "array<struct<inverter_state:int,sys_mode:string,current_timestamp:double,"
    f"previous_timestamp:double,channel:{_PARTNER_CHANNEL}>>"
)


def energy_dataframe(corrected: DataFrame) -> DataFrame:
    """Internal energy table. `partition_key` routes the rows of a device to one place."""
    return corrected.select(
        F.col("system_host_rcpn").alias("partition_key"),
        "timestamp_utc",
        F.when(F.col("is_registered"), F.col("timezone")).otherwise("UTC").alias("timezone"),
        F.col("system_host_rcpn").alias("host_rcpn"),
        "system_id",
        F.lit(DATAFRAME_TYPE).alias("dataframe_type"),
        F.when(F.col("is_registered"), "REGISTERED")
        .otherwise("UNREGISTERED")
        .alias("system_registration_type"),
        F.struct(
            F.col("event_timestamp").alias("raw_timestamp"),
            F.col("raw_exported_ws").alias("raw_inverter_lifetime_exported_ws"),
            F.col("raw_imported_ws").alias("raw_inverter_lifetime_imported_ws"),
        ).alias("raw_data"),
        F.struct(
            F.col("time_delta_seconds").alias("time_diff_in_seconds"),
            F.col("delta_exported_ws").alias("inverter_energy_exported_ws"),
            F.col("delta_imported_ws").alias("inverter_energy_imported_ws"),
        ).alias("delta_data"),
        F.struct(
            "real_power_w",
            "voltage_v",
            "reactive_power_var",
            F.col("swapped").alias("is_inverter_output_swapped"),
        ).alias("rgm_data"),
    )


def partner_record(record: Column) -> Column:
    """The part of a record that `partner_telemetry` reads, with the same field names."""
    outputs = F.filter(record["channel"], lambda c: c["channelType"] == INVERTER_OUTPUT)
    kept = ("channel", "channelType", "deviceId", "realPowerW")
    return F.struct(
        *[record[c].alias(c) for c in ("timestamp", "sysMode", "inverterState")],
        F.transform(outputs, lambda c: F.struct(*[c[f].alias(f) for f in kept])).alias("channel"),
    )


def partner_telemetry(corrected: DataFrame) -> DataFrame:
    """Partner telemetry of registered systems.

    A record that cannot be converted (a counter is missing for a channel that needs it, or
    the operating mode is not known) leaves an empty record set; the row is still sent.
    """
    record = F.col("record")
    mode = F.coalesce(record["sysMode"], F.lit("SAFETY_SHUTDOWN"))
    # An unset channel type reads as NET.
    outputs = F.filter(record["channel"], lambda c: c["channelType"] == INVERTER_OUTPUT)

    def channel(c: Column) -> Column:
        return F.struct(
            F.coalesce(c["channel"], F.lit(0)).alias("channel"),
            F.lit(INVERTER_OUTPUT).alias("channel_type"),
            F.col("delta_exported_ws").alias("delta_exported_energy_ws"),
            F.col("delta_imported_ws").alias("delta_imported_energy_ws"),
            F.col("raw_exported_ws").alias("exported_energy_ws"),
            F.col("raw_imported_ws").alias("imported_energy_ws"),
            F.lit(INVERTER).alias("device_type"),
            F.coalesce(c["deviceId"], F.lit("")).alias("device_id"),
            F.coalesce(c["realPowerW"], F.lit(0)).alias("real_power_w"),
            F.lit(True).alias("is_revenue_grade"),
        )

    timestamp = F.coalesce(record["timestamp"], F.lit(0.0))
    energy_record = F.struct(
        F.coalesce(
            enum_code(record["inverterState"], INVERTER_STATE_CODES), F.lit(0)
        ).alias("inverter_state"),
        mode.alias("sys_mode"),
        timestamp.alias("current_timestamp"),
        (timestamp - F.col("time_delta_seconds")).alias("previous_timestamp"),
        F.transform(outputs, channel).alias("channel"),
    )
    convertible = mode.isin(*SYS_MODE_CODES) & (
        (F.col("raw_imported_ws").isNotNull() & F.col("raw_exported_ws").isNotNull())
        | (F.size(outputs) == 0)
    )
    return corrected.where("is_registered").select(
        F.col("system_host_rcpn").alias("partition_key"),
        "timestamp_utc",
        "system_id",
        "site_id",
        F.when(convertible, F.array(energy_record).cast(_PARTNER_RECORDS))
        .otherwise(F.array().cast(_PARTNER_RECORDS))
        .alias("energy_record_set"),
    )
