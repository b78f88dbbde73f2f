"""Column types and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

SLOT_SECONDS = 300

# Names and numbers of the enums in the upload format.
SYS_MODE_CODES = {
    "SAFETY_SHUTDOWN": 0,
    "GRID_TIE": 1,
    "SELF_SUPPLY": 2,
    "CLEAN_BACKUP": 3,
    "PRIORITY_BACKUP": 4,
    "REMOTE_ARBITRAGE": 5,
    "SELL": 6,
}
INVERTER_STATE_CODES = {
    "UNKNOWN": 0,
    "DISABLED": 16,
    "INITIALIZING": 256,
    "POWERING_UP": 272,
    "CONNECTING_BUS": 288,
    "TESTING_BUS": 320,
    "LOW_BUS_VOLTAGE": 512,
    "WAITING": 784,
    "CONNECTING_GRID": 2048,
    "DISCONNECTING_GRID": 2064,
    "GRID_CONNECTED": 2080,
    "ISLANDED": 2096,
    "GENERATOR_PARALLEL": 2128,
    "ERROR_GENERIC": 28672,
    "ERROR_REBUS_FAULT": 29968,
    "ERROR_INTERNAL_BUS_FAULT": 29984,
    "CONFIGURATION_ERROR": 30464,
    "BAD_RESET_ERROR": 30480,
    "GROUND_FAULT": 49152,
}
CHANNEL_TYPE_CODES = {
    "NET": 0,
    "GENERATION": 1,
    "CONSUMPTION": 2,
    "PHASE_A_CONSUMPTION": 3,
    "PHASE_B_CONSUMPTION": 4,
    "PHASE_C_CONSUMPTION": 5,
    "SUBMETER": 6,
    "INVERTER_OUTPUT": 7,
}
DEVICE_TYPE_CODES = {"BATTERY": 0, "SOLAR": 1, "INVERTER": 2, "GENERATOR": 3, "OCTOPUS": 4}
AGGREGATION_LEVEL_CODES = {"RAW": 0, "AGGREGATED": 1}

INVERTER_OUTPUT = "INVERTER_OUTPUT"
INVERTER = "INVERTER"

CHANNEL = T.StructType(
    [
        T.StructField("channel", T.IntegerType()),
        T.StructField("channelType", T.StringType()),
        T.StructField("exportedEnergyWs", T.LongType()),
        T.StructField("importedEnergyWs", T.LongType()),
        T.StructField("voltageV", T.FloatType()),
        T.StructField("reactivePowerVAR", T.IntegerType()),
        T.StructField("realPowerW", T.IntegerType()),
        T.StructField("widebandReactivePowerVAR", T.IntegerType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("deviceType", T.StringType()),
        T.StructField("aggregateLevel", T.StringType()),
        T.StructField("SoC", T.FloatType()),
        T.StructField("isRevenueGrade", T.BooleanType()),
        T.StructField("reactivePowerVARf", T.FloatType()),
        T.StructField("realPowerWf", T.FloatType()),
        T.StructField("label", T.StringType()),
    ]
)

RECORD = T.StructType(
    [
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("systemTime", T.DoubleType()),
        T.StructField("sysMode", T.StringType()),
        T.StructField("inverterState", T.StringType()),
        T.StructField("channel", T.ArrayType(CHANNEL)),
    ]
)

# One row per upload. `arrival_seq` gives the order of arrival, which decides
# which of two readings of one slot wins; it must be unique.
RECORD_SETS = T.StructType(
    [
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("sensorId", T.StringType()),
        T.StructField("record", T.ArrayType(RECORD)),
    ]
)

SYSTEMS = T.StructType(
    [
        T.StructField("host_rcpn", T.StringType()),
        T.StructField("system_id", T.StringType()),
        T.StructField("site_id", T.StringType()),
        T.StructField("is_registered", T.BooleanType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("location_id", T.StringType()),
    ]
)

ESS_ENERGY = T.StructType(
    [
        T.StructField("system_id", T.StringType()),
        T.StructField("start_ts", T.LongType()),
        T.StructField("lifetime_imported_ws", T.DoubleType()),
        T.StructField("lifetime_exported_ws", T.DoubleType()),
    ]
)

# Keyed state carried from one run to the next.
SLOT_STATE = T.StructType(
    [
        T.StructField("host_rcpn", T.StringType()),
        T.StructField("slot", T.LongType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("raw_imported_ws", T.LongType()),
        T.StructField("raw_exported_ws", T.LongType()),
    ]
)
CT_STATE = T.StructType(
    [
        T.StructField("system_id", T.StringType()),
        T.StructField("swapped", T.BooleanType()),
        T.StructField("valid_until", T.LongType()),
    ]
)
MISS_STATE = T.StructType(
    [
        T.StructField("host_rcpn", T.StringType()),
        T.StructField("expires_at", T.LongType()),
    ]
)
CACHE_STATE = T.StructType(
    [
        T.StructField("host_rcpn", T.StringType()),
        T.StructField("asked_at", T.LongType()),
        T.StructField("expires_at", T.LongType()),
    ]
)
