"""Decode upload payloads into record-set columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattledger.schema import (
    AGGREGATION_LEVEL_CODES,
    CHANNEL,
    CHANNEL_TYPE_CODES,
    DEVICE_TYPE_CODES,
    INVERTER_STATE_CODES,
    RECORD,
    SYS_MODE_CODES,
)

_CORRUPT = "_corrupt"
# 64-bit integers are quoted strings in the JSON form.
_COUNTERS = ("exportedEnergyWs", "importedEnergyWs")
_CHANNEL_ENUMS = {
    "channelType": CHANNEL_TYPE_CODES,
    "deviceType": DEVICE_TYPE_CODES,
    "aggregateLevel": AGGREGATION_LEVEL_CODES,
}
_RECORD_ENUMS = {"sysMode": SYS_MODE_CODES, "inverterState": INVERTER_STATE_CODES}

_CHANNEL_JSON = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name in _COUNTERS else f.dataType)
        for f in CHANNEL
    ]
)
_PAYLOAD_JSON = T.StructType(
    [
        T.StructField("sensorId", T.StringType()),
        T.StructField(
            "record",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            f.name, T.ArrayType(_CHANNEL_JSON) if f.name == "channel" else f.dataType
                        )
                        for f in RECORD
                    ]
                )
            ),
        ),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)


def unsigned_to_long(text: Column) -> Column:
    """Unsigned 64-bit decimal text as a signed bigint, wrapping above 2^63 - 1."""
    number = text.try_cast("decimal(20,0)")
    wrapped = F.when(
        number > F.lit("9223372036854775807").cast("decimal(20,0)"),
        number - F.lit("18446744073709551616").cast("decimal(20,0)"),
    ).otherwise(number)
    return wrapped.try_cast("bigint")


def _not_unsigned(text: Column) -> Column:
    return text.isNotNull() & ~text.rlike(r"\A[0-9]{1,20}\z") | (
        text.try_cast("decimal(20,0)") > F.lit("18446744073709551615").cast("decimal(20,0)")
    )


def _unknown_name(name: Column, codes: dict[str, int]) -> Column:
    return name.isNotNull() & ~name.isin(*codes)


def _any(tests: list[Column]) -> Column:
    found = F.lit(False)
    for test in tests:
        found = found | F.coalesce(test, F.lit(False))
    return found


def _bad_channel(channel: Column) -> Column:
    return _any(
        [_not_unsigned(channel[name]) for name in _COUNTERS]
        + [_unknown_name(channel[name], codes) for name, codes in _CHANNEL_ENUMS.items()]
    )


def _bad_record(record: Column) -> Column:
    return _any(
        [_unknown_name(record[name], codes) for name, codes in _RECORD_ENUMS.items()]
        + [F.exists(record["channel"], _bad_channel)]
    )


def _typed_channel(channel: Column) -> Column:
    return F.struct(
        *[
            (unsigned_to_long(channel[f.name]) if f.name in _COUNTERS else channel[f.name]).alias(
                f.name
            )
            for f in CHANNEL
        ]
    )


def _typed_record(record: Column) -> Column:
    return F.struct(
        *[
            (
                F.transform(record["channel"], _typed_channel)
                if f.name == "channel"
                else record[f.name]
            ).alias(f.name)
            for f in RECORD
        ]
    )


def decode_flagged(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Add `sensorId`, `record` and `malformed`; a malformed payload has no values."""
    parsed = F.from_json(
        F.col(payload),
        _PAYLOAD_JSON,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    value = F.col("_parsed")
    malformed = (
        value.isNull()
        | value[_CORRUPT].isNotNull()
        | F.coalesce(F.exists(value["record"], _bad_record), F.lit(False))
    )
    # Exploding one value keeps filters on `malformed` above the parser, which would
    # otherwise run once more for each of them.
    return (
        payloads.select("*", F.explode(F.array(parsed)).alias("_parsed"))
        .withColumn("malformed", malformed)
        .withColumn("sensorId", F.when(~F.col("malformed"), value["sensorId"]))
        .withColumn(
            "record", F.when(~F.col("malformed"), F.transform(value["record"], _typed_record))
        )
        .drop("_parsed")
    )


def decode_record_sets(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Replace a JSON payload column by `sensorId` and `record`; a malformed payload fails the job."""
    # In a filter, so that it fails whichever columns are read later.
    failure = F.raise_error(F.lit("malformed record set payload")).cast("boolean")
    return (
        decode_flagged(payloads, payload)
        .where(F.when(F.col("malformed"), failure).otherwise(True))
        .drop("malformed", payload)
    )


def decode_with_quarantine(
    payloads: DataFrame, payload: str = "payload"
) -> tuple[DataFrame, DataFrame]:
    """As `decode_record_sets`, with malformed payloads set aside in a second DataFrame.

    Each of the two reads the payloads.
    """
    flagged = decode_flagged(payloads, payload)
    good = flagged.where("not malformed").drop("malformed", payload)
    bad = flagged.where("malformed").drop("malformed", "sensorId", "record")
    return good, bad


# Field names of the binary form, where they differ from the JSON form.
_BINARY_NAMES = {
    "exportedEnergyWs": "exportedEnergy_Ws",
    "importedEnergyWs": "importedEnergy_Ws",
    "voltageV": "voltage_V",
    "reactivePowerVAR": "reactivePower_VAR",
    "realPowerW": "realPower_W",
    "widebandReactivePowerVAR": "widebandReactivePower_VAR",
    "reactivePowerVARf": "reactivePower_VARf",
    "realPowerWf": "realPower_Wf",
}


def decode_protobuf(
    payloads: DataFrame, message: str, descriptor: str, payload: str = "payload"
) -> DataFrame:
    """Decode binary payloads; a malformed one fails the job.

    Needs the spark-protobuf package and a compiled descriptor file. It has never been run here.
    """
    from pyspark.sql.protobuf.functions import from_protobuf

    def channel(c: Column) -> Column:
        return F.struct(
            *[
                c[_BINARY_NAMES.get(f.name, f.name)].cast(f.dataType).alias(f.name)
                for f in CHANNEL
            ]
        )

    def record(r: Column) -> Column:
        return F.struct(
            *[
                (F.transform(r["channel"], channel) if f.name == "channel" else r[f.name]).alias(
                    f.name
                )
                for f in RECORD
            ]
        )

    decoded = from_protobuf(F.col(payload), message, descriptor, {"mode": "FAILFAST"})
    return (
        payloads.withColumn("_parsed", decoded)
        .withColumn("sensorId", F.col("_parsed.sensorId"))
        .withColumn("record", F.transform(F.col("_parsed.record"), record))
        .drop("_parsed", payload)
    )


def record_json(record: Column) -> Column:
    """A record in the JSON form of uploads, with counters as quoted strings."""

    def text_channel(channel: Column) -> Column:
        return F.struct(
            *[
                (channel[f.name].cast("string") if f.name in _COUNTERS else channel[f.name]).alias(
                    f.name
                )
                for f in CHANNEL
            ]
        )

    return F.to_json(
        F.struct(
            *[
                (
                    F.transform(record["channel"], text_channel)
                    if f.name == "channel"
                    else record[f.name]
                ).alias(f.name)
                for f in RECORD
            ]
        )
    )
