"""Lookups inside a record's channel array.

Three different channels answer three different questions: the key of a reading
comes from the first inverter channel, its values from the last inverter-output
channel, and a reading is valid if any inverter channel names its device.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattledger.functions.timeslots import epoch_seconds
from wattledger.schema import INVERTER, INVERTER_OUTPUT

UNKNOWN_HOST = "unknown"


def _is_inverter_output(channel: Column) -> Column:
    return F.coalesce(
        (channel["channelType"] == INVERTER_OUTPUT) & (channel["deviceType"] == INVERTER),
        F.lit(False),
    )


def host_rcpn(channels: Column, default: str = UNKNOWN_HOST) -> Column:
    """Device id of the first inverter-output channel of an inverter.

    An unset id reads as the empty string; without such a channel the default is returned.
    """
    ids = F.transform(
        F.filter(channels, _is_inverter_output), lambda c: F.coalesce(c["deviceId"], F.lit(""))
    )
    return F.coalesce(F.try_element_at(ids, F.lit(1)), F.lit(default))


def last_of_type(channels: Column, channel_type: str) -> Column:
    """Last channel of a type, or NULL: later entries replace earlier ones."""
    return F.try_element_at(
        F.filter(channels, lambda c: c["channelType"] == channel_type), F.lit(-1)
    )


def channel_map(channels: Column) -> Column:
    """Map from channel type to the last channel of that type; untyped channels are skipped."""
    typed = F.filter(channels, lambda c: c["channelType"].isNotNull())
    types = F.array_distinct(F.transform(typed, lambda c: c["channelType"]))
    latest = F.transform(
        types,
        lambda t: F.element_at(F.filter(typed, lambda c: c["channelType"] == t), -1),
    )
    return F.map_from_arrays(types, latest)


def has_inverter_with_id(channels: Column) -> Column:
    """Whether any inverter-output channel of an inverter has a device id (may be empty)."""
    found = F.exists(
        channels, lambda c: _is_inverter_output(c) & c["deviceId"].isNotNull()
    )
    return F.coalesce(found, F.lit(False))


def output_channel(record: Column) -> Column:
    """The channel a reading's values come from, or NULL."""
    last = last_of_type(record["channel"], INVERTER_OUTPUT)
    return F.when(last["deviceType"] == INVERTER, last)


def raw_reading(record: Column, channel: Column) -> list[Column]:
    """Flat reading of a record and its `output_channel`.

    The meter's directions are reversed: what the channel calls exported energy is
    imported by the home, and the other way round.
    """
    return [
        epoch_seconds(record["timestamp"]).alias("event_timestamp"),
        channel["exportedEnergyWs"].alias("raw_imported_ws"),
        channel["importedEnergyWs"].alias("raw_exported_ws"),
        channel["deviceId"].alias("raw_host_rcpn"),
        channel["realPowerW"].alias("real_power_w"),
        channel["voltageV"].alias("voltage_v"),
        channel["reactivePowerVAR"].alias("reactive_power_var"),
    ]
