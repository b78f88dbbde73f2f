"""Hand-made uploads and lookup tables."""

from __future__ import annotations

from wattledger.schema import ESS_ENERGY, RECORD_SETS, SYSTEMS

# Device ids, and the counters of two days.
C1, E1, F1 = "000100073534", "000100093534", "000100053534"

# timestamp, exported counter, real power; the imported counter stays at 1318551904.
SERIES = [
    (1616544027, 40481590560, 583),
    (1616544327, 40481738496, 453),
    (1616544627, 40481876176, 457),
    (1616544927, 40482024656, 490),
    (1616545230, 40482270128, 933),
    (1616545530, 40482531712, 823),
    (1616545830, 40482773792, 795),
    (1616546130, 40483016528, 707),
    (1616546431, 40483230976, 710),
]


def channel(device=None, exported=None, imported=None, **more):
    base = dict.fromkeys(f.name for f in RECORD_SETS["record"].dataType.elementType["channel"].dataType.elementType)
    base.update(
        channel=1,
        channelType="INVERTER_OUTPUT",
        deviceType="INVERTER",
        aggregateLevel="RAW",
        deviceId=device,
        exportedEnergyWs=exported,
        importedEnergyWs=imported,
    )
    base.update(more)
    return tuple(base.values())


def record(ts, *channels, mode="SELF_SUPPLY", state="GRID_CONNECTED"):
    return (float(ts), float(ts), mode, state, list(channels))


def uploads(spark, rows):
    """`rows` of (sensor, [records]); their order is the order of arrival."""
    return spark.createDataFrame(
        [(i, sensor, records) for i, (sensor, records) in enumerate(rows)], RECORD_SETS
    )


def series(device):
    return [
        (
            "sensor",
            [record(ts, channel(device, exported, 1318551904, realPowerW=power))],
        )
        for ts, exported, power in SERIES
    ]


def second_day(device):
    """Two uploads whose values differ in every field."""
    return [
        (
            "sensor",
            [
                record(
                    1616544027,
                    channel(
                        device, 40481590560, 1318551904, realPowerW=583, voltageV=5.4321,
                        reactivePowerVAR=789,
                    ),
                )
            ],
        ),
        (
            "sensor",
            [
                record(
                    1616544327,
                    channel(
                        device, 40481738496, 1318551604, realPowerW=453, voltageV=1.2345,
                        reactivePowerVAR=987,
                    ),
                )
            ],
        ),
    ]


# Zone of each registered host; all other hosts are unregistered.
ZONES = {C1: "Europe/Lisbon", E1: "Asia/Tokyo", F1: "Africa/Cairo"}


def systems(spark, hosts):
    rows = [
        (h, f"systemId-{h}", f"siteId-{h}", h in ZONES, ZONES.get(h), f"locationId-{h}" if h in ZONES else None)
        for h in hosts
    ]
    return spark.createDataFrame(rows, SYSTEMS)


def ess(spark, slots):
    """Reference readings: C1 in line with its meter, E1 opposed to it, others equal."""
    values = {
        C1: (40481738496.0, 1318551604.0),
        E1: (1318551604.0, 40481738496.0),
        F1: (0.0, 0.0),
    }
    rows = [(f"systemId-{h}", s, *v) for h, v in values.items() for s in slots]
    return spark.createDataFrame(rows, ESS_ENERGY)
