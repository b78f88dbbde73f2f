"""One query per operator over the driver's tables, with flat result columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattledger.functions.channels import channel_map, host_rcpn
from wattledger.functions.text import sensor_id_or, sys_mode_code
from wattledger.functions.timeslots import epoch_seconds, slot_floor, slot_nearest
from wattledger.operators import ct, enrich, readings, slots, throttle
from wattledger.plans import daily
from wattledger.session import discard, new_folder, recorded, stage
from wattledger.sources import derived, shard_log
from wattledger.sources.decode import decode_flagged
from wattledger.sources.record_sets import from_kafka

# Clock of the runs: 18 hours after the first upload, so that the last ones lie too far ahead.
NOW = derived.BASE_US // 1_000_000 + 18 * 3600
# Clock of the time filter query, which uses the uncompressed 30 days of `events`.
FILTER_NOW = derived.BASE_US // 1_000_000 + 20 * 86400

# Shards of the log of messages.
LOG_SHARDS = 16

ARRIVAL = readings.ARRIVAL


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.explode_records(derived.record_sets(spark, sf_dir))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of any time: the time range is a query of its own."""
    return daily.to_readings(derived.record_sets(spark, sf_dir), local_mode=True)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = daily.hot_devices(derived.record_sets(spark, sf_dir))
    return slots.slot_classify(_readings(spark, sf_dir), hot=hot)


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.energy_delta(_classified(spark, sf_dir))


def _known(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of known devices with metadata. The systems are a table, so that AQE can split a large device."""
    systems = stage(enrich.latest_systems(derived.systems(spark, sf_dir)), "systems")
    return enrich.enrich_systems(rows, systems, reduced=True)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid deltas with metadata and reference outcome, staged as in the whole job."""
    known = readings.valid_records(_known(_deltas(spark, sf_dir), spark, sf_dir))
    return stage(ct.ess_lookup(known, derived.ess_energy(spark, sf_dir)), "enriched")


def _misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmatched deltas after suppression."""
    missed = enrich.unmatched_systems(_deltas(spark, sf_dir), derived.systems(spark, sf_dir))
    return throttle.suppress_misses(stage(missed, "missed"))


def _job(spark: SparkSession, sf_dir: str) -> daily.Outputs:
    return daily.run(
        derived.record_sets(spark, sf_dir),
        derived.systems(spark, sf_dir),
        derived.ess_energy(spark, sf_dir),
        NOW,
    )


def decode_record_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_flagged(derived.payloads(spark, sf_dir))
    channels = F.flatten(F.transform("record", lambda r: r["channel"]))
    exported = F.aggregate(
        "channels",
        F.lit(0).cast("bigint"),
        lambda acc, c: acc + F.coalesce(c["exportedEnergyWs"], F.lit(0)),
    )
    return decoded.withColumn("channels", channels).select(
        "arrival_seq",
        F.when(F.col("malformed"), "malformed").otherwise("decoded").alias("status"),
        F.col("sensorId").alias("sensor_id"),
        F.size("record").alias("n_records"),
        F.size("channels").alias("n_channels"),
        exported.alias("exported_sum"),
    )


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads sent to a log of keyed messages, read back as a bounded stream, and decoded."""
    log, out, point, note = (f"{new_folder(spark)}/{name}" for name in ("log", "out", "point", "note"))
    uploads = derived.payloads(spark, sf_dir)
    sensor = F.regexp_extract("payload", '"sensorId":"([^"]*)"', 1)
    uploads = uploads.select("arrival_seq", sensor.alias("key"), F.col("payload").alias("value"))
    with recorded() as staged:
        # Each write computes its messages twice, so they are staged: a payload costs far more than reading it back.
        uploads = stage(uploads, "uploads")
        half = F.lit(uploads.agg(F.max("arrival_seq")).first()[0] or 0) / 2
        for batch, part in enumerate((F.col("arrival_seq") <= half, F.col("arrival_seq") > half)):
            shard_log.append_messages(uploads.where(part), log, LOG_SHARDS, ("arrival_seq",), "uploads", batch)
    discard(spark, staged)
    # Four batches, whatever the size of the log.
    rows = max(1, -(-max(shard_log.Log(log).last()["ends"].values(), default=0) // 4))
    query = (
        shard_log.stream_messages(spark, log, rows_per_shard=rows, progress=note)
        .writeStream.format("parquet")
        .option("checkpointLocation", point)
        .start(out)
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    messages = spark.read.schema(shard_log.SCHEMA).parquet(out)
    decoded = decode_flagged(from_kafka(messages))
    return decoded.select(
        F.col("sensorId").alias("sensor_id"),
        F.when(F.col("malformed"), "malformed").otherwise("decoded").alias("status"),
        F.size("record").alias("n_records"),
        F.col("record")[0]["timestamp"].alias("first_timestamp"),
    )


def explode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exploded(spark, sf_dir).select(
        *ARRIVAL,
        "host_rcpn",
        sensor_id_or(F.col("sensorId"), "none").alias("sensor_id"),
        F.col("record.timestamp").alias("record_timestamp"),
    )


def host_rcpn_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derived.record_sets(spark, sf_dir).select(
        "arrival_seq", F.posexplode("record").alias("record_pos", "record")
    )
    return records.select(*ARRIVAL, host_rcpn(F.col("record.channel")).alias("host_rcpn"))


def channel_map_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derived.record_sets(spark, sf_dir).select(
        "arrival_seq", F.posexplode("record").alias("record_pos", "record")
    )
    by_type = records.select(*ARRIVAL, channel_map(F.col("record.channel")).alias("m"))
    return by_type.select(
        *ARRIVAL,
        F.size("m").alias("n_types"),
        F.try_element_at("m", F.lit("NET"))["channel"].alias("net_channel"),
        F.try_element_at("m", F.lit("INVERTER_OUTPUT"))["channel"].alias("output_channel"),
    )


def raw_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings.with_raw_reading(_exploded(spark, sf_dir)).select(
        *ARRIVAL,
        "event_timestamp",
        "raw_imported_ws",
        "raw_exported_ws",
        "raw_host_rcpn",
        "real_power_w",
        "voltage_v",
        "reactive_power_var",
    )


def sys_mode_code_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.col("record")[0]["sysMode"]
    return derived.record_sets(spark, sf_dir).select(
        "arrival_seq", sys_mode_code(mode, -1).alias("sys_mode_code")
    )


def _signed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional times on both sides of zero."""
    middle = derived.BASE_US + 15 * 86400 * 1_000_000
    return derived.events(spark, sf_dir).select(
        "e", epoch_seconds((F.col("raw_us") - middle) / F.lit(1e6)).alias("t")
    )


def slot_floor_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed_seconds(spark, sf_dir).select(
        F.col("e").alias("event_id"),
        F.col("t"),
        slot_floor(F.col("t")).alias("slot_5min"),
        slot_floor(F.col("t"), 3600).alias("slot_1h"),
    )


def slot_nearest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed_seconds(spark, sf_dir).select(
        F.col("e").alias("event_id"),
        slot_nearest(F.col("t")).alias("slot_5min"),
        slot_nearest(F.col("t"), 3600).alias("slot_1h"),
    )


def time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = derived.events(spark, sf_dir).select(
        F.col("e").alias("event_id"), (F.col("raw_us") / F.lit(1e6)).alias("t")
    )
    return readings.time_range_filter(timed, FILTER_NOW, "t").select("event_id")


def record_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derived.record_sets(spark, sf_dir).select(
        "arrival_seq", F.posexplode("record").alias("record_pos", "record")
    )
    return readings.valid_records(records).select(*ARRIVAL)


def slot_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(*ARRIVAL, "host_rcpn", "slot", "slot_class")


def energy_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deltas(spark, sf_dir).select(
        *ARRIVAL,
        "host_rcpn",
        "timestamp_utc",
        "time_delta_seconds",
        "delta_imported_ws",
        "delta_exported_ws",
    )


def quality_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.quality_events(_classified(spark, sf_dir))


def enrich_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _known(_readings(spark, sf_dir), spark, sf_dir)
    return known.select(
        *ARRIVAL,
        "system_host_rcpn",
        "system_id",
        "site_id",
        "is_registered",
        "timezone",
        "location_id",
    )


def enrich_systems_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _readings(spark, sf_dir).select(*ARRIVAL, "raw_host_rcpn", "processed_at")
    return enrich.enrich_systems_asof(stage(asked, "asked"), derived.system_versions(spark, sf_dir))


def unmatched_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = enrich.unmatched_systems(_readings(spark, sf_dir), derived.systems(spark, sf_dir))
    return missed.select(*ARRIVAL, "host_rcpn", "raw_host_rcpn")


def registration_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _known(_readings(spark, sf_dir), spark, sf_dir)
    return readings.pass_unregistered(known).select(
        *ARRIVAL, "system_host_rcpn", "is_registered", "swapped"
    )


def _all_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = enrich.unmatched_systems(_readings(spark, sf_dir), derived.systems(spark, sf_dir))
    return stage(missed.select(*ARRIVAL, "raw_host_rcpn", "processed_at"), "missed")


def dlq_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throttle.suppress_misses(_all_misses(spark, sf_dir))


def dlq_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extra of 60 up to 61 seconds, that is 60, for a result that SQL can follow."""
    return throttle.suppress_misses(_all_misses(spark, sf_dir), jitter=(60, 1))


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = enrich.dead_letters(_misses(spark, sf_dir))
    record = F.get_json_object("body", "$.record")
    return letters.select(
        "dlq_key",
        F.get_json_object("body", "$.error").alias("error"),
        F.get_json_object(record, "$.sysMode").alias("sys_mode"),
    )


def not_found_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.not_found_metrics(_misses(spark, sf_dir)).select(
        "name",
        "type",
        "timestamp",
        "interval_ms",
        "value",
        F.col("attributes")["hostRcpn"].alias("host_rcpn"),
    )


def _as_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of a registered system as if it were a delta: several devices per
    system, late rows, and one system with a third of all rows."""
    known = _known(_readings(spark, sf_dir), spark, sf_dir)
    return readings.registered(known).withColumn(
        "timestamp_utc", slot_floor(F.col("event_timestamp")) - 1
    )


def ess_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    looked_up = ct.ess_lookup(_as_deltas(spark, sf_dir), derived.ess_energy(spark, sf_dir))
    return looked_up.select(
        *ARRIVAL, "system_id", "ess_imported_ws", "ess_exported_ws", "ess_outcome"
    )


def ct_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ct.ess_lookup(_as_deltas(spark, sf_dir), derived.ess_energy(spark, sf_dir)).select(
        *ARRIVAL,
        "system_id",
        "timestamp_utc",
        "raw_imported_ws",
        "raw_exported_ws",
        "ess_outcome",
    )
    return ct.ct_inversion(stage(rows, "ct_rows")).select(
        *ARRIVAL, "system_id", "timestamp_utc", "swapped", "checked"
    )


_CORRECTED = [
    *ARRIVAL,
    "system_host_rcpn",
    "timestamp_utc",
    "raw_imported_ws",
    "raw_exported_ws",
    "delta_imported_ws",
    "delta_exported_ws",
    "swapped",
]


def ct_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = readings.registered(_enriched(spark, sf_dir))
    return ct.ct_correct(ct.ct_inversion(known)).select(*_CORRECTED)


def corrected_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.split_and_correct(_enriched(spark, sf_dir)).select(*_CORRECTED)


def energy_dataframe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _job(spark, sf_dir).energy.select(
        "partition_key",
        "timestamp_utc",
        "timezone",
        "host_rcpn",
        "system_id",
        "dataframe_type",
        "system_registration_type",
        "raw_data.*",
        "delta_data.*",
        "rgm_data.*",
    )


def partner_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _job(spark, sf_dir).partner
    records = sent.select(
        "partition_key",
        "timestamp_utc",
        "system_id",
        "site_id",
        F.size("energy_record_set").alias("n_records"),
        F.try_element_at("energy_record_set", F.lit(1)).alias("r"),
    )
    return records.select(
        "partition_key",
        "timestamp_utc",
        "system_id",
        "site_id",
        "n_records",
        "r.inverter_state",
        "r.sys_mode",
        "r.current_timestamp",
        "r.previous_timestamp",
        F.explode_outer("r.channel").alias("c"),
    ).select("*", "c.*").drop("c")


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_summary(_job(spark, sf_dir).energy)


QUERIES = {
    "decode_record_sets": decode_record_sets,
    "message_log": message_log,
    "explode_records": explode_records,
    "host_rcpn": host_rcpn_query,
    "channel_map": channel_map_query,
    "raw_reading": raw_reading,
    "sys_mode_code": sys_mode_code_query,
    "slot_floor": slot_floor_query,
    "slot_nearest": slot_nearest_query,
    "time_range_filter": time_range_filter,
    "record_validation": record_validation,
    "slot_classify": slot_classify,
    "energy_delta": energy_delta,
    "quality_events": quality_events,
    "enrich_systems": enrich_systems,
    "enrich_systems_asof": enrich_systems_asof,
    "unmatched_systems": unmatched_systems,
    "registration_split": registration_split,
    "dlq_suppression": dlq_suppression,
    "dlq_jitter": dlq_jitter,
    "dead_letter": dead_letter,
    "not_found_metrics": not_found_metrics,
    "ess_lookup": ess_lookup,
    "ct_inversion": ct_inversion,
    "ct_correct": ct_correct,
    "corrected_union": corrected_union,
    "energy_dataframe": energy_dataframe,
    "partner_telemetry": partner_telemetry,
    "daily_summary": daily_summary,
}
