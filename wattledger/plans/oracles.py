"""Each query of `queries` in DuckDB SQL, written on flat rows instead of nested arrays."""

from __future__ import annotations

from wattledger.plans.queries import FILTER_NOW, NOW
from wattledger.sources.derived import BASE_US

_BASE = f"""
ev AS (
  SELECT event_id AS e, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS d,
         {BASE_US} + (epoch_us(ts) - {BASE_US}) // 36 AS us, epoch_us(ts) AS raw_us,
         CAST(round(value * 100) AS BIGINT) AS c, event_type
  FROM events
),
-- one row per record, with its channels as flags and columns
rec AS (
  SELECT e, d, us, c, pos, us // 1000000 AS processed_at,
         us - CASE WHEN e % 10 = 0 THEN 900000000 ELSE 0 END + pos * 300000000 AS rus,
         'host-' || d AS host,
         e % 2 = 0 AS has_net, e % 19 = 4 AS has_untyped,
         CASE WHEN pos = 0 THEN e % 43 <> 8 ELSE e % 5 <> 1 END AS has_first
  FROM ev, (VALUES (0), (1)) AS p(pos)
  WHERE pos = 0 OR e % 4 = 1
),
channels AS (
  SELECT *, has_first AND e % 23 = 7 AS has_second, has_first AND e % 29 = 11 AS has_solar,
         CASE WHEN e % 31 = 5 THEN NULL WHEN e % 37 = 9 THEN 'unknown'
              WHEN e % 41 = 3 THEN chr(8195) || ' ' ELSE host END AS first_id,
         CASE WHEN d % 3 = 1 THEN 1000000000 ELSE 40000000000 END + e * 100 + c + pos * 7 AS imp,
         CASE WHEN d % 3 = 1 THEN 40000000000 ELSE 1000000000 END + e * 10 + d AS exp
  FROM rec
),
flat AS (
  SELECT *, rus / 1000000.0::DOUBLE AS record_ts, rus // 1000000 AS t,
         CASE WHEN NOT has_first THEN 'unknown' ELSE coalesce(first_id, '') END AS key,
         CASE WHEN e % 97 = 0 THEN NULL WHEN e % 101 = 0 THEN 5000000 ELSE imp END AS first_imp,
         CASE WHEN e % 101 = 0 THEN 5000000 ELSE exp END AS first_exp,
         CASE WHEN e % 61 = 17 THEN 'HOLIDAY' ELSE
           (['SAFETY_SHUTDOWN', 'GRID_TIE', 'SELF_SUPPLY', 'CLEAN_BACKUP', 'PRIORITY_BACKUP',
             'REMOTE_ARBITRAGE', 'SELL', NULL, 'SELF_SUPPLY'])[e % 9 + 1] END AS mode
  FROM channels
),
usable AS (
  SELECT *, sum(CASE WHEN key = host THEN 0 ELSE 1 END)
              OVER (PARTITION BY e ORDER BY pos) = 0 AS kept
  FROM flat
),
raw AS (
  SELECT *,
    CASE WHEN has_solar THEN NULL WHEN has_second THEN imp + 11 ELSE first_imp END AS ri,
    CASE WHEN has_solar THEN NULL WHEN has_second THEN exp + 13 ELSE first_exp END AS re,
    CASE WHEN has_solar THEN NULL ELSE host END AS rh,
    CAST(CASE WHEN has_solar THEN NULL WHEN has_second THEN e % 5000 - 499
              ELSE e % 5000 - 500 END AS INTEGER) AS power,
    CASE WHEN has_solar OR e % 53 = 0 THEN NULL
         ELSE CAST(220 + (e % 40) * 0.25 AS FLOAT) END AS voltage,
    CAST(CASE WHEN has_solar OR e % 59 = 0 THEN NULL ELSE e % 300 - 150 END AS INTEGER) AS reactive
  FROM usable WHERE kept
),
readings AS (
  SELECT *, t - t % 300 AS slot FROM raw
  WHERE <in_range>
),
systems AS (
  SELECT d, 'host-' || d AS shost, 'system-' || (d // 2) AS sid, 'site-' || d AS site,
         coalesce(CASE WHEN u % 19 = 7 THEN NULL ELSE u % 7 <> 3 END, false) AS registered,
         CASE u % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                    ELSE 'UNKNOWN' END AS zone,
         'location-' || u AS location
  FROM (SELECT d, max(e) AS u FROM ev WHERE d % 11 <> 5 GROUP BY d)
),
ess AS (
  SELECT sid, start_ts - start_ts % 300 AS ess_slot, arg_min(imp, (start_ts, imp, exp)) AS ess_imp,
         arg_min(exp, (start_ts, imp, exp)) AS ess_exp
  FROM (
    SELECT 'system-' || (d // 2) AS sid,
           us // 1000000 - CASE WHEN e % 10 = 0 THEN 900 ELSE 0 END - 300 + e % 60 AS start_ts,
           CAST(CASE WHEN e % 13 = 0 THEN 0 WHEN e % 2 = 0 THEN 40000 + e % 7
                     ELSE 1000 + e % 7 END AS DOUBLE) AS imp,
           CAST(CASE WHEN e % 13 = 0 THEN 0 WHEN e % 2 = 0 THEN 1000 ELSE 40000 END AS DOUBLE) AS exp
    FROM ev WHERE e % 5 <> 0
  ) GROUP BY ALL
)"""

_CLASSES = """,
marked AS (
  SELECT *, max(slot) OVER (PARTITION BY key ORDER BY e, pos
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
  FROM readings
),
accepted AS (
  SELECT e, pos, lag(slot) OVER w AS p_slot, lag(t) OVER w AS p_t, lag(ri) OVER w AS p_ri,
         lag(re) OVER w AS p_re
  FROM marked WHERE pm IS NULL OR slot > pm
  WINDOW w AS (PARTITION BY key ORDER BY e, pos)
),
classed AS (
  SELECT m.*, p_slot, p_t, p_ri, p_re,
         CASE WHEN pm IS NULL THEN 'FIRST' WHEN slot = pm THEN 'DUPLICATE' WHEN slot < pm THEN 'LATE'
              WHEN slot > p_slot + 300 THEN 'GAP' ELSE 'EMIT' END AS class
  FROM marked m LEFT JOIN accepted a ON m.e = a.e AND m.pos = a.pos
),
deltas AS (
  SELECT *, slot - 1 AS timestamp_utc, CAST(t - p_t AS INTEGER) AS seconds,
         ri - p_ri AS di, re - p_re AS de
  FROM classed WHERE class = 'EMIT'
)"""


def _ct(rows: str) -> str:
    """The check of inverted meters as a recursive fold over `rows`(e, pos, sid, slot, ri, re)."""
    return f""",
ct_in AS (
  SELECT r.e, r.pos, r.sid, r.slot, row_number() OVER (PARTITION BY r.sid ORDER BY r.e, r.pos) AS rn,
         CASE WHEN ri > re THEN 1 WHEN ri < re THEN -1 ELSE 0 END AS sgn,
         CASE WHEN ess_slot IS NULL THEN 'MISSING' WHEN ess_imp > ess_exp THEN 'POS'
              WHEN ess_imp < ess_exp THEN 'NEG' ELSE 'EQUAL' END AS outcome
  FROM {rows} r LEFT JOIN ess ON ess.sid = r.sid AND ess_slot = r.slot - 300
),
ct_signed AS (
  SELECT *, CASE WHEN outcome = 'POS' THEN 1 ELSE -1 END <> sgn AS opposite FROM ct_in
),
fold AS (
  SELECT DISTINCT sid, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BOOLEAN) AS sw,
         CAST(NULL AS BIGINT) AS until_ts, false AS flag, false AS checked
  FROM ct_signed
  UNION ALL
  SELECT x.sid, x.rn,
    CASE WHEN sgn = 0 OR NOT (sw IS NULL OR slot >= until_ts) THEN sw
         WHEN outcome = 'MISSING' THEN coalesce(sw, false) WHEN outcome = 'EQUAL' THEN sw
         ELSE opposite END,
    CASE WHEN sgn = 0 OR NOT (sw IS NULL OR slot >= until_ts) THEN until_ts
         WHEN outcome = 'MISSING' THEN coalesce(until_ts, slot + 21600)
         WHEN outcome = 'EQUAL' THEN until_ts ELSE slot + 21600 END,
    CASE WHEN sgn = 0 THEN false WHEN NOT (sw IS NULL OR slot >= until_ts) THEN sw
         WHEN outcome = 'MISSING' THEN coalesce(sw, false) WHEN outcome = 'EQUAL' THEN false
         ELSE opposite END,
    sgn <> 0 AND (sw IS NULL OR slot >= until_ts)
  FROM fold JOIN ct_signed x ON x.sid = fold.sid AND x.rn = fold.rn + 1
),
flags AS (
  SELECT x.e, x.pos, fold.flag, fold.checked
  FROM ct_signed x JOIN fold ON x.sid = fold.sid AND x.rn = fold.rn
)"""


def _suppressed(rows: str, ttl: int = 900) -> str:
    """Misses reported, as a recursive fold over `rows`."""
    return f""",
missed AS (
  SELECT m.*, coalesce(rh, '<none>') AS mhost,
         row_number() OVER (PARTITION BY rh ORDER BY processed_at, e, pos) AS rn
  FROM {rows} m WHERE rh IS NULL OR rh NOT IN (SELECT shost FROM systems)
),
fold AS (
  SELECT DISTINCT mhost, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS until_ts, false AS kept_row
  FROM missed
  UNION ALL
  SELECT x.mhost, x.rn,
         CASE WHEN until_ts IS NULL OR processed_at > until_ts THEN processed_at + {ttl}
              ELSE until_ts END,
         until_ts IS NULL OR processed_at > until_ts
  FROM fold JOIN missed x ON x.mhost = fold.mhost AND x.rn = fold.rn + 1
),
reported AS (
  SELECT m.* FROM missed m JOIN fold ON m.mhost = fold.mhost AND m.rn = fold.rn
  WHERE fold.kept_row
)"""


_JOB = (
    _CLASSES
    + """,
known AS (SELECT * FROM deltas JOIN systems ON rh = shost),
known_registered AS (SELECT * FROM known WHERE registered)"""
    + _ct("known_registered")
    + """,
corrected AS (
  SELECT k.* EXCLUDE (ri, re, di, de), coalesce(flag, false) AS swapped,
         CASE WHEN coalesce(flag, false) THEN re ELSE ri END AS ri,
         CASE WHEN coalesce(flag, false) THEN ri ELSE re END AS re,
         CASE WHEN coalesce(flag, false) THEN de ELSE di END AS di,
         CASE WHEN coalesce(flag, false) THEN di ELSE de END AS de
  FROM known k LEFT JOIN flags f ON k.e = f.e AND k.pos = f.pos
)"""
)


def _sql(select: str, more: str = "", job: bool = False) -> str:
    """A query over all readings, or over those within the job's time range."""
    in_range = f"t BETWEEN {NOW} - 604800 AND {NOW} + 1800" if job else "true"
    return f"WITH RECURSIVE {_BASE}{more}\n{select}".replace("<in_range>", in_range)


_ISO = "strftime(make_timestamp(({}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"
_SIGNED = (
    f"signed AS (SELECT e, CAST(trunc((epoch_us(ts) - {BASE_US + 15 * 86400 * 1_000_000}) "
    "/ 1000000.0::DOUBLE) AS BIGINT) AS t FROM (SELECT event_id AS e, ts FROM events))"
)
_NEAREST = (
    "CASE WHEN t % {0} < {1} THEN t - t % {0} "
    "ELSE (t + t % {0}) - (t + t % {0}) % {0} END"
)
_CORRECTED = """SELECT e AS arrival_seq, pos AS record_pos, shost AS system_host_rcpn, timestamp_utc,
  ri AS raw_imported_ws, re AS raw_exported_ws, di AS delta_imported_ws, de AS delta_exported_ws,
  swapped FROM corrected"""

# One row per inverter-output channel of a record.
_OUTPUT_CHANNELS = """
  SELECT e, pos, 1 AS channel, coalesce(first_id, '') AS device_id, e % 5000 - 500 AS power
  FROM flat WHERE has_first
  UNION ALL SELECT e, pos, 2, host, e % 5000 - 499 FROM flat WHERE has_second
  UNION ALL SELECT e, pos, 3, 'solar-' || d, 0 FROM flat WHERE has_solar"""

ORACLES = {
    "decode_record_sets": _sql(
        """SELECT e AS arrival_seq, CASE WHEN bad THEN 'malformed' ELSE 'decoded' END AS status,
  CASE WHEN NOT bad THEN 'sensor-' || d END AS sensor_id, CASE WHEN NOT bad THEN n END AS n_records,
  CASE WHEN NOT bad THEN k END AS n_channels, CASE WHEN NOT bad THEN x END AS exported_sum
FROM (
  SELECT e, d, e % 71 = 3 OR e % 61 = 17 AS bad, CAST(count(*) AS INTEGER) AS n,
    CAST(sum(has_net::INT + has_untyped::INT + has_first::INT + has_second::INT + has_solar::INT)
         AS INTEGER) AS k,
    CAST(sum(has_net::INT + CASE WHEN has_first THEN coalesce(first_imp, 0) ELSE 0 END
        + CASE WHEN has_second THEN imp + 11 ELSE 0 END + has_solar::INT) AS BIGINT) AS x
  FROM flat GROUP BY e, d)"""
    ),
    "message_log": _sql(
        """SELECT CASE WHEN NOT bad THEN 'sensor-' || d END AS sensor_id,
  CASE WHEN bad THEN 'malformed' ELSE 'decoded' END AS status,
  CASE WHEN NOT bad THEN n END AS n_records, CASE WHEN NOT bad THEN t0 END AS first_timestamp
FROM (
  SELECT e, d, e % 71 = 3 OR e % 61 = 17 AS bad, CAST(count(*) AS INTEGER) AS n,
    arg_min(record_ts, pos) AS t0
  FROM flat GROUP BY e, d)"""
    ),
    "explode_records": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, key AS host_rcpn, 'sensor-' || d AS sensor_id,
  record_ts AS record_timestamp FROM usable WHERE kept"""
    ),
    "host_rcpn": _sql("SELECT e AS arrival_seq, pos AS record_pos, key AS host_rcpn FROM flat"),
    "channel_map": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, has_net::INT + has_first::INT AS n_types,
  CASE WHEN has_net THEN 0 END AS net_channel,
  CASE WHEN has_solar THEN 3 WHEN has_second THEN 2 WHEN has_first THEN 1 END AS output_channel
FROM flat"""
    ),
    "raw_reading": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, t AS event_timestamp, ri AS raw_imported_ws,
  re AS raw_exported_ws, rh AS raw_host_rcpn, power AS real_power_w, voltage AS voltage_v,
  reactive AS reactive_power_var FROM raw"""
    ),
    "sys_mode_code": _sql(
        """SELECT e AS arrival_seq, CASE mode WHEN 'SAFETY_SHUTDOWN' THEN 0 WHEN 'GRID_TIE' THEN 1
  WHEN 'SELF_SUPPLY' THEN 2 WHEN 'CLEAN_BACKUP' THEN 3 WHEN 'PRIORITY_BACKUP' THEN 4
  WHEN 'REMOTE_ARBITRAGE' THEN 5 WHEN 'SELL' THEN 6 ELSE -1 END AS sys_mode_code
FROM flat WHERE pos = 0"""
    ),
    "slot_floor": f"""WITH {_SIGNED}
SELECT e AS event_id, t, t - t % 300 AS slot_5min, t - t % 3600 AS slot_1h FROM signed""",
    "slot_nearest": f"""WITH {_SIGNED}
SELECT e AS event_id, {_NEAREST.format(300, 150)} AS slot_5min,
  {_NEAREST.format(3600, 1800)} AS slot_1h FROM signed""",
    "time_range_filter": f"""SELECT event_id FROM events
WHERE epoch_us(ts) // 1000000 BETWEEN {FILTER_NOW} - 7 * 86400 AND {FILTER_NOW} + 30 * 60""",
    "record_validation": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos FROM flat
WHERE (has_first AND first_id IS NOT NULL) OR has_second"""
    ),
    "slot_classify": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, key AS host_rcpn, slot, class AS slot_class
FROM classed""",
        _CLASSES,
    ),
    "energy_delta": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, key AS host_rcpn, timestamp_utc,
  seconds AS time_delta_seconds, di AS delta_imported_ws, de AS delta_exported_ws FROM deltas""",
        _CLASSES,
    ),
    "quality_events": _sql(
        f"""SELECT key AS identifier, e AS arrival_seq, pos AS record_pos,
  CASE WHEN class = 'LATE' THEN 'Late_Event' ELSE 'Future_Event' END AS event_type,
  pm + 300 AS expected_slot, slot AS actual_slot,
  'Was expecting ' || {_ISO.format("pm + 300")} || ' timestamp, but got ' || {_ISO.format("slot")}
    AS message
FROM classed WHERE class IN ('LATE', 'GAP')""",
        _CLASSES,
    ),
    "enrich_systems": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, shost AS system_host_rcpn, sid AS system_id,
  site AS site_id, registered AS is_registered, zone AS timezone, location AS location_id
FROM readings JOIN systems ON rh = shost"""
    ),
    "enrich_systems_asof": _sql(
        """SELECT r.e AS arrival_seq, r.pos AS record_pos, r.rh AS raw_host_rcpn, r.processed_at,
  f.asked_at, f.until_ts AS expires_at, v.valid_from, v.sid AS system_id, v.site AS site_id,
  v.registered AS is_registered, v.zone AS timezone, v.location AS location_id
FROM seen r JOIN fold f ON f.mhost = r.mhost AND f.rn = r.rn
LEFT JOIN versions v ON v.shost = r.rh AND v.valid_from = f.version""",
        """,
versions AS (
  SELECT 'host-' || d AS shost, us // 1000000 + 3600 AS valid_from, 'system-' || (d // 2) AS sid,
         'site-' || d AS site,
         coalesce(CASE WHEN e % 19 = 7 THEN NULL ELSE e % 7 <> 3 END, false) AS registered,
         CASE e % 5 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                    ELSE 'UNKNOWN' END AS zone,
         'location-' || e AS location
  FROM ev WHERE d % 11 <> 5 AND e % 23 = 4
  QUALIFY row_number() OVER (PARTITION BY d, us // 1000000 ORDER BY e DESC) = 1
),
seen AS (
  SELECT r.*, coalesce(rh, '<none>') AS mhost, v.valid_from AS version,
         row_number() OVER (PARTITION BY rh ORDER BY processed_at, e, pos) AS rn
  FROM readings r ASOF LEFT JOIN versions v ON r.rh = v.shost AND r.processed_at >= v.valid_from
),
fold AS (
  SELECT DISTINCT mhost, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS until_ts,
         CAST(NULL AS BIGINT) AS asked_at, CAST(NULL AS BIGINT) AS version
  FROM seen
  UNION ALL
  SELECT x.mhost, x.rn,
    CASE WHEN until_ts IS NULL OR processed_at > until_ts
         THEN processed_at + CASE WHEN x.version IS NULL THEN 900 ELSE 14400 END ELSE until_ts END,
    CASE WHEN until_ts IS NULL OR processed_at > until_ts THEN processed_at ELSE asked_at END,
    CASE WHEN until_ts IS NULL OR processed_at > until_ts THEN x.version ELSE fold.version END
  FROM fold JOIN seen x ON x.mhost = fold.mhost AND x.rn = fold.rn + 1
)""",
    ),
    "unmatched_systems": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, key AS host_rcpn, rh AS raw_host_rcpn
FROM readings WHERE rh IS NULL OR rh NOT IN (SELECT shost FROM systems)"""
    ),
    "registration_split": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, shost AS system_host_rcpn,
  registered AS is_registered, CASE WHEN NOT registered THEN false END AS swapped
FROM readings JOIN systems ON rh = shost"""
    ),
    "dlq_suppression": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, rh AS raw_host_rcpn, processed_at
FROM reported""",
        _suppressed("readings"),
    ),
    "dlq_jitter": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, rh AS raw_host_rcpn, processed_at
FROM reported""",
        _suppressed("readings", ttl=900 + 60),
    ),
    "dead_letter": _sql(
        """SELECT strftime(make_timestamp(slot * 1000000), '%Y-%m-%d') || '/' || coalesce(rh, 'null')
    || '/' || slot || '.json' AS dlq_key,
  'No system information found for ' || coalesce(rh, 'null') AS error, mode AS sys_mode
FROM reported""",
        _CLASSES + _suppressed("deltas"),
    ),
    "not_found_metrics": _sql(
        """SELECT 'delta.rgm.resourceNotFoundCount.dev' AS name, 'count' AS type,
  (processed_at - processed_at % 300) * 1000 AS timestamp, CAST(300000 AS BIGINT) AS interval_ms,
  count(*) AS value, rh AS host_rcpn
FROM reported GROUP BY rh, processed_at - processed_at % 300""",
        _CLASSES + _suppressed("deltas"),
    ),
    "ess_lookup": _sql(
        """SELECT e AS arrival_seq, pos AS record_pos, s.sid AS system_id, ess_imp AS ess_imported_ws,
  ess_exp AS ess_exported_ws,
  CASE WHEN ess_slot IS NULL THEN 'MISSING' WHEN ess_imp > ess_exp THEN 'POS'
       WHEN ess_imp < ess_exp THEN 'NEG' ELSE 'EQUAL' END AS ess_outcome
FROM readings JOIN systems s ON rh = shost
LEFT JOIN ess ON ess.sid = s.sid AND ess_slot = slot - 300
WHERE registered"""
    ),
    "ct_inversion": _sql(
        """SELECT k.e AS arrival_seq, k.pos AS record_pos, sid AS system_id,
  slot - 1 AS timestamp_utc, flag AS swapped, checked
FROM known_registered k JOIN flags f ON k.e = f.e AND k.pos = f.pos""",
        """,
known_registered AS (SELECT * FROM readings JOIN systems ON rh = shost WHERE registered)"""
        + _ct("known_registered"),
    ),
    "ct_correct": _sql(_CORRECTED + " WHERE registered", _JOB),
    "corrected_union": _sql(_CORRECTED, _JOB),
    "energy_dataframe": _sql(
        """SELECT shost AS partition_key, timestamp_utc,
  CASE WHEN registered THEN zone ELSE 'UTC' END AS timezone, shost AS host_rcpn, sid AS system_id,
  'RGM' AS dataframe_type,
  CASE WHEN registered THEN 'REGISTERED' ELSE 'UNREGISTERED' END AS system_registration_type,
  t AS raw_timestamp, re AS raw_inverter_lifetime_exported_ws,
  ri AS raw_inverter_lifetime_imported_ws, seconds AS time_diff_in_seconds,
  de AS inverter_energy_exported_ws, di AS inverter_energy_imported_ws, power AS real_power_w,
  voltage AS voltage_v, reactive AS reactive_power_var, swapped AS is_inverter_output_swapped
FROM corrected""",
        _JOB,
        job=True,
    ),
    "partner_telemetry": _sql(
        f"""SELECT shost AS partition_key, timestamp_utc, sid AS system_id, site AS site_id,
  ok::INT AS n_records,
  CASE WHEN ok THEN ([2080, 2096, 0, 784, 49152, 2080])[k.e % 6 + 1] END AS inverter_state,
  CASE WHEN ok THEN coalesce(mode, 'SAFETY_SHUTDOWN') END AS sys_mode,
  CASE WHEN ok THEN record_ts END AS "current_timestamp",
  CASE WHEN ok THEN record_ts - seconds END AS previous_timestamp,
  o.channel, CASE WHEN ok THEN 'INVERTER_OUTPUT' END AS channel_type,
  CASE WHEN ok THEN de END AS delta_exported_energy_ws,
  CASE WHEN ok THEN di END AS delta_imported_energy_ws,
  CASE WHEN ok THEN re END AS exported_energy_ws, CASE WHEN ok THEN ri END AS imported_energy_ws,
  CASE WHEN ok THEN 'INVERTER' END AS device_type, o.device_id,
  CAST(o.power AS INTEGER) AS real_power_w,
  CASE WHEN ok THEN true END AS is_revenue_grade
FROM (
  SELECT *, mode IS DISTINCT FROM 'HOLIDAY' AND ri IS NOT NULL AND re IS NOT NULL AS ok
  FROM corrected WHERE registered
) k LEFT JOIN ({_OUTPUT_CHANNELS}) o ON ok AND k.e = o.e AND k.pos = o.pos""",
        _JOB,
        job=True,
    ),
    "daily_summary": _sql(
        """SELECT strftime(make_timestamp(timestamp_utc * 1000000), '%Y-%m-%d') AS event_date,
  CASE WHEN registered THEN 'REGISTERED' ELSE 'UNREGISTERED' END AS registration,
  count(*) AS n_rows, CAST(sum(di) AS BIGINT) AS imported_ws, CAST(sum(de) AS BIGINT) AS exported_ws,
  CAST(sum(swapped::INT) AS BIGINT) AS n_swapped, CAST(sum(seconds) AS BIGINT) AS seconds
FROM corrected GROUP BY 1, 2""",
        _JOB,
        job=True,
    ),
}
