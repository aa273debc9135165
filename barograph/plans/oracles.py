"""The catalogue's queries as SQL for another engine, over the same tables."""

from __future__ import annotations

from barograph.plans.catalogue import (
    BASE_EPOCH,
    BUS_PARTITIONS,
    DAY,
    DEVICE,
    LOG_SENSOR,
    LOG_WALK,
    ONE_SENSOR,
    ONE_WALK,
    POINTS,
    TOPIC,
    TYPE_WALK,
    USER,
    WALK_DAY,
    YEAR,
)
from barograph.schema import CACHE



def six(number: str) -> str:
    """Rounded as the queries' doubles are: half up, at six decimals, as a decimal number."""
    return f"CAST(ROUND(CAST({number} AS DECIMAL(38, 9)), 6) AS DOUBLE)"


MEASURED = f"""
measured AS (
  SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS walkId, '{DEVICE}' AS deviceId,
         event_type AS sensorType, date_trunc('second', ts) AS eventTime, ts,
         value AS pressureHpa
  FROM events
)"""

STATISTICS = f"""COUNT(*) AS measurementCount, AVG(pressureHpa) AS mean,
       {six('AVG(pressureHpa)')} AS avgPressureHpa,
       {six('MIN(pressureHpa)')} AS minPressureHpa,
       {six('MAX(pressureHpa)')} AS maxPressureHpa,
       {six('STDDEV_SAMP(pressureHpa)')} AS stddevPressureHpa"""

ALL_KEYS = "walkId, deviceId, sensorType"


def windows(
    size: str,
    slide: str,
    overlap: int,
    keys: str = ALL_KEYS,
    kept: str = "TRUE",
    extra: str = "",
    measured: str = MEASURED,
) -> str:
    """``WITH`` list that ends in ``stats``: each row joined to its ``overlap`` windows."""
    listed = f", {keys}" if keys else ""
    return f"""WITH {measured}{extra},
spans AS (
  SELECT time_bucket(INTERVAL '{slide}', eventTime, TIMESTAMP '1970-01-01')
           - i * INTERVAL '{slide}' AS windowStart, measured.*
  FROM measured CROSS JOIN range({overlap}) steps(i)
),
stats AS (
  SELECT windowStart, windowStart + INTERVAL '{size}' AS windowEnd{listed},
       {STATISTICS}
  FROM spans WHERE {kept}
  GROUP BY windowStart{listed}
)
"""


CACHE_NAMES = ", ".join(
    f"{stat} AS {column}"
    for column, stat in zip(
        [name for name in CACHE.fieldNames() if name != "updated_at"],
        ["walkId", "deviceId", "sensorType", "windowStart", "windowEnd", "measurementCount",
         "avgPressureHpa", "minPressureHpa", "maxPressureHpa", "stddevPressureHpa"],
    )
)
LONG = windows("2 days", "1 day", 2)
HALF_HOURLY = windows("1 hour", "30 minutes", 2)
HALF_HOURLY_TOGETHER = windows("1 hour", "30 minutes", 2, keys="")
MINUTELY = windows("1 hour", "1 minute", 60, keys="sensorType")
UNEVEN = windows("3 days", "2 days", 2, kept="windowStart + INTERVAL '3 days' > eventTime")
HOURLY = windows("1 hour", "1 hour", 1, keys="sensorType")
LATE = windows(
    "20 days", "10 days", 2,
    extra=""",
halves AS (
  SELECT make_timestamp((epoch_us(MIN(ts)) + epoch_us(MAX(ts))) // 2) AS middle,
         MAX(eventTime) - INTERVAL '1 minute' AS watermark
  FROM measured
)""",
    kept="""ts >= (SELECT middle FROM halves)
     OR windowStart + INTERVAL '20 days' > (SELECT watermark FROM halves)""",
)
# Three parts of the time range, the middle one sent first. The watermark a batch meets follows
# from the batches before it: the oldest part counts in windows that the middle one left open.
SENT = windows(
    "20 days", "10 days", 2,
    extra=""",
ends AS (SELECT epoch_us(MIN(ts)) AS low, epoch_us(MAX(ts)) AS high FROM measured),
thirds AS (
  SELECT make_timestamp(low + (high - low) * 1 // 3) AS one, make_timestamp(low + (high - low) * 2 // 3) AS two
  FROM ends
),
marks AS (
  SELECT MAX(eventTime) FILTER (WHERE ts < (SELECT two FROM thirds)) - INTERVAL '1 minute' AS first,
         MAX(eventTime) - INTERVAL '1 minute' AS last
  FROM measured
)""",
    kept="""ts >= (SELECT one FROM thirds)
     OR windowStart + INTERVAL '20 days' > (SELECT first FROM marks)""",
)
TYPES_AS_WALKS = windows(
    "1 hour", "30 minutes", 2,
    measured=f"""
measured AS (
  SELECT event_type AS walkId, '{DEVICE}' AS deviceId, '{LOG_SENSOR}' AS sensorType,
         date_trunc('second', ts) AS eventTime, value AS pressureHpa
  FROM events
)""",
)
CACHE_ROWS = f"SELECT {CACHE_NAMES} FROM stats"
WALK = f"walkId = '{ONE_WALK}' AND sensorType = '{ONE_SENSOR}'"

WORD = (
    r"[^\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
TEXT_TOTALS = rf"""WITH lines AS (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS line FROM documents
),
counts AS (
  SELECT CAST(SUM(length(line)) AS BIGINT) AS chars,
         CAST(SUM(len(regexp_extract_all(line, '{WORD}'))) AS BIGINT) AS words,
         COUNT(*) AS lines
  FROM lines
)
SELECT 'chars' AS key, chars AS total FROM counts
UNION ALL SELECT 'words', words FROM counts
UNION ALL SELECT 'lines', lines FROM counts"""

ELAPSED = six(f"epoch_us(ts) / 1000000.0::DOUBLE - {BASE_EPOCH}::DOUBLE")

ORACLES = {
    "sliding_stats_10s_5s": windows("10 seconds", "5 seconds", 2) + "SELECT * EXCLUDE (mean) FROM stats",
    "sliding_stats_2d_1d": LONG + "SELECT * EXCLUDE (mean) FROM stats",
    "tumbling_stats_1h": HOURLY + "SELECT * EXCLUDE (mean) FROM stats",
    "pane_stats_1h_1m": MINUTELY + "SELECT * EXCLUDE (mean) FROM stats",
    "pane_stats_3d_2d": UNEVEN + "SELECT * EXCLUDE (mean) FROM stats",
    "live_pane_windows": UNEVEN + "SELECT * EXCLUDE (mean) FROM stats",
    "message_window_stats": LONG + "SELECT * EXCLUDE (mean) FROM stats",
    "cache_layout": LONG + CACHE_ROWS,
    "parse_json_payload": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "event_time_seconds": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       date_trunc('second', ts) AS event_time
FROM events""",
    "event_time_micros": "SELECT event_id, ts AS event_time FROM events",
    "envelope_roundtrip": f"""
SELECT '{TOPIC}' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset",
       ts AS kafkaTimestamp, CAST(user_id AS VARCHAR) AS messageKey, '{USER}' AS userId,
       '{DEVICE}' AS deviceId, CAST(user_id AS VARCHAR) AS walkId, event_type AS sensorType,
       date_trunc('second', ts) AS eventTime, {ELAPSED} AS timeSeconds,
       {six('value')} AS pressureHpa
FROM events""",
    "bus_offsets": f"""
SELECT "partition", ROW_NUMBER() OVER (PARTITION BY "partition" ORDER BY ts, event_id) - 1 AS "offset",
       ts AS kafkaTimestamp, CAST(user_id AS VARCHAR) AS messageKey,
       CAST(user_id AS VARCHAR) AS walkId, event_type AS sensorType, {six('value')} AS pressureHpa
FROM (
  SELECT *, CAST(CAST('0x' || left(md5(CAST(user_id AS VARCHAR)), 8) AS BIGINT) % {BUS_PARTITIONS}
                 AS INTEGER) AS "partition"
  FROM events
)""",
    "csv_log_roundtrip": f"""
SELECT '{LOG_WALK}' AS messageKey, '{USER}' AS userId, '{DEVICE}' AS deviceId,
       '{LOG_WALK}' AS walkId, '{LOG_SENSOR}' AS sensorType,
       date_trunc('second', ts) AS eventTime, {ELAPSED} AS timeSeconds,
       {six('value')} AS pressureHpa
FROM events""",
    "csv_many_logs": f"""
SELECT CAST(user_id AS VARCHAR) AS messageKey, CAST(user_id AS VARCHAR) AS walkId,
       '{LOG_SENSOR}' AS sensorType, date_trunc('second', ts) AS eventTime,
       {six("epoch_us(ts) / 1000000.0::DOUBLE - floor(epoch_us(MIN(ts) OVER (PARTITION BY user_id)) / 1000000.0::DOUBLE)")}
         AS timeSeconds,
       {six('value')} AS pressureHpa
FROM events""",
    "walk_sensor_year": f"""WITH {MEASURED}
SELECT * EXCLUDE (ts) REPLACE ({six('pressureHpa')} AS pressureHpa) FROM measured
WHERE {WALK} AND year(eventTime) = {YEAR} ORDER BY eventTime""",
    "year_day_filter": f"""
SELECT event_id, ts, user_id, event_type, {six('value')} AS value FROM events
WHERE year(ts) = {YEAR} AND CAST(ts AS DATE) = DATE '{DAY}' ORDER BY ts""",
    "windows_with_spread": LONG + "SELECT * EXCLUDE (mean) FROM stats WHERE stddevPressureHpa IS NOT NULL",
    "range_diagnostic": HALF_HOURLY + """
SELECT MIN(windowStart) AS min_window_start, MAX(windowStart) AS max_window_start,
       COUNT(*) AS row_count FROM stats""",
    "daily_counts": """
SELECT CAST(ts AS DATE) AS date, COUNT(*) AS count FROM events GROUP BY 1 ORDER BY 1""",
    "newest_20": f"""WITH {MEASURED}
SELECT * EXCLUDE (ts) REPLACE ({six('pressureHpa')} AS pressureHpa) FROM measured
ORDER BY eventTime DESC NULLS LAST, "offset" LIMIT 20""",
    "newest_20_windows": HALF_HOURLY + """
SELECT * EXCLUDE (mean) FROM stats ORDER BY windowStart DESC NULLS LAST, walkId, sensorType LIMIT 20""",
    "last_100_band": HALF_HOURLY_TOGETHER + """
SELECT * FROM (
  SELECT windowStart, avgPressureHpa, minPressureHpa, maxPressureHpa, measurementCount
  FROM stats WHERE avgPressureHpa IS NOT NULL ORDER BY windowStart DESC LIMIT 100
) ORDER BY windowStart""",
    "day_band": HALF_HOURLY_TOGETHER + f"""
SELECT windowStart AS window_start, avgPressureHpa AS avg_pressure_hpa,
       minPressureHpa AS min_pressure_hpa, maxPressureHpa AS max_pressure_hpa,
       measurementCount AS measurement_count
FROM stats
WHERE CAST(windowStart AS DATE) = DATE '{DAY}' AND avgPressureHpa IS NOT NULL
ORDER BY windowStart""",
    "line_stats": TEXT_TOTALS,
    "line_pair_sums": TEXT_TOTALS,
    "text_file_stats": TEXT_TOTALS,
    "stream_live_table": LONG + "SELECT * EXCLUDE (mean) FROM stats",
    "live_table_sql": LONG + """
SELECT windowStart, windowEnd, walkId, sensorType, measurementCount, avgPressureHpa
FROM stats ORDER BY windowStart DESC, walkId, sensorType LIMIT 20""",
    "stream_bronze": f"""
SELECT '{TOPIC}' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset",
       CAST(user_id AS VARCHAR) AS messageKey, '{USER}' AS userId, '{DEVICE}' AS deviceId,
       CAST(user_id AS VARCHAR) AS walkId, event_type AS sensorType,
       date_trunc('second', ts) AS eventTime, ts AS kafkaTimestamp, {ELAPSED} AS timeSeconds,
       {six('value')} AS pressureHpa, CAST(ts AS DATE) AS eventDate
FROM events""",
    "bronze_day": f"""
SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS walkId,
       date_trunc('second', ts) AS eventTime, {six('value')} AS pressureHpa,
       CAST(ts AS DATE) AS eventDate
FROM events WHERE CAST(ts AS DATE) = DATE '{DAY}' AND event_type = '{ONE_SENSOR}'""",
    "bronze_bad_rows": f"""
SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS messageKey
FROM events WHERE event_type = '{ONE_SENSOR}'""",
    "stream_health": f"""
WITH ends AS (SELECT epoch_us(MIN(ts)) AS low, epoch_us(MAX(ts)) AS high FROM events),
parts AS (
  SELECT CAST(CASE WHEN ts < make_timestamp(low + (high - low) * 1 // 3) OR ts IS NULL THEN 0
                   WHEN ts < make_timestamp(low + (high - low) * 2 // 3) THEN 1 ELSE 2 END AS BIGINT) AS batch_id,
         CASE WHEN event_type <> '{ONE_SENSOR}' THEN date_trunc('second', ts) END AS event
  FROM events, ends
)
SELECT batch_id, COUNT(*) AS rows, COUNT(*) - COUNT(event) AS unparsed,
       MIN(event) AS first_event, MAX(event) AS last_event
FROM parts GROUP BY batch_id""",
    "fanout_lake_and_cache": LONG + """
SELECT * EXCLUDE (mean) FROM stats JOIN (
  SELECT walkId, sensorType, COUNT(*) AS lake_rows, MAX("offset") AS last_offset
  FROM measured GROUP BY walkId, sensorType
) USING (walkId, sensorType)""",
    "fanout_wider_windows": UNEVEN + "SELECT * EXCLUDE (mean) FROM stats",
    "closed_windows": SENT + f"""
SELECT *, CAST(window_start AS DATE) AS window_date FROM ({CACHE_ROWS})
WHERE window_end <= (SELECT last FROM marks)""",
    "open_windows": SENT + """
SELECT * EXCLUDE (mean) FROM stats WHERE windowEnd > (SELECT last FROM marks)""",
    "stream_result_cache": LONG + CACHE_ROWS,
    "compacted_cache": LONG + CACHE_ROWS,
    "compacted_live_cache": LONG + CACHE_ROWS,
    "late_rows_cache": LATE + CACHE_ROWS,
    "cache_read": LONG + f"""
SELECT * EXCLUDE (device_id) FROM (
  {CACHE_ROWS} WHERE {WALK} AND year(windowStart) = {YEAR}
) ORDER BY window_start""",
    "day_series_thinned": TYPES_AS_WALKS + f""",
days AS (
  SELECT *, epoch_us(windowStart) AS micros FROM stats
  WHERE walkId = '{TYPE_WALK}' AND sensorType = '{LOG_SENSOR}'
    AND CAST(windowStart AS DATE) = DATE '{WALK_DAY}' AND avgPressureHpa IS NOT NULL
),
cuts AS (SELECT MIN(micros) AS low, (MAX(micros) - MIN(micros)) // {POINTS} + 1 AS width FROM days)
SELECT MIN(windowStart) AS window_start,
       {six('SUM(mean * measurementCount) / SUM(measurementCount)')} AS avg_pressure_hpa,
       MIN(minPressureHpa) AS min_pressure_hpa, MAX(maxPressureHpa) AS max_pressure_hpa,
       CAST(SUM(measurementCount) AS BIGINT) AS measurement_count
FROM days, cuts GROUP BY (micros - low) // width ORDER BY 1""",
    "cache_day_series": TYPES_AS_WALKS + f"""
SELECT window_start, avg_pressure_hpa, min_pressure_hpa, max_pressure_hpa, measurement_count
FROM (
  {CACHE_ROWS}
  WHERE walkId = '{TYPE_WALK}' AND sensorType = '{LOG_SENSOR}' AND year(windowStart) = {YEAR}
    AND CAST(windowStart AS DATE) = DATE '{WALK_DAY}' AND avgPressureHpa IS NOT NULL
) ORDER BY window_start""",
}
