"""Queries over the test tables.

``events`` stands for the sensor stream: user as walk, event type as sensor
type, value as pressure, event id as offset. Every query runs over the whole
table. Results have zone-less timestamps and rounded doubles, so that they can
be compared with another engine's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.functions.payloads import decode_json
from barograph.functions.times import epoch_seconds, epoch_text, event_time, parse_day
from barograph.operators.bronze import bad_rows
from barograph.operators.cache import cache_rows
from barograph.operators.envelopes import FOR_STATS, as_bus_rows, parse_messages, to_envelopes
from barograph.operators.filters import complete_rows, in_year, on_day, on_sensor, on_walk
from barograph.operators.offsets import with_offsets
from barograph.operators.panes import pane_rows, pane_stats, pane_windows
from barograph.operators.reports import (
    band_series,
    by_start,
    day_series,
    newest,
    rows_per_day,
    thinned,
    time_range,
)
from barograph.operators.textstats import (
    column_totals,
    line_pairs,
    lines_of,
    sum_by_key,
    text_totals,
)
from barograph.operators.windows import window_stats
from barograph.schema import BRONZE, GROUP_KEYS, layout
from barograph.session import pin_utc, task_count
from barograph.settings import CacheFilter, Trigger, WindowSpec
from barograph.sources.files import bronze_table, sensor_log, sensor_logs, text_lines
from barograph.sources.messages import replay_batch, replay_stream
from barograph.sources.tables import live_table
from barograph.streaming.bronze import start_bronze, write_messages
from barograph.streaming.closed import closed_windows as closed_table
from barograph.streaming.closed import open_windows as open_table
from barograph.streaming.closed import start_closed_windows
from barograph.streaming.fanout import LakeAndWindows
from barograph.streaming.health import health_log, health_table, observed
from barograph.streaming.live import start_live_table
from barograph.streaming.monitor import stop_all
from barograph.streaming.resultcache import ResultCache
from barograph.workspace import fresh_folder

# Fixed values, repeated in the oracle SQL.
USER, DEVICE, TOPIC = "user-1", "device-1", "sensor.events"
BASE_EPOCH = 1704067200.0  # 2024-01-01T00:00:00Z
LOG_WALK, LOG_SENSOR = "walk-log", "barometer"
ONE_WALK, ONE_SENSOR, YEAR, DAY = "8", "error", 2024, "2024-01-15"
TYPE_WALK, WALK_DAY = "click", "2024-01-10"
POINTS = 12  # of the thinned chart
BUS_PARTITIONS = 8

SHORT = WindowSpec("10 seconds", "5 seconds")
LONG = WindowSpec("2 days", "1 day")
HOURLY = WindowSpec("1 hour", None)
HALF_HOURLY = WindowSpec("1 hour", "30 minutes")
WIDE = WindowSpec("20 days", "10 days")
MINUTELY = WindowSpec("1 hour", "1 minute")
UNEVEN = WindowSpec("3 days", "2 days")

NOW = Trigger()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pin_utc(spark)
        return comparable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def comparable(rows: DataFrame) -> DataFrame:
    changed = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            changed[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DoubleType):
            # As a decimal number: of a mean that ends in an exact 5 after the sixth decimal,
            # the last bit of a double would decide.
            exact = F.col(field.name).try_cast("decimal(38, 9)")
            changed[field.name] = F.round(exact, 6).cast("double")
    return rows.withColumns(changed) if changed else rows


# --- the events table as measurements and as messages -----------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def measured(source: DataFrame) -> DataFrame:
    """Events as typed measurements, without the way through JSON."""
    return source.select(
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("walkId"),
        F.lit(DEVICE).alias("deviceId"),
        F.col("event_type").alias("sensorType"),
        event_time(epoch_seconds(F.col("ts"))).alias("eventTime"),
        F.col("value").alias("pressureHpa"),
    )


def as_log(source: DataFrame) -> DataFrame:
    elapsed = epoch_seconds(F.col("ts")) - F.lit(BASE_EPOCH)
    return source.withColumns({"timeSeconds": elapsed, "pressureHpa": F.col("value")})


def messages(
    source: DataFrame, broken: str | None = None, type_as_walk: bool = False
) -> DataFrame:
    """Events as bus rows, numbered by their id in one partition."""
    keyed = keyed_events(source, broken, type_as_walk)
    return as_bus_rows(keyed, TOPIC, F.col("event_id"), F.col("ts").cast("timestamp"))


def keyed_events(
    source: DataFrame, broken: str | None = None, type_as_walk: bool = False
) -> DataFrame:
    """Events as keyed messages, with their id, time and type.

    JSON of the event type ``broken`` is cut short. ``type_as_walk`` makes few
    long walks with one sensor, instead of one short walk per user.
    """
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    keyed = to_envelopes(
        as_log(source),
        user=USER,
        device=DEVICE,
        walk=kind if type_as_walk else user,
        sensor=LOG_SENSOR if type_as_walk else kind,
        base_epoch=BASE_EPOCH,
        keep=("event_id", "ts", "event_type"),
    )
    if broken:
        cut = F.expr("substring(value, 1, length(value) - 1)")
        keyed = keyed.withColumn(
            "value", F.when(kind == broken, cut).otherwise(F.col("value"))
        )
    return keyed


# --- batch: windows ----------------------------------------------------------------


@query
def sliding_stats_10s_5s(spark, sf_dir):
    return window_stats(measured(events(spark, sf_dir)), SHORT)


@query
def sliding_stats_2d_1d(spark, sf_dir):
    return window_stats(measured(events(spark, sf_dir)), LONG)


@query
def tumbling_stats_1h(spark, sf_dir):
    """Per sensor type only, so that windows hold several rows."""
    return window_stats(measured(events(spark, sf_dir)), HOURLY, keys=("sensorType",))


@query
def pane_stats_1h_1m(spark, sf_dir):
    """Each row lies in sixty windows and is aggregated once."""
    return pane_stats(measured(events(spark, sf_dir)), MINUTELY, keys=("sensorType",))


@query
def pane_stats_3d_2d(spark, sf_dir):
    """A slide that does not divide the size: windows are three panes, their starts two apart."""
    return pane_stats(measured(events(spark, sf_dir)), UNEVEN)


@query
def message_window_stats(spark, sf_dir):
    """The flagship: events to JSON messages, parsed again, window statistics."""
    parsed = parse_messages(messages(events(spark, sf_dir)), wanted=FOR_STATS)
    return window_stats(parsed, LONG)


@query
def cache_layout(spark, sf_dir):
    stats = window_stats(measured(events(spark, sf_dir)), LONG)
    return cache_rows(stats).drop("updated_at")


# --- batch: parsing ----------------------------------------------------------------


@query
def parse_json_payload(spark, sf_dir):
    payload = decode_json(F.col("props"), layout({"k": "bigint"}))
    rows = events(spark, sf_dir).select("event_id", payload.alias("payload"))
    return rows.select("event_id", F.col("payload.k").alias("k"))


@query
def event_time_seconds(spark, sf_dir):
    epoch = epoch_seconds(F.col("ts"))
    return events(spark, sf_dir).select(
        "event_id", epoch_text(epoch).alias("time_text"), event_time(epoch).alias("event_time")
    )


@query
def event_time_micros(spark, sf_dir):
    moment = event_time(epoch_seconds(F.col("ts")), "micros")
    return events(spark, sf_dir).select("event_id", moment.alias("event_time"))


@query
def envelope_roundtrip(spark, sf_dir):
    parsed = parse_messages(messages(events(spark, sf_dir)))
    return parsed.drop("jsonValue")


@query
def bus_offsets(spark, sf_dir):
    """Events dealt over bus partitions by walk, numbered by send time in each."""
    rows = with_offsets(
        keyed_events(events(spark, sf_dir)), TOPIC, BUS_PARTITIONS, ("ts", "event_id"),
        F.col("ts").cast("timestamp"),
    )
    parsed = parse_messages(rows, wanted=("walkId", "sensorType", "pressureHpa"))
    return parsed.drop("jsonValue", "topic")


@query
def csv_log_roundtrip(spark, sf_dir):
    """Events to a CSV sensor log; the log to replay messages; those parsed."""
    folder = fresh_folder(spark, "csv-log")
    log = as_log(events(spark, sf_dir))
    named = log.select(
        F.col("timeSeconds").alias("Time (s)"), F.col("pressureHpa").alias("X (hPa)")
    )
    named.write.option("header", True).csv(f"{folder}/log")
    keyed = to_envelopes(
        sensor_log(spark, f"{folder}/log"), USER, DEVICE, LOG_WALK, LOG_SENSOR, BASE_EPOCH
    )
    write_messages(as_bus_rows(keyed, TOPIC), f"{folder}/bus")
    parsed = parse_messages(replay_batch(spark, f"{folder}/bus"))
    return parsed.select(
        "messageKey", "userId", "deviceId", "walkId", "sensorType",
        "eventTime", "timeSeconds", "pressureHpa",
    )


@query
def csv_many_logs(spark, sf_dir):
    """A log per walk, each from its own time on; all in one scan to messages; those parsed."""
    folder = fresh_folder(spark, "csv-logs")
    epoch = epoch_seconds(F.col("ts"))
    timed = events(spark, sf_dir).select(F.col("user_id").cast("string").alias("walkId"),
                                         epoch.alias("epoch"), "value")
    timed.groupBy("walkId").agg(F.floor(F.min("epoch")).cast("double").alias("baseEpoch")).write.parquet(
        f"{folder}/bases"
    )
    bases = spark.read.parquet(f"{folder}/bases")
    logs = timed.join(bases, "walkId").select(
        F.col("walkId").alias("walk"),
        (F.col("epoch") - F.col("baseEpoch")).alias("Time (s)"),
        F.col("value").alias("X (hPa)"),
    )
    # Brought together by walk: few files each, a walk's rows on one task here only. Opening
    # files is the work, not their few bytes, so tasks are not put together by size.
    dealt = logs.repartition(task_count(spark), "walk")
    dealt.write.option("header", True).partitionBy("walk").csv(f"{folder}/logs")
    found = sensor_logs(spark, f"{folder}/logs", bases, walk=r"/walk=([^/]+)/")
    keyed = to_envelopes(
        found, USER, DEVICE, F.col("walkId"), LOG_SENSOR, F.col("baseEpoch")
    )
    parsed = parse_messages(as_bus_rows(keyed, TOPIC))
    return parsed.select("messageKey", "walkId", "sensorType", "eventTime", "timeSeconds", "pressureHpa")


# --- batch: filters and reports ----------------------------------------------------


@query
def walk_sensor_year(spark, sf_dir):
    """Filtered by the table's own columns, so that all three reach the scan."""
    rows = on_walk(events(spark, sf_dir), int(ONE_WALK), "user_id")
    rows = in_year(on_sensor(rows, ONE_SENSOR, "event_type"), YEAR, "ts")
    return by_start(measured(rows), "eventTime")


@query
def year_day_filter(spark, sf_dir):
    rows = on_day(in_year(events(spark, sf_dir), YEAR, "ts"), DAY, "ts")
    return rows.select("event_id", "ts", "user_id", "event_type", "value").orderBy("ts")


@query
def windows_with_spread(spark, sf_dir):
    """Windows of more than one value: those whose deviation is not NULL."""
    stats = window_stats(measured(events(spark, sf_dir)), LONG)
    return complete_rows(stats, "windowStart", "stddevPressureHpa")


@query
def range_diagnostic(spark, sf_dir):
    stats = cache_rows(window_stats(measured(events(spark, sf_dir)), HALF_HOURLY))
    return time_range(stats)


@query
def daily_counts(spark, sf_dir):
    return rows_per_day(events(spark, sf_dir), "ts")


@query
def newest_20(spark, sf_dir):
    rows = measured(events(spark, sf_dir))
    return newest(rows, 20, "eventTime", ties=("offset",))


@query
def newest_20_windows(spark, sf_dir):
    stats = window_stats(measured(events(spark, sf_dir)), HALF_HOURLY)
    return newest(stats, 20, "windowStart", ties=("walkId", "sensorType"))


@query
def last_100_band(spark, sf_dir):
    stats = window_stats(measured(events(spark, sf_dir)), HALF_HOURLY, keys=())
    return band_series(stats, 100)


@query
def day_band(spark, sf_dir):
    """All windows that start on one day, of all walks together.

    They hold rows of this day and of the window's length after it.
    """
    start = F.lit(parse_day(DAY)).cast("timestamp_ntz")
    after = start + F.expr(f"INTERVAL 1 DAY + INTERVAL {HALF_HOURLY.size}")
    near = events(spark, sf_dir).filter((F.col("ts") >= start) & (F.col("ts") < after))
    stats = window_stats(measured(near), HALF_HOURLY, keys=())
    rows = stats.withColumnsRenamed({
        "windowStart": "window_start",
        "avgPressureHpa": "avg_pressure_hpa",
        "minPressureHpa": "min_pressure_hpa",
        "maxPressureHpa": "max_pressure_hpa",
        "measurementCount": "measurement_count",
    })
    return day_series(rows, DAY)


# --- batch: text -------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def line_stats(spark, sf_dir):
    return column_totals(documents(spark, sf_dir), "text")


@query
def line_pair_sums(spark, sf_dir):
    """The map and reduce form of ``line_stats``."""
    return sum_by_key(line_pairs(lines_of(documents(spark, sf_dir), "text")))


@query
def text_file_stats(spark, sf_dir):
    """Document texts written as text files and scanned line by line."""
    folder = fresh_folder(spark, "text")
    documents(spark, sf_dir).select("text").write.text(folder)
    return text_totals(text_lines(spark, folder))


# --- streams -----------------------------------------------------------------------


def bus_parts(
    spark: SparkSession,
    sf_dir: str,
    bus: str,
    parts: int = 3,
    newest_first: bool = False,
    broken: str | None = None,
    type_as_walk: bool = False,
    sent: tuple[int, ...] | None = None,
) -> Iterator[int]:
    """Send the events to a replay bus in equal parts of their time range, one per step.

    Parts go oldest first, unless ``newest_first`` or ``sent``, their numbers in order, says
    otherwise. Events without a time go with the oldest part, so that the parts are the whole table.
    """
    cuts = time_cuts(spark, sf_dir, parts)
    spans = list(zip(cuts, cuts[1:]))
    ordered = [spans[n] for n in sent or (reversed(range(parts)) if newest_first else range(parts))]
    for number, span in enumerate(ordered):
        start, end = (F.timestamp_micros(F.lit(cut)).cast("timestamp_ntz") for cut in span)
        own = (F.col("ts") >= start) & (F.col("ts") < end)
        if span is spans[0]:
            own |= F.col("ts").isNull()
        part = events(spark, sf_dir).filter(own)
        write_messages(messages(part, broken, type_as_walk), bus)
        yield number


def bus_measurements(spark: SparkSession, bus: str) -> DataFrame:
    return parse_messages(replay_stream(spark, bus), wanted=FOR_STATS)


def filled_live_table(spark: SparkSession, sf_dir: str) -> str:
    """In three parts, the query started anew for each."""
    folder = fresh_folder(spark, "live")
    name = f"live_{uuid.uuid4().hex}"
    for _ in bus_parts(spark, sf_dir, f"{folder}/bus"):
        stats = window_stats(bus_measurements(spark, f"{folder}/bus"), LONG)
        start_live_table(stats, name, f"{folder}/live", NOW).awaitTermination()
    return name


@query
def stream_live_table(spark, sf_dir):
    return live_table(spark, filled_live_table(spark, sf_dir))


@query
def live_pane_windows(spark, sf_dir):
    """The live table holds panes, as the stream's state does; windows are made when it is read."""
    folder = fresh_folder(spark, "live")
    name = f"live_{uuid.uuid4().hex}"
    for _ in bus_parts(spark, sf_dir, f"{folder}/bus"):
        panes = pane_rows(bus_measurements(spark, f"{folder}/bus"), UNEVEN)
        start_live_table(panes, name, f"{folder}/live", NOW).awaitTermination()
    return pane_windows(live_table(spark, name), UNEVEN)


@query
def live_table_sql(spark, sf_dir):
    """The newest windows, asked of the live table by its name in SQL."""
    return spark.sql(f"""
        SELECT windowStart, windowEnd, walkId, sensorType, measurementCount, avgPressureHpa
        FROM {filled_live_table(spark, sf_dir)}
        ORDER BY windowStart DESC, walkId, sensorType LIMIT 20
    """)


def filled_lake(spark: SparkSession, sf_dir: str, broken: str | None = None) -> DataFrame:
    """In three parts, the query started anew for each."""
    folder = fresh_folder(spark, "bronze")
    for _ in bus_parts(spark, sf_dir, f"{folder}/bus", broken=broken):
        parsed = parse_messages(replay_stream(spark, f"{folder}/bus"))
        start_bronze(parsed, f"{folder}/lake", f"{folder}/checkpoint", NOW).awaitTermination()
    return bronze_table(spark, f"{folder}/lake")


@query
def stream_bronze(spark, sf_dir):
    kept = [name for name in BRONZE.fieldNames() if name not in ("ingestTime", "jsonValue")]
    return filled_lake(spark, sf_dir).select(*kept)


@query
def bronze_day(spark, sf_dir):
    """One date and sensor type of the lake: reads one folder."""
    lake = filled_lake(spark, sf_dir)
    rows = on_sensor(lake.filter(F.col("eventDate") == F.lit(DAY).cast("date")), ONE_SENSOR,
                     "sensorType")
    return rows.select("offset", "walkId", "eventTime", "pressureHpa", "eventDate")


@query
def bronze_bad_rows(spark, sf_dir):
    """Messages of one type are cut short; the lake keeps them apart."""
    bad = bad_rows(filled_lake(spark, sf_dir, ONE_SENSOR))
    # Whole messages of events without a time are in that partition too.
    return bad.filter(F.col("sensorType").isNull()).select("offset", "messageKey")


@query
def stream_health(spark, sf_dir):
    """Per batch of the lake's stream what it took in; messages of one type are cut short."""
    folder = fresh_folder(spark, "health")
    with health_log(spark, f"{folder}/health") as log:
        for _ in bus_parts(spark, sf_dir, f"{folder}/bus", broken=ONE_SENSOR):
            parsed = observed(parse_messages(replay_stream(spark, f"{folder}/bus")))
            query = start_bronze(parsed, f"{folder}/lake", f"{folder}/checkpoint", NOW)
            query.awaitTermination()
            log.wait([query])
    return health_table(spark, f"{folder}/health").select(
        "batch_id", "rows", "unparsed", "first_event", "last_event"
    )


def filled_stores(spark: SparkSession, sf_dir: str, spec: WindowSpec) -> LakeAndWindows:
    """In three parts, the query started anew for each."""
    folder = fresh_folder(spark, "fanout")
    stores = LakeAndWindows(spark, f"{folder}/stores", spec)
    for _ in bus_parts(spark, sf_dir, f"{folder}/bus"):
        stores.start(replay_stream(spark, f"{folder}/bus"), NOW).awaitTermination()
    return stores


@query
def fanout_lake_and_cache(spark, sf_dir):
    """Window statistics and, of the same batches, the lake's rows per walk and sensor type."""
    stores = filled_stores(spark, sf_dir, LONG)
    rows = stores.lake().groupBy("walkId", "sensorType").agg(
        F.count("*").alias("lake_rows"), F.max("`offset`").alias("last_offset")
    )
    return stores.stats().join(rows, ["walkId", "sensorType"])


@query
def fanout_wider_windows(spark, sf_dir):
    """Filled for windows of a day and a half by half days, read by wider ones of whole panes."""
    return filled_stores(spark, sf_dir, WindowSpec("36 hours", "12 hours")).stats(UNEVEN)


def closed_and_open(spark: SparkSession, sf_dir: str) -> str:
    """The middle part first, then the oldest, which is late, then the newest."""
    folder = fresh_folder(spark, "closed")
    for _ in bus_parts(spark, sf_dir, f"{folder}/bus", sent=(1, 0, 2)):
        stats = window_stats(bus_measurements(spark, f"{folder}/bus"), WIDE)
        start_closed_windows(
            stats, f"{folder}/table", f"{folder}/checkpoint", NOW
        ).awaitTermination()
    return folder


@query
def closed_windows(spark, sf_dir):
    """Windows the watermark has closed, each written once."""
    folder = closed_and_open(spark, sf_dir)
    return closed_table(spark, f"{folder}/table").drop("updated_at")


@query
def open_windows(spark, sf_dir):
    """Windows still in the same stream's state, with their statistics so far."""
    folder = closed_and_open(spark, sf_dir)
    return open_table(spark, f"{folder}/checkpoint", GROUP_KEYS)


def time_cuts(spark: SparkSession, sf_dir: str, parts: int) -> list[int]:
    """Equal parts of the table's time range, in epoch microseconds."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events(spark, sf_dir).agg(F.min(micros), F.max(micros)).first()
    if low is None:
        low = high = 0
    return [low + (high - low) * part // parts for part in range(parts)] + [high + 1]


def fill_cache(
    spark: SparkSession,
    sf_dir: str,
    spec: WindowSpec,
    parts: int = 3,
    newest_first: bool = False,
    compact_after: int | None = None,
    type_as_walk: bool = False,
) -> ResultCache:
    """Send the events to a replay bus part by part; after each, the cache's stream
    goes on from its checkpoint and takes in what is new."""
    folder = fresh_folder(spark, "cache")
    cache = ResultCache(spark, f"{folder}/cache")
    sent = bus_parts(
        spark, sf_dir, f"{folder}/bus", parts, newest_first, type_as_walk=type_as_walk
    )
    for number in sent:
        stats = window_stats(bus_measurements(spark, f"{folder}/bus"), spec)
        cache.start(stats, NOW).awaitTermination()
        if number == compact_after:
            cache.compact()
    return cache


@query
def stream_result_cache(spark, sf_dir):
    return fill_cache(spark, sf_dir, LONG).rows().drop("updated_at")


@query
def compacted_cache(spark, sf_dir):
    """Compacted after the second of three parts: base and changelog together."""
    return fill_cache(spark, sf_dir, LONG, compact_after=1).rows().drop("updated_at")


@query
def compacted_live_cache(spark, sf_dir):
    """Compacted, and covered batches dropped, between triggers of one running stream."""
    folder = fresh_folder(spark, "cache")
    cache = ResultCache(spark, f"{folder}/cache")
    query = None
    try:
        for _ in bus_parts(spark, sf_dir, f"{folder}/bus"):
            if query is None:
                stats = window_stats(bus_measurements(spark, f"{folder}/bus"), LONG)
                query = cache.start(stats, Trigger(every=1))
            query.processAllAvailable()
            cache.compact()
            cache.drop_compacted()
    finally:
        stop_all([query] if query else [])
    return cache.rows().drop("updated_at")


@query
def late_rows_cache(spark, sf_dir):
    """The newer half first: older rows count only in windows still open."""
    cache = fill_cache(spark, sf_dir, WIDE, parts=2, newest_first=True)
    return cache.rows().drop("updated_at")


@query
def cache_read(spark, sf_dir):
    wanted = CacheFilter(ONE_WALK, ONE_SENSOR, YEAR)
    return fill_cache(spark, sf_dir, LONG).read(wanted)


@query
def cache_day_series(spark, sf_dir):
    wanted = CacheFilter(TYPE_WALK, LOG_SENSOR, YEAR)
    cache = fill_cache(spark, sf_dir, HALF_HOURLY, type_as_walk=True)
    return day_series(cache.read(wanted, WALK_DAY), WALK_DAY)


@query
def day_series_thinned(spark, sf_dir):
    """The day's series on a chart of a dozen points."""
    wanted = CacheFilter(TYPE_WALK, LOG_SENSOR, YEAR)
    cache = fill_cache(spark, sf_dir, HALF_HOURLY, type_as_walk=True)
    return thinned(day_series(cache.read(wanted, WALK_DAY), WALK_DAY), POINTS)
