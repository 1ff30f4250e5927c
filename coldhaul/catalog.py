"""The registered queries: each operator applied to the fleet tables of one directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.functions import columns as c
from coldhaul.functions import rules
from coldhaul.operators import audits, joins, quality, rollup
from coldhaul.operators.asof import any_long, match_trips, trip_windows
from coldhaul.operators.ordered import (
    dedupe_by_key, dedupe_full_row, drop_null_keys, resequence, top_rows)
from coldhaul.plans import bi, control, daily, gold, silver
from coldhaul.plans.star import StarStore
from coldhaul.session import cut, scratch_path, together
from coldhaul.sinks import tables
from coldhaul.sources import files
from coldhaul.sources.binding import DEPOTS, FleetData, RawFleetData
from coldhaul.streaming import jobs, live, messages
from coldhaul.streaming.windows import WindowStore

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[[FleetData], DataFrame]] = {}

TARGET_DAY = date(2024, 1, 15)
BATTERY_TICKS = 1        # the benchmark tables hold a few battery ticks per trip
STATUS_WINDOW = "12 hours"  # and a few pings per vehicle and day
STREAM_SLICES = 3


def query(fn: Callable[[FleetData], DataFrame]) -> Callable[[FleetData], DataFrame]:
    """Register a query under its function name, less a trailing underscore."""
    _QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])


def queries() -> dict[str, Query]:
    def bind(fn):
        return lambda spark, sf_dir: plain(fn(FleetData(spark, sf_dir)))
    return {name: bind(fn) for name, fn in _QUERIES.items()}


# ---- shared pieces ----

def raw(fleet: FleetData) -> RawFleetData:
    return RawFleetData(fleet)


def bounds(fleet: FleetData) -> DataFrame:
    return rollup.trip_thermal_bounds(fleet.trip_cargo(), fleet.cargo())


def matched_quick(fleet: FleetData) -> DataFrame:
    return match_trips(fleet.quick(), trip_windows(fleet.trips()), "ts", long=any_long(fleet.trips()))


def matched_slow(fleet: FleetData) -> DataFrame:
    windows = rollup.bounded_windows(trip_windows(fleet.trips()), bounds(fleet))
    return match_trips(fleet.slow(), windows, "ts", long=any_long(fleet.trips()))


def telemetry(fleet: FleetData) -> DataFrame:
    return rollup.trip_telemetry_agg(fleet.trips(), bounds(fleet), fleet.quick(), fleet.slow())


def cargo_agg(fleet: FleetData) -> DataFrame:
    return rollup.trip_cargo_agg(fleet.trip_cargo(), fleet.cargo())


def joined_trips(fleet: FleetData) -> DataFrame:
    return gold.join_trip_inputs(fleet.trips(), cargo_agg(fleet), telemetry(fleet))


def fact(fleet: FleetData) -> DataFrame:
    return gold.fct_trip_operations(joined_trips(fleet))


def routes(fleet: FleetData) -> DataFrame:
    return silver.flatten_routes(fleet.route_pairs(), fleet.depots())


def vehicle_dim(fleet: FleetData) -> DataFrame:
    return gold.dim_vehicles(fleet.vehicles())


def driver_dim(fleet: FleetData) -> DataFrame:
    return gold.dim_drivers(fleet.drivers())


def route_dim(fleet: FleetData) -> DataFrame:
    return gold.dim_routes(routes(fleet))


def live_windows(fleet: FleetData) -> DataFrame:
    return live.live_windows(fleet.trips(), fleet.trip_cargo(), fleet.cargo())


def _published(fleet: FleetData) -> WindowStore:
    store = WindowStore(fleet.spark, scratch_path(fleet.spark, "live-windows"))
    store.publish(live_windows(fleet))
    return store


def quick_pings(fleet: FleetData) -> DataFrame:
    return messages.quick_from_messages(raw(fleet).quick_messages())


def slow_pings(fleet: FleetData) -> DataFrame:
    return messages.slow_from_messages(raw(fleet).slow_messages())


def batch_quick_incidents(fleet: FleetData) -> DataFrame:
    return live.quick_incidents(quick_pings(fleet), live_windows(fleet))


def batch_slow_incidents(fleet: FleetData) -> DataFrame:
    return live.slow_incidents(live.fuel_drop_batch(slow_pings(fleet)), live_windows(fleet))


def batch_feed(fleet: FleetData) -> DataFrame:
    """The feed over history: an incident is detected at its event time."""
    feed = live.incident_feed(batch_quick_incidents(fleet), batch_slow_incidents(fleet))
    return feed.withColumn("detected_at", F.col("event_time"))


def newest(feed: DataFrame):
    return feed.agg(F.max("detected_at")).scalar()


def batch_status(fleet: FleetData) -> DataFrame:
    feed = batch_feed(fleet)
    return live.vehicle_status(live.latest_position(quick_pings(fleet)), feed, newest(feed),
                               STATUS_WINDOW)


# ---- scans and sources ----

def _csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.csv(path, header=True)
    return path


@query
def scan_csv_strings(fleet):
    path = _csv(raw(fleet).trips(), "trips-csv")
    return files.scan_csv_strings(fleet.spark, path, schemas.RAW["trips"])


@query
def land_static_tables(fleet):
    source, folder = raw(fleet), scratch_path(fleet.spark, "csv-tables")
    together(*[partial(source.table(name).write.csv, f"{folder}/{name}.csv", header=True)
               for name in schemas.RAW])
    landed = files.scan_raw_tables(fleet.spark, folder)
    together(*[partial(tables.write_overwrite, df, f"{folder}/bronze_{name}") for name, df in landed.items()])
    counts = []
    for name in landed:
        key = schemas.RAW_COLUMNS[name][0]
        counts.append(files.scan_parquet(fleet.spark, f"{folder}/bronze_{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(key).alias("distinct_keys")))
    return reduce(DataFrame.unionByName, counts)


@query
def scan_parquet(fleet):
    return fleet.read("orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def scan_parquet_dir(fleet):
    path = scratch_path(fleet.spark, "parts")
    fleet.trips().repartition(4, "trip_id").write.parquet(path)
    return files.scan_parquet(fleet.spark, path)


def _land_batch(fleet: FleetData, kind: str) -> str:
    """One topic's envelopes on disk, a partition per day."""
    path = scratch_path(fleet.spark, f"landing-{kind}")
    rows = getattr(raw(fleet), f"{kind}_messages")()
    messages.envelope(rows).write.partitionBy("ingest_date").parquet(path)
    return path


def _opened(envelopes: DataFrame, *more) -> DataFrame:
    """Envelope columns with the sensor inside the payload; landing time is left out."""
    return envelopes.select("kafka_key", F.get_json_object("raw_json", "$.sensor_id").alias("sensor_id"),
                            "topic", "kafka_ts", *more)


@query
def scan_daily_slice(fleet):
    path = _land_batch(fleet, "quick")
    rows = files.scan_daily_slice(fleet.spark, path, schemas.ENVELOPE, "ingest_date", TARGET_DAY)
    return _opened(rows, "ingest_date")


@query
def scan_sharded_by_vehicle(fleet):
    """One file per vehicle, named by it: the number is in no row of the file."""
    path = scratch_path(fleet.spark, "shards")
    tables.write_file_per_key(fleet.slow().withColumn("shard", F.col("vehicle_id")).drop("vehicle_id"), path, "shard")
    rows = files.scan_sharded_by_vehicle(fleet.spark, path, schemas.strings(
        "sensor_id", "ts", "fuel_amount_l", "is_door_open", "cargo_temp_c", "shard"))
    return rows.select("vehicle_id", "sensor_id",
                       F.col("fuel_amount_l").try_cast("double").alias("fuel_amount_l"))


def _time_slices(fleet: FleetData, kind: str) -> list[DataFrame]:
    """One topic's messages cut into consecutive spans of time, oldest first."""
    rows = getattr(raw(fleet), f"{kind}_messages")()
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (last - first) / STREAM_SLICES
    marks = [first + step * i for i in range(STREAM_SLICES)] + [last + timedelta(seconds=1)]
    t = F.col("timestamp")
    marks = [F.lit(str(m)).cast("timestamp_ntz") for m in marks]
    slices = [rows.where((t >= a) & (t < b)) for a, b in zip(marks, marks[1:])]
    return [rows.where(t.isNull()).unionByName(slices[0]), *slices[1:]]


def _replay(fleet: FleetData, kinds: list[str], start: Callable[[dict[str, DataFrame]], list]) -> None:
    """Let messages arrive slice by slice; each slice is drained by restarted streams.

    ``start`` gets one message stream per topic and returns the running queries.
    """
    inbox = {k: scratch_path(fleet.spark, f"inbox-{k}") for k in kinds}
    for parts in zip(*[_time_slices(fleet, k) for k in kinds]):
        for kind, part in zip(kinds, parts):
            part.write.mode("append").parquet(inbox[kind])
        running = start({k: messages.message_stream(fleet.spark, "parquet", path=inbox[k])
                         for k in kinds})
        for q in running:
            q.awaitTermination()


@query
def stream_source(fleet):
    out = scratch_path(fleet.spark, "stream-source")
    _replay(fleet, ["quick"], lambda s: [jobs.append_stream(messages.once(s["quick"]), f"{out}/rows", f"{out}/cp")])
    rows = fleet.spark.read.schema(schemas.MESSAGE).parquet(f"{out}/rows")
    return rows.select("key", F.get_json_object("value", "$.sensor_id").alias("sensor_id"),
                       "topic", "timestamp")


@query
def envelope_project(fleet):
    rows = raw(fleet).quick_messages().unionByName(raw(fleet).slow_messages())
    return _opened(messages.envelope(rows), "ingest_date")


@query
def named_sources(fleet):
    files.register_sources(fleet.spark, {"trips": fleet.trips(), "vehicles": fleet.vehicles()})
    return fleet.spark.sql("""
        SELECT v.model, count(*) AS trips FROM stg_trips t
        JOIN stg_vehicles v ON v.vehicle_id = t.vehicle_id GROUP BY v.model""")


@query
def dim_date(fleet):
    """The calendar over the days the trips cover."""
    span = fleet.trips().agg(F.to_date(F.min("scheduled_start_time")).alias("first_day"),
                             F.to_date(F.max("actual_end_time")).alias("last_day"))
    return gold.calendar(span)


@query
def json_payload(fleet):
    rows = messages.json_payload(
        fleet.quick().withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        schemas.QUICK_COLUMNS)
    fields = [F.get_json_object("value", f"$.{n}").alias(n) for n in ("vehicle_id", "sensor_id", "timestamp")]
    return rows.select("key", *[f.alias(f"json_{n}") for f, n in zip(
        fields, ("vehicle_id", "sensor_id", "timestamp"))],
        F.get_json_object("value", "$.rpm").try_cast("double").alias("json_rpm"))


# ---- sinks and write modes ----

@query
def write_overwrite(fleet):
    path = scratch_path(fleet.spark, "overwrite")
    tables.write_overwrite(fleet.vehicles(), path)
    rows = tables.write_overwrite(fleet.vehicles(), path, audit_path=f"{path}-audit")
    return files.scan_parquet(fleet.spark, path).select(
        "vehicle_id", "model", F.lit(rows).cast("bigint").alias("rows_reported"))


@query
def stream_land_bronze(fleet):
    out = scratch_path(fleet.spark, "bronze")
    _replay(fleet, ["quick"], lambda s: [
        jobs.land_topic(s["quick"], f"{out}/quick", f"{out}/cp", jobs.DRAIN)])
    return _opened(fleet.spark.read.parquet(f"{out}/quick"), "ingest_date")


@query
def write_staging(fleet):
    path = scratch_path(fleet.spark, "stg_drivers")
    tables.write_staging(fleet.drivers(), path)
    return files.scan_parquet(fleet.spark, path)


@query
def copy_partition_forward(fleet):
    src, dst = _land_batch(fleet, "slow"), scratch_path(fleet.spark, "bronze-daily")
    rows = tables.copy_partition_forward(fleet.spark, src, dst, schemas.ENVELOPE, "ingest_date",
                                         TARGET_DAY)
    copied = fleet.spark.read.parquet(dst)
    return _opened(copied, "dt", F.lit(rows).cast("bigint").alias("rows_copied"))


def _corrected(trips: DataFrame) -> DataFrame:
    """The target day's trips, ending one hour later."""
    return trips.where(tables.on_day("actual_start_time", TARGET_DAY)).withColumn(
        "actual_end_time", F.col("actual_end_time") + F.expr("INTERVAL 1 HOUR"))


@query
def replace_by_date(fleet):
    path = scratch_path(fleet.spark, "trips-by-date")
    trips = fleet.trips()
    trips.withColumn("dt", F.to_date("actual_start_time")).write.partitionBy("dt").parquet(path)
    for _ in range(2):
        tables.replace_partition(_corrected(trips), path, "dt", TARGET_DAY)
    return fleet.spark.read.parquet(path)


@query
def replace_by_key(fleet):
    return tables.replace_by_key(fleet.trips(), _corrected(fleet.trips()), "trip_id")


@query
def replace_by_start_date(fleet):
    return tables.replace_by_start_date(fleet.trips(), _corrected(fleet.trips()),
                                        "actual_start_time", TARGET_DAY)


@query
def telemetry_table_write(fleet):
    path = scratch_path(fleet.spark, "stg_trip_telemetry_agg")
    tables.write_staging(telemetry(fleet), path)
    return files.scan_parquet(fleet.spark, path)


def _status_at(fleet: FleetData, before: bool) -> DataFrame:
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    pings = quick_pings(fleet)
    return live.latest_position(pings.where(F.col("event_time") < middle if before
                                            else F.col("event_time") >= middle))


@query
def upsert_status(fleet):
    """Positions of the month's second half over red vehicles of the first half."""
    old = _status_at(fleet, True).select(
        "vehicle_id", "lat", "lon", F.col("event_time").alias("last_event_time"),
        F.lit("RED").alias("incident_color"), F.lit("DOOR_OPEN").alias("incident_label"))
    return tables.upsert_positions(old, _status_at(fleet, False))


@query
def insert_if_absent(fleet):
    seen = (fleet.quick().groupBy("vehicle_id").agg(F.min("ts").alias("first_seen"))
            .withColumn("status", F.lit("seen")))
    seed = fleet.vehicles().select("vehicle_id", F.lit(None).cast("timestamp_ntz").alias("first_seen"),
                                   F.lit("seeded").alias("status"))
    return tables.insert_if_absent(seen, seed, "vehicle_id")


def _alerts(fleet: FleetData) -> str:
    """Replay both topics through the alert streams; returns the output root."""
    out = scratch_path(fleet.spark, "alerts")
    windows = cut(live_windows(fleet), "live-windows")
    _replay(fleet, ["quick", "slow"], lambda s: jobs.replay_alerts(
        s["quick"], s["slow"], windows, out, STATUS_WINDOW) or [])
    return out


FEED_RESULT = ["vehicle_id", "trip_id", "driver_id", "event_time", "incident_color",
               "incident_type", "detail", "lat", "lon", "sensor_id"]


@query
def append_feed(fleet):
    return jobs.read_feed(fleet.spark, _alerts(fleet)).select(*FEED_RESULT)


def _fact_by_start(df: DataFrame) -> DataFrame:
    return df.withColumn("start_date", F.to_date(F.col("start_date_key_sk").cast("string"), "yyyyMMdd"))


def _late_corrections(base: DataFrame) -> DataFrame:
    return (base.where(F.col("start_date_key_sk") >= 20240115)
            .withColumn("delivery_delay_min", F.col("delivery_delay_min") + 5))


MERGE_RESULT = ["trip_sk", "trip_id_bk", "start_date_key_sk", "delivery_delay_min", "fuel_cost_egp"]


@query
def merge_fact(fleet):
    """Load the first weeks, then merge corrections and later trips, twice."""
    path = scratch_path(fleet.spark, "fct")
    base = cut(_fact_by_start(fact(fleet)), "fact")
    tables.merge_partitions(path, base.where(F.col("start_date_key_sk") < 20240120), "trip_sk", "start_date")
    for _ in range(2):
        tables.merge_partitions(path, _late_corrections(base), "trip_sk", "start_date")
    return tables.read_partitioned(fleet.spark, path, "start_date").select(*MERGE_RESULT)


@query
def append_new_columns(fleet):
    """Updates bring a column that the table does not have; it is declared, and the older files read as null."""
    path = scratch_path(fleet.spark, "fct-grown")
    base = cut(_fact_by_start(fact(fleet)), "fact")
    tables.merge_partitions(path, base, "trip_sk", "start_date")
    tables.merge_partitions(path, _late_corrections(base).withColumn("audit_note", F.lit("late")), "trip_sk", "start_date")
    return tables.read_partitioned(fleet.spark, path, "start_date").select(*MERGE_RESULT, "audit_note")


@query
def full_refresh_table(fleet):
    path = scratch_path(fleet.spark, "dim_routes")
    for _ in range(2):
        tables.write_overwrite(route_dim(fleet), path)
    return files.scan_parquet(fleet.spark, path)


# ---- clean layer ----

@query
def silver_vehicles(fleet):
    return silver.silver_vehicles(raw(fleet).vehicles())


@query
def silver_drivers(fleet):
    return silver.silver_drivers(raw(fleet).drivers())


@query
def silver_cargo(fleet):
    return silver.silver_cargo(raw(fleet).cargo())


@query
def silver_trips_typed(fleet):
    return silver.typed_trips(raw(fleet).trips())


@query
def silver_trip_cargo_typed(fleet):
    return silver.typed_trip_cargo(raw(fleet).trip_cargo())


@query
def rename_roles(fleet):
    depots = silver.typed_depots(raw(fleet).depots())
    origin = silver.depot_role(depots, "origin")
    trips = fleet.trips().select("trip_id", F.floor(F.col("route_id") / (DEPOTS - 1))
                                 .cast("bigint").alias("origin_depot_id"))
    return trips.join(origin, "origin_depot_id", "left")


@query
def dedupe_by_key_(fleet):
    return dedupe_by_key(fleet.trip_cargo(), ["trip_id", "cargo_id"])



@query
def dedupe_full_row_(fleet):
    return dedupe_full_row(fleet.trip_cargo())



@query
def drop_null_keys_(fleet):
    typed = raw(fleet).trips().withColumn("vehicle_id", F.col("vehicle_id").try_cast("bigint"))
    return drop_null_keys(typed, ["vehicle_id"])



@query
def silver_daily_clean(fleet):
    """All days of the slow topic, each message delivered twice."""
    rows = messages.envelope(raw(fleet).slow_messages())
    return daily.clean_pings(rows.unionByName(rows), "slow").select(
        "vehicle_id", "sensor_id", "ts", "fuel_amount_l", "is_door_open", "cargo_temp_c")


@query
def fill_missing_measures(fleet):
    return rollup.fill_missing_measures(fleet.trips().select("trip_id").join(
        rollup.quick_rollup(matched_quick(fleet)), "trip_id", "left"))


@query
def parse_json_pings(fleet):
    parsed = messages.parse_json(raw(fleet).slow_messages(), "value", schemas.SLOW_JSON)
    return parsed.select("vehicle_id", "sensor_id", "is_door_open",
                         F.col("fuel_amount_l").try_cast("double").alias("fuel_amount_l"))


def _dirty_pings(fleet: FleetData) -> DataFrame:
    """Slow pings as strings, some with a malformed number or timestamp."""
    rows = messages.parse_json(raw(fleet).slow_messages(), "value", schemas.SLOW_JSON)
    return rows.withColumns({
        "fuel_amount_l": F.when(F.col("sensor_id").endswith("3"), F.lit("?")).otherwise(F.col("fuel_amount_l")),
        "timestamp": F.when(F.col("sensor_id").endswith("5"), F.lit("2024-13-45 10:00:00"))
        .otherwise(F.col("timestamp"))})


@query
def tolerant_parse(fleet):
    return messages.typed_slow(_dirty_pings(fleet)).select(
        "vehicle_id", "sensor_id", "event_time", "fuel_amount_l", "is_door_open", "cargo_temp_c")


@query
def tolerant_timestamp(fleet):
    return _dirty_pings(fleet).select("sensor_id", c.tolerant_timestamp("timestamp").alias("event_time"))


@query
def prune_columns(fleet):
    return fleet.trips().select("trip_id", "vehicle_id", "actual_start_time", "actual_end_time")


@query
def dim_vehicles(fleet):
    return vehicle_dim(fleet)


@query
def dim_drivers(fleet):
    return driver_dim(fleet)


@query
def dim_routes(fleet):
    return route_dim(fleet)


# ---- filters ----

@query
def filter_vehicle_range(fleet):
    return fleet.trips().where(F.col("vehicle_id") < rules.LIVE_FLEET_SIZE).select("trip_id", "vehicle_id")


@query
def threshold_flags(fleet):
    return rollup.quick_flags(fleet.quick()).select(
        "sensor_id", "engine_fault", "speeding", "drift", "battery_fault")


@query
def in_window_filter(fleet):
    """Trips whose actual start lies in their scheduled window, ends included."""
    t = F.col("actual_start_time")
    return fleet.trips().where((t >= F.col("scheduled_start_time")) & (t <= F.col("scheduled_end_time"))).select(
        "trip_id", "scheduled_start_time", "actual_start_time", "scheduled_end_time")


@query
def disjunctive_filter(fleet):
    flags = rollup.quick_flags(fleet.quick())
    return flags.where((F.col("speeding") > 0) | (F.col("engine_fault") > 0)).select(
        "sensor_id", "speeding", "engine_fault")


@query
def null_filter(fleet):
    return silver.typed_trips(raw(fleet).trips()).where(F.col("actual_end_time").isNotNull()).select(
        "trip_id", "actual_end_time")


@query
def date_slice_filter(fleet):
    return fleet.trips().where(tables.on_day("actual_start_time", TARGET_DAY)).select(
        "trip_id", "actual_start_time")


@query
def having_filter(fleet):
    sums = rollup.quick_flags(fleet.quick()).groupBy("vehicle_id").agg(
        F.sum("battery_fault").alias("battery_fault_ticks"))
    return sums.where(F.col("battery_fault_ticks") > BATTERY_TICKS)


@query
def in_list(fleet):
    return batch_feed(fleet).where(F.col("incident_color").isin("RED", "ORANGE")).select(
        "sensor_id", "incident_type", "incident_color")


@query
def recent_window_filter(fleet):
    feed = batch_feed(fleet)
    return live.recent(feed, newest(feed), STATUS_WINDOW).select("sensor_id", "incident_type", "detected_at")


@query
def mid_route_guard(fleet):
    pings = live.attach_trip(slow_pings(fleet), live_windows(fleet))
    return pings.where((F.col("is_door_open") == 1) & rules.mid_route(
        F.col("event_time"), F.col("start_ts"), F.col("end_ts"))).select("sensor_id", "trip_id", "event_time")


# ---- joins ----

@query
def left_join_cargo(fleet):
    return fleet.trip_cargo().join(fleet.cargo(), "cargo_id", "left")


@query
def silver_routes(fleet):
    return silver.silver_routes(raw(fleet).routes(), raw(fleet).depots())


@query
def join_trip_inputs(fleet):
    return joined_trips(fleet)


def _silver_trips(fleet: FleetData) -> DataFrame:
    r = raw(fleet)
    return silver.silver_trips(r.trips(), silver.silver_vehicles(r.vehicles()),
                               silver.silver_drivers(r.drivers()),
                               silver.silver_routes(r.routes(), r.depots()))


@query
def silver_trips(fleet):
    return _silver_trips(fleet)


@query
def silver_trip_cargo(fleet):
    return silver.silver_trip_cargo(raw(fleet).trip_cargo(), _silver_trips(fleet),
                                    silver.silver_cargo(raw(fleet).cargo()))


@query
def asof_trip_match(fleet):
    return matched_quick(fleet).select("sensor_id", "vehicle_id", "ts", "trip_id")


@query
def stream_static_asof(fleet):
    """Each batch joins the windows that are published when it runs; every ping keeps one row."""
    out, store = scratch_path(fleet.spark, "stream-asof"), _published(fleet)
    _replay(fleet, ["slow"], lambda s: [jobs.run_each_batch(
        messages.once(s["slow"]), jobs.attach_step(store, f"{out}/rows"), f"{out}/cp", jobs.DRAIN)])
    return fleet.spark.read.parquet(f"{out}/rows").select(
        "sensor_id", "vehicle_id", "event_time", "trip_id", "driver_id", "cargo_type", "min_temp",
        "max_temp", "start_ts", "end_ts")


@query
def outer_join_rollups(fleet):
    return rollup.outer_join_rollups(rollup.quick_rollup(matched_quick(fleet)),
                                     rollup.slow_rollup(matched_slow(fleet)))


@query
def left_join_bounds(fleet):
    return rollup.bounded_trips(fleet.trips(), bounds(fleet)).select(
        "trip_id", "vehicle_id", "min_temp", "max_temp")


def _stale_status(fleet: FleetData) -> DataFrame:
    return live.latest_position(quick_pings(fleet)).select(
        "vehicle_id", "lat", "lon", F.col("event_time").alias("last_event_time"),
        F.lit("RED").alias("incident_color"), F.lit("DOOR_OPEN").alias("incident_label"))


def _recent_worst(fleet: FleetData) -> DataFrame:
    feed = batch_feed(fleet)
    return live.highest_severity(live.recent(feed, newest(feed), STATUS_WINDOW))


@query
def anti_join_reset(fleet):
    return joins.anti_join_reset(_stale_status(fleet), _recent_worst(fleet))


@query
def update_from_join(fleet):
    return joins.update_from_join(_stale_status(fleet), _recent_worst(fleet))


@query
def star_join(fleet):
    f, d, r = fact(fleet), driver_dim(fleet), route_dim(fleet)
    v = vehicle_dim(fleet)
    return (f.join(d, f.driver_key_sk == d.driver_sk).join(r, f.route_key_sk == r.route_sk)
            .join(v, f.vehicle_key_sk == v.vehicle_sk)
            .select("trip_id_bk", "full_name", "model", "origin_governorate",
                    "destination_governorate", "fuel_cost_egp"))


@query
def route_matrix(fleet):
    return fleet.route_pairs().withColumn(
        "encoded_id", joins.encode_route("origin_depot_id", "destination_depot_id", DEPOTS).cast("bigint"))


@query
def fk_violations(fleet):
    keys = fact(fleet).select("trip_id_bk", "driver_key_sk")
    return joins.orphans(keys, "driver_key_sk", driver_dim(fleet), "driver_sk")


# ---- aggregates ----

@query
def trip_cargo_agg(fleet):
    return cargo_agg(fleet)


@query
def trip_thermal_bounds(fleet):
    return bounds(fleet)


@query
def quick_rollup(fleet):
    return rollup.quick_rollup(matched_quick(fleet))


@query
def slow_rollup(fleet):
    return rollup.slow_rollup(matched_slow(fleet))


@query
def breach_ticks(fleet):
    return rollup.breach_flags(matched_slow(fleet)).groupBy("trip_id").agg(F.sum("breach").alias("breach_ticks"))


@query
def fuel_consumed(fleet):
    return rollup.slow_rollup(matched_slow(fleet)).select("trip_id", "total_fuel_consumed_l")


@query
def trip_telemetry_agg(fleet):
    return telemetry(fleet)


@query
def global_sum(fleet):
    return fleet.slow().agg(F.sum(c.reading("fuel_amount_l")).alias("fuel_total"))


@query
def count_distinct(fleet):
    return fact(fleet).agg(F.countDistinct("vehicle_key_sk").alias("vehicles"))


@query
def two_level_agg(fleet):
    per = fleet.quick().groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n"))
    band = F.when(F.col("n") > 30, "busy").otherwise("quiet")
    return per.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("vehicles"))


@query
def group_by_expression(fleet):
    return fleet.vehicles().groupBy(c.mileage_bracket("current_mileage").alias("mileage_bracket"),
                                    F.concat("model", F.lit("/"), "fuel_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("vehicles"))


@query
def filtered_counts(fleet):
    return fleet.quick().agg(F.count(F.lit(1)).alias("pings"), F.count_if(rules.speeding()).alias("speeding"),
                             F.count_if(rules.drifting() & ~rules.speeding()).alias("drift_only"))


@query
def avg_rounded(fleet):
    total, n = F.sum("is_door_open"), F.count(F.lit(1))
    return fleet.slow().groupBy("vehicle_id").agg(*[
        c.rounded_ratio(total * 100, n, d).alias(f"door_pct_{d}dp") for d in (0, 1, 2)])


@query
def mixed_cargo_audit(fleet):
    return audits.mixed_cargo_trips(fleet.trip_cargo(), fleet.cargo())


@query
def status_distribution(fleet):
    return audits.share_by(fleet.trip_cargo(), "load_status")


@query
def share_of_total(fleet):
    return audits.share_by(fleet.quick(), "vehicle_id")


@query
def value_counts(fleet):
    return audits.value_counts(fleet.cargo(), "cargo_type")


@query
def double_booking_audit(fleet):
    return audits.double_bookings(fleet.trips())


@query
def table_profile(fleet):
    return audits.table_profile(fleet.trips())


@query
def latest_position(fleet):
    return live.latest_position(quick_pings(fleet)).drop("sensor_id")


@query
def unique_violations(fleet):
    return audits.unique_violations(raw(fleet).trips(), "trip_id")


@query
def not_null_violations(fleet):
    typed = raw(fleet).trips().withColumn("vehicle_id", F.col("vehicle_id").try_cast("bigint"))
    return audits.not_null_violations(typed, ["trip_id", "vehicle_id"])


# ---- order ----

@query
def lag_fuel(fleet):
    return rollup.lag_fuel(matched_slow(fleet)).select("sensor_id", "trip_id", "fuel", "prev_fuel")


@query
def highest_severity(fleet):
    return live.highest_severity(batch_feed(fleet))


@query
def resequence_ids(fleet):
    return resequence(fleet.trips(), ["scheduled_start_time", "trip_id"], "new_trip_id").select(
        "new_trip_id", "trip_id", "scheduled_start_time")


@query
def topk(fleet):
    return top_rows(fleet.slow().select("sensor_id", "vehicle_id", "fuel_amount_l"),
                    [F.desc("fuel_amount_l"), F.col("sensor_id")], 50)


@query
def sort_only(fleet):
    return fleet.trips().select("vehicle_id", "scheduled_start_time", "trip_id").orderBy(
        "vehicle_id", F.desc("scheduled_start_time"), "trip_id")


@query
def concat_parts(fleet):
    return (fleet.quick().select("vehicle_id", "sensor_id", "ts")
            .unionByName(fleet.slow().select("ts", "sensor_id", "vehicle_id")))


# ---- scalar functions ----

@query
def surrogate_key(fleet):
    typed = raw(fleet).trips().withColumn("vehicle_id", F.col("vehicle_id").try_cast("bigint"))
    return typed.select("trip_id", c.surrogate_key("vehicle_id").alias("vehicle_sk"),
                        c.surrogate_key("trip_id", "vehicle_id").alias("pair_sk"))


@query
def date_key(fleet):
    return fleet.trips().select("trip_id", c.date_key("actual_start_time").alias("date_sk"))


@query
def calendar_parts(fleet):
    parts = c.calendar_parts(F.to_date("actual_start_time"))
    return fleet.trips().select("trip_id", *[col.alias(n) for n, col in parts.items()])


@query
def minutes_between(fleet):
    return fleet.trips().select(
        "trip_id", c.minutes_between("scheduled_end_time", "actual_end_time").alias("delivery_delay_min"),
        c.minutes_between("scheduled_start_time", "actual_start_time").alias("loading_lag_min"))


@query
def base_fee(fleet):
    return fleet.cargo().select("cargo_id", c.base_fee("cargo_type").alias("base_fee"))


@query
def fuel_cost(fleet):
    return fleet.slow().select("sensor_id", c.fuel_cost("fuel_amount_l").alias("fuel_cost_egp"))


@query
def weight_surcharge(fleet):
    return fleet.cargo().select("cargo_id", c.weight_surcharge("weight_kg").alias("weight_surcharge"))


@query
def total_trip_cost(fleet):
    return joined_trips(fleet).select("trip_id", c.total_trip_cost(
        "total_fuel_consumed_l", "cargo_type", "total_cargo_weight_kg").alias("total_trip_cost_egp"))


@query
def severity_code(fleet):
    return batch_feed(fleet).select("sensor_id", "incident_type",
                                    c.severity_code("incident_color").alias("severity"))


@query
def mileage_bracket(fleet):
    return fleet.vehicles().select("vehicle_id", c.mileage_bracket("current_mileage").alias("mileage_bracket"))


@query
def distance_bin(fleet):
    return fleet.quick().select("sensor_id", c.distance_bin("odometer_km").alias("distance_bin_km"))


def _trip_routes(fleet: FleetData) -> DataFrame:
    return fleet.trips().select("trip_id", "route_id").join(routes(fleet), "route_id", "left")


@query
def corridor_label(fleet):
    return _trip_routes(fleet).select("trip_id", c.corridor_label(
        "origin_governorate", "destination_governorate").alias("corridor"))


def _distance():
    return c.haversine_km("origin_lat", "origin_lon", "destination_lat", "destination_lon")


@query
def haversine_km(fleet):
    return _trip_routes(fleet).select("trip_id", F.round(_distance(), 4).alias("distance_km"))


@query
def travel_hours(fleet):
    return _trip_routes(fleet).select("trip_id", c.travel_hours(_distance()).alias("travel_hours"))


@query
def trim_text(fleet):
    return raw(fleet).trip_cargo().select("trip_id", "cargo_id", F.trim("load_status").alias("load_status"))


@query
def coalesce_zero(fleet):
    agg = rollup.slow_rollup(matched_slow(fleet))
    return fleet.trips().select("trip_id").join(agg, "trip_id", "left").select(
        "trip_id", F.coalesce("total_fuel_consumed_l", F.lit(0).cast(c.AMOUNT)).alias("total_fuel_consumed_l"))


@query
def incident_detail(fleet):
    return batch_feed(fleet).select("sensor_id", "incident_type", "detail")


# ---- streaming ----

@query
def stream_trigger(fleet):
    out = scratch_path(fleet.spark, "trigger")
    _replay(fleet, ["slow"], lambda s: [jobs.land_topic(s["slow"], f"{out}/slow", f"{out}/cp", jobs.DRAIN)])
    return fleet.spark.read.parquet(f"{out}/slow").groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("messages"))


@query
def stream_checkpoint(fleet):
    """Each slice is drained by a restarted stream; no message is lost or repeated."""
    out = scratch_path(fleet.spark, "restart")
    _replay(fleet, ["quick"], lambda s: [jobs.land_topic(s["quick"], f"{out}/quick", f"{out}/cp", jobs.DRAIN)])
    rows = fleet.spark.read.parquet(f"{out}/quick").select(F.get_json_object("raw_json", "$.sensor_id").alias("sensor_id"))
    return rows.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("deliveries"))


@query
def stream_multi_query(fleet):
    out = scratch_path(fleet.spark, "multi")
    _replay(fleet, ["quick", "slow"], lambda s: [
        jobs.land_topic(s[k], f"{out}/{k}", f"{out}/cp-{k}", jobs.DRAIN) for k in ("quick", "slow")])
    rows = [fleet.spark.read.parquet(f"{out}/{k}") for k in ("quick", "slow")]
    return rows[0].unionByName(rows[1]).groupBy("topic", "ingest_date").agg(
        F.count(F.lit(1)).alias("messages"))


@query
def quick_incidents(fleet):
    return batch_quick_incidents(fleet)


@query
def slow_incidents(fleet):
    return batch_slow_incidents(fleet)


@query
def fuel_drop_state(fleet):
    """The fuel memory the slow stream leaves behind."""
    out, store = scratch_path(fleet.spark, "fuel-state"), _published(fleet)
    _replay(fleet, ["slow"], lambda s: [jobs.run_each_batch(
        messages.once(s["slow"]), jobs.slow_step(store, out, jobs.at_event_time), f"{out}/cp", jobs.DRAIN)])
    return jobs.read_state(fleet.spark, f"{out}/fuel", jobs.FUEL_SCHEMA)


@query
def vehicle_status(fleet):
    """The status table the streams leave behind, coloured as of the newest incident."""
    out = _alerts(fleet)
    return jobs.read_status(fleet.spark, out)


@query
def refresh_colours(fleet):
    feed = batch_feed(fleet)
    return live.refresh_colours(_stale_status(fleet), feed, newest(feed), STATUS_WINDOW)


@query
def incident_feed(fleet):
    return batch_feed(fleet).select(*FEED_RESULT)


@query
def fuel_drop_batch(fleet):
    return live.fuel_drop_batch(slow_pings(fleet)).select("sensor_id", "vehicle_id", "prev_fuel", "fuel_drop")


# ---- incremental control and quality ----

def _backfill_end(fleet: FleetData) -> date:
    """The day of the latest trip start: where a historical load of these tables ends."""
    return fleet.trips().agg(F.max(F.to_date("actual_start_time"))).first()[0]


def _seeded(fleet: FleetData) -> DataFrame:
    empty = fleet.spark.createDataFrame([], schemas.CHECKPOINTS)
    return control.checkpoints_seed(empty, _backfill_end(fleet))


CONTROL_RESULT = ["stage_name", "last_processed_date", "rows_processed", "status"]


@query
def checkpoints_seed(fleet):
    return control.checkpoints_seed(_seeded(fleet), control.BACKFILL_END).select(*CONTROL_RESULT)


@query
def next_target_date(fleet):
    return control.next_target_date(_seeded(fleet))


def _processed(fleet: FleetData) -> control.ControlTable:
    """Two stages advanced over the target day, with the rows each found on it."""
    table = control.ControlTable(fleet.spark, scratch_path(fleet.spark, "control"),
                                 TARGET_DAY - timedelta(days=1))
    work = {"bronze": fleet.quick().where(F.to_date("ts") == F.lit(TARGET_DAY)),
            "silver": fleet.trips().where(tables.on_day("actual_start_time", TARGET_DAY))}
    for stage, rows in work.items():
        table.advance(stage, table.target(stage), rows.count())
    return table


@query
def advance_checkpoint(fleet):
    return _processed(fleet).current().select(*CONTROL_RESULT)


@query
def rewind_checkpoint(fleet):
    table = _processed(fleet)
    table.rewind("silver", TARGET_DAY - timedelta(days=3))
    return table.current().select(*CONTROL_RESULT)


@query
def checkpoint_report(fleet):
    return control.checkpoint_report(_processed(fleet).current()).select(*CONTROL_RESULT)


def _lake(fleet: FleetData, until: date) -> daily.Lake:
    lake = daily.Lake(fleet.spark, scratch_path(fleet.spark, "lake"), until)
    source = raw(fleet)
    lake.land({n: source.table(n) for n in schemas.RAW},
              {"quick": source.quick_messages(), "slow": source.slow_messages()})
    daily.backfill_run(lake, until)
    return lake


@query
def backfill_pipeline(fleet):
    return _lake(fleet, _backfill_end(fleet)).fact()


def lake_before_last_day(fleet: FleetData) -> daily.Lake:
    """All but the last day with trips, loaded as history."""
    return _lake(fleet, _backfill_end(fleet) - timedelta(days=1))


@query
def daily_pipeline(fleet):
    """Backfill all but the last day with trips, then run that day."""
    lake = lake_before_last_day(fleet)
    daily.daily_run(lake)
    return lake.fact()


@query
def dq_gate(fleet):
    models = {"dim_vehicles": vehicle_dim(fleet), "dim_drivers": driver_dim(fleet), "dim_routes": route_dim(fleet),
              "fct_trip_operations": fact(fleet)}
    return quality.summary({name: cut(df, name) for name, df in models.items()})


@query
def row_loss_report(fleet):
    r = raw(fleet)
    return joins.row_loss(silver.typed_trips(r.trips()), {
        "vehicle_id": fleet.vehicles(), "driver_id": fleet.drivers(), "route_id": fleet.route_ids()})


# ---- gold and business questions ----

@query
def fct_trip_operations(fleet):
    return fact(fleet)


@query
def q1_1_dangerous_drivers(fleet):
    return bi.dangerous_drivers(fact(fleet), driver_dim(fleet))


@query
def q1_1_by_name(fleet):
    return bi.aggressive_by_name(fact(fleet), driver_dim(fleet))


@query
def q1_2_speeding_vs_engine(fleet):
    return bi.speeding_vs_engine(fact(fleet))


@query
def q2_1_vehicles_at_risk(fleet):
    return bi.vehicles_at_risk(fact(fleet), BATTERY_TICKS)


@query
def q2_1_risk_list(fleet):
    return bi.risk_list(fact(fleet), vehicle_dim(fleet), BATTERY_TICKS)


@query
def q2_1_risk_band(fleet):
    return bi.risk_band(fact(fleet), BATTERY_TICKS)


@query
def q2_2_mileage_wear(fleet):
    return bi.mileage_wear(fact(fleet), vehicle_dim(fleet))


@query
def q3_1_breach_by_type(fleet):
    return bi.breach_by_type(fact(fleet))


@query
def q3_2_breach_by_distance(fleet):
    return bi.breach_by_distance(fact(fleet))


@query
def q4_1_corridors(fleet):
    return bi.corridors(fact(fleet), route_dim(fleet))


@query
def q4_2_loading_lag(fleet):
    return bi.loading_lag(fact(fleet), route_dim(fleet))


@query
def q5_1_fuel_cost(fleet):
    return bi.fuel_cost_by_governorate(fact(fleet), route_dim(fleet))


@query
def q5_1_total_fuel(fleet):
    return bi.total_fuel_cost(fact(fleet))


@query
def q5_2_net_profit(fleet):
    return bi.net_profit(fact(fleet), route_dim(fleet))


@query
def q5_2_by_corridor(fleet):
    return bi.net_profit_by_corridor(fact(fleet), route_dim(fleet))


def stored_star(fleet: FleetData) -> StarStore:
    """The stored star of the fleet; the fact is written once, as the store reads it once per role."""
    root = scratch_path(fleet.spark, "star")
    store = StarStore(fleet.spark, root, root.rsplit("/", 1)[1].replace("-", "_"),
                      int(fleet.spark.conf.get("spark.sql.shuffle.partitions")))
    store.write(cut(fact(fleet), "fact"), {
        "driver": driver_dim(fleet), "vehicle": vehicle_dim(fleet), "route": route_dim(fleet)})
    return store


@query
def stored_by_name(fleet):
    star = stored_star(fleet)
    return bi.aggressive_by_name(star.sums("driver"), star.dim("driver"))


@query
def stored_mileage_wear(fleet):
    star = stored_star(fleet)
    return bi.mileage_wear(star.sums("vehicle"), star.dim("vehicle"))


@query
def stored_by_corridor(fleet):
    star = stored_star(fleet)
    return bi.net_profit_by_corridor(star.sums("route"), star.dim("route"))


@query
def live_map(fleet):
    return bi.live_map(batch_status(fleet))


@query
def live_feed(fleet):
    return bi.live_feed(batch_feed(fleet))


@query
def fleet_ticker(fleet):
    return bi.fleet_ticker(batch_status(fleet))


@query
def incidents_by_colour(fleet):
    return bi.incidents_by_colour(batch_feed(fleet))
