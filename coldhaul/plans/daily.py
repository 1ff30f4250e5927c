"""The lake runs: full rebuild, and idempotent daily increments.

Zones under one root: ``landing`` (raw tables and messages as they arrive), ``bronze``
(copied day by day), ``silver`` (clean), ``staging`` (per-trip rollups) and ``gold``.
Trip-grain tables are partitioned by the day a trip starts. Pings arrive by the date of their message
and are kept by the day of their event; a daily run merges its arrivals into the event days they
belong to and rebuilds those days' parts, so late pings count as in a full rebuild. What a daily run reads is named
from small tables: declared columns, the partitions of a key, and the last end among the trips of each start day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul import schemas
from coldhaul.functions.columns import number
from coldhaul.operators import quality, rollup
from coldhaul.operators.asof import any_long, match_trips, trip_windows
from coldhaul.operators.joins import keep_known
from coldhaul.operators.ordered import dedupe_full_row, drop_null_keys
from coldhaul.plans import gold, silver
from coldhaul.plans.control import UNKNOWN_ROWS, ControlTable
from coldhaul.session import cut, together
from coldhaul.sinks.schema_log import read_table
from coldhaul.sinks.tables import (
    build_key_map, copy_partition_forward, merge_partitions, read_partitioned, read_partitions, read_span,
    replace_partition, replace_partitions, write_overwrite, write_partitioned)
from coldhaul.sources.files import path_exists, scan_daily_slice, scan_days
from coldhaul.streaming.messages import envelope, parse_json

DIMENSIONS = ["vehicles", "drivers", "cargo", "depots", "routes"]
TOPICS = {"quick": schemas.QUICK_JSON, "slow": schemas.SLOW_JSON}
PING_NUMBERS = {
    "quick": {"lat": "double", "lon": "double", "odometer_km": "double", "rpm": "double",
              "throttle_pct": "double", "accel_ay_abs": "double", "battery_v": "double"},
    "slow": {"fuel_amount_l": "double", "is_door_open": "int", "cargo_temp_c": "double"},
}
START = "actual_start_time"
# event times outside of these years are taken as malformed, which bounds the days that pings can lie on
YEARS = ("2000-01-01", "2100-01-01")
# the keys that the daily run merges by
KEYS = {("silver", "trips"): "trip_id", ("silver", "trip_cargo"): "trip_id", ("staging", "trip_cargo_agg"): "trip_id",
        ("staging", "trip_telemetry_agg"): "trip_id", ("gold", "fct_trip_operations"): "trip_sk"}
# the date columns that tables are partitioned by
PARTITIONS = {("landing", "trips"): "dt", ("landing", "trip_cargo"): "dt",
              ("silver", "trips"): "start_date", ("silver", "trip_cargo"): "start_date",
              ("gold", "fct_trip_operations"): "start_date",
              **{("landing", kind): "ingest_date" for kind in TOPICS},
              **{("silver", kind): "dt" for kind in TOPICS},
              **{("staging", f"{kind}_parts"): "dt" for kind in TOPICS},
              **{("staging", f"trip_{kind}_agg"): "start_date" for kind in ("cargo", "telemetry")}}


def clean_pings(envelopes: DataFrame, kind: str) -> DataFrame:
    """Parse one topic's envelopes; rows without a vehicle and repeated rows go."""
    pings = parse_json(envelopes, "raw_json", TOPICS[kind])
    at = F.col("timestamp").try_cast("timestamp_ntz")
    first, after = [F.lit(day).cast("timestamp_ntz") for day in YEARS]
    typed = pings.withColumns({
        "vehicle_id": F.col("vehicle_id").try_cast("bigint"),
        "ts": F.when((at >= first) & (at < after), at),
        **{c: number(c, t) for c, t in PING_NUMBERS[kind].items()}}).drop("timestamp")
    return dedupe_full_row(drop_null_keys(typed, ["vehicle_id"]))


def ping_schema(kind: str) -> T.StructType:
    return schemas.typed(vehicle_id="bigint", sensor_id="string", **PING_NUMBERS[kind],
                         ts="timestamp_ntz")


class Lake:
    """Paths and tables of one lake."""

    def __init__(self, spark: SparkSession, root: str, backfill_end: date):
        self.spark, self.root = spark, root
        self.control = ControlTable(spark, self.path("control", "etl_checkpoints"), backfill_end)

    def path(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"

    def read(self, zone: str, table: str) -> DataFrame:
        column = PARTITIONS.get((zone, table))
        if column is None:
            return read_table(self.spark, self.path(zone, table))
        return read_partitioned(self.spark, self.path(zone, table), column)

    def span(self, zone: str, table: str, first: date | None, last: date | None) -> DataFrame:
        """The partitions of a table between two days; only their folders are listed."""
        return read_span(self.spark, self.path(zone, table), PARTITIONS[zone, table], first, last)

    def merge(self, zone: str, table: str, rows: DataFrame, replaced: DataFrame | None = None) -> None:
        merge_partitions(self.path(zone, table), rows, KEYS[zone, table], PARTITIONS[zone, table], replaced)

    def note_ends(self, trips: DataFrame) -> None:
        """Log the last end among the given trips of each start day.

        The log only grows, a row per day and run: the greatest end logged for a day is never before the true one, and
        a later one makes :meth:`since` go further back than need be.
        """
        (trips.where("start_date IS NOT NULL").groupBy("start_date").agg(F.max("actual_end_time").alias("last_end"))
         .coalesce(1).write.mode("append").parquet(self.path("control", "trip_ends")))

    def since(self, day: date) -> date:
        """The first start day of a trip that may still run on ``day``.

        All trips that start from then on are needed, as a later trip ends the window of an earlier one.
        """
        ends = self.spark.read.schema("start_date date, last_end timestamp_ntz").parquet(self.path("control", "trip_ends"))
        first = ends.where(F.col("last_end") >= F.lit(str(day)).cast("timestamp_ntz")).agg(F.min("start_date")).first()[0]
        return min(first or day, day)

    def land(self, raw: dict[str, DataFrame], messages: dict[str, DataFrame]) -> None:
        """Put raw tables and messages into the landing zone, trips and pings by day."""
        trips = raw["trips"].withColumn("dt", F.col(START).try_cast("timestamp_ntz").cast("date"))
        days = trips.groupBy("trip_id").agg(F.min("dt").alias("dt"))
        dated = {"trips": (trips, "dt"),
                 "trip_cargo": (raw["trip_cargo"].join(days, "trip_id", "left"), "dt"),
                 **{kind: (envelope(df), "ingest_date") for kind, df in messages.items()}}
        together(*[partial(write_overwrite, raw[name], self.path("landing", name)) for name in DIMENSIONS],
                 *[partial(write_partitioned, df, self.path("landing", name), column)
                   for name, (df, column) in dated.items()])

    # ---- gold pieces shared by both runs ----

    def dimensions(self) -> dict[str, DataFrame]:
        return {"dim_vehicles": self.read("gold", "dim_vehicles"),
                "dim_drivers": self.read("gold", "dim_drivers"),
                "dim_routes": self.read("gold", "dim_routes")}

    def fact(self) -> DataFrame:
        return self.read("gold", "fct_trip_operations").select(*gold.FACT_COLUMNS)

    def pings(self, kind: str, days: list[date]) -> DataFrame:
        return scan_days(self.spark, self.path("silver", kind), ping_schema(kind), "dt", days)

    def gate(self) -> DataFrame:
        return quality.summary({**self.dimensions(), "fct_trip_operations": self.fact()})


def _by_start(df: DataFrame) -> DataFrame:
    return df.withColumn("start_date", F.to_date(START))


def _fact(trips: DataFrame, cargo_agg: DataFrame, telemetry: DataFrame) -> DataFrame:
    joined = gold.join_trip_inputs(trips, cargo_agg, telemetry)
    return gold.fct_trip_operations(joined).withColumn(
        "start_date", F.to_date(F.col("start_date_key_sk").cast("string"), "yyyyMMdd"))


def backfill_run(lake: Lake, until: date) -> None:
    """Rebuild every layer from the landing zone, up to and including ``until``."""
    def landed(name: str) -> DataFrame:
        return lake.read("landing", name)

    tables = {"vehicles": silver.silver_vehicles(landed("vehicles")),
              "drivers": silver.silver_drivers(landed("drivers")),
              "cargo": silver.silver_cargo(landed("cargo")),
              "routes": silver.silver_routes(landed("routes"), landed("depots"))}
    arrived = F.col("ingest_date").isNull() | (F.col("ingest_date") <= F.lit(until))
    pings = {kind: clean_pings(landed(kind).where(arrived), kind)
             .withColumn("dt", F.to_date("ts")) for kind in TOPICS}
    together(*[partial(write_overwrite, df, lake.path("silver", n)) for n, df in tables.items()],
             *[partial(write_partitioned, df, lake.path("silver", n), "dt") for n, df in pings.items()])
    dims = {n: lake.read("silver", n) for n in tables}

    known = F.col("dt").isNull() | (F.col("dt") <= F.lit(until))
    trips = silver.silver_trips(landed("trips").where(known), dims["vehicles"], dims["drivers"],
                                dims["routes"])
    write_partitioned(_by_start(trips), lake.path("silver", "trips"), "start_date")
    trips = lake.read("silver", "trips")
    write_overwrite(trips.limit(0).select("start_date", F.col("actual_end_time").alias("last_end")),
                    lake.path("control", "trip_ends"))
    lake.note_ends(trips)
    starts = trips.select("trip_id", "start_date")
    # trips are single, so the join that adds the start is also the check of the trip
    bridge = keep_known(silver.typed_trip_cargo(landed("trip_cargo").where(known)), {"cargo_id": dims["cargo"]})
    write_partitioned(bridge.join(starts, "trip_id"), lake.path("silver", "trip_cargo"), "start_date")
    bridge = lake.read("silver", "trip_cargo")

    # the bridge is the largest table: one pass gives both its totals and the bounds of the trips
    windows, summary = together(partial(cut, trip_windows(trips), "windows"),
                                partial(cut, rollup.trip_cargo_summary(bridge, dims["cargo"]), "cargo-of-trips"))
    parts = _parts(lake.read("silver", "quick"), lake.read("silver", "slow"), windows, rollup.thermal_bounds(summary))
    cargo_agg = rollup.cargo_totals(summary)
    models = {"dim_vehicles": gold.dim_vehicles(dims["vehicles"]),
              "dim_drivers": gold.dim_drivers(dims["drivers"]),
              "dim_routes": gold.dim_routes(dims["routes"]), "dim_date": gold.dim_date(lake.spark)}
    together(*[partial(write_partitioned, df, lake.path("staging", n), "dt") for n, df in parts.items()],
             partial(write_partitioned, cargo_agg.join(starts, "trip_id"),
                     lake.path("staging", "trip_cargo_agg"), "start_date"),
             *[partial(write_overwrite, df, lake.path("gold", n)) for n, df in models.items()])
    telemetry = rollup.outer_join_rollups(rollup.quick_totals(lake.read("staging", "quick_parts")),
                                          rollup.slow_totals(lake.read("staging", "slow_parts")))
    write_partitioned(telemetry.join(starts, "trip_id"), lake.path("staging", "trip_telemetry_agg"),
                      "start_date")
    fact = _fact(trips.drop("start_date"),
                 lake.read("staging", "trip_cargo_agg").drop("start_date"),
                 lake.read("staging", "trip_telemetry_agg").drop("start_date"))
    write_partitioned(fact, lake.path("gold", "fct_trip_operations"), "start_date")
    together(*[partial(build_key_map, lake.spark, lake.path(*table), key, PARTITIONS[table]) for table, key in KEYS.items()])
    quality.enforce(lake.gate())
    lake.control.ensure()


# ---- the daily stages; each returns the rows it processed ----

def bronze_day(lake: Lake, day: date) -> int:
    def copy(name: str, schema: T.StructType, column: str) -> int:
        return copy_partition_forward(lake.spark, lake.path("landing", name), lake.path("bronze", name), schema, column, day)

    return sum(together(*[partial(copy, kind, schemas.ENVELOPE, "ingest_date") for kind in TOPICS],
                        *[partial(copy, name, schemas.RAW[name], "dt") for name in ("trips", "trip_cargo")]))


def _bronze(lake: Lake, name: str, schema: T.StructType, day: date) -> DataFrame:
    return scan_daily_slice(lake.spark, lake.path("bronze", name), schema, "dt", day).drop("dt")


def silver_day(lake: Lake, day: date) -> int:
    def pings(kind: str) -> tuple[int, set[date | None]]:
        arrived = cut(clean_pings(_bronze(lake, kind, schemas.ENVELOPE, day), kind)
                      .withColumn("dt", F.to_date("ts")), "arrivals")
        return arrived.count(), merge_pings(lake, kind, arrived)

    merged = together(*[partial(pings, kind) for kind in TOPICS])
    rows, days = sum(n for n, _ in merged), {day}.union(*[of for _, of in merged])
    event_days = lake.spark.createDataFrame([(d,) for d in sorted(d for d in days if d)], "event_day date")
    replace_partition(event_days, lake.path("control", "event_days"), "dt", day)
    trips = silver.silver_trips(_bronze(lake, "trips", schemas.RAW["trips"], day),
                                *[lake.read("silver", n) for n in ("vehicles", "drivers", "routes")])
    trips = cut(_by_start(trips), "trips-of-day")
    bridge = silver.silver_trip_cargo(_bronze(lake, "trip_cargo", schemas.RAW["trip_cargo"], day),
                                      trips, lake.read("silver", "cargo"))
    bridge = cut(bridge.join(trips.select("trip_id", "start_date"), "trip_id"), "cargo-of-day")
    # a trip that arrives again with another start day leaves its old partition, and its cargo with it
    lake.note_ends(trips)
    together(partial(lake.merge, "silver", "trips", trips),
             partial(lake.merge, "silver", "trip_cargo", bridge, trips.select("trip_id")))
    return rows + bridge.count()


def merge_pings(lake: Lake, kind: str, arrived: DataFrame) -> set[date | None]:
    """Add arrivals to the silver partitions of their event days; returns those days.

    Rows that repeat a stored one go, so doing it again changes nothing. Collected is one date
    per event day that a day's arrivals have.
    """
    path = lake.path("silver", kind)
    days = {r[0] for r in arrived.select("dt").distinct().collect()}
    if days and path_exists(lake.spark, path):
        held = read_partitions(lake.spark, path, "dt", days)
        arrived = dedupe_full_row(held.unionByName(arrived))
    if days:
        replace_partitions(arrived, path, "dt", days)
    return days


def event_days(lake: Lake, day: date) -> list[date]:
    """The day itself and the event days of the pings that arrived on it."""
    rows = scan_daily_slice(lake.spark, lake.path("control", "event_days"),
                            T.StructType([T.StructField("event_day", T.DateType())]), "dt", day)
    return sorted({day, *(r[0] for r in rows.select("event_day").collect())})


def match_days(lake: Lake, days: list[date]) -> None:
    """Match the pings of event days to trips and store the days' parts of each trip's rollup.

    Parts add up over days, so only these days' pings are read, and of the trips those that start between the first
    day of a trip that may still run and the last event day.
    """
    first = lake.since(min(days))
    windows = cut(trip_windows(lake.span("silver", "trips", first, max(days))).where(
        F.col("end_ts") >= F.lit(str(min(days))).cast("timestamp_ntz")), "windows-of-day")
    bridge = lake.span("silver", "trip_cargo", first, max(days)).join(windows.select("trip_id"), "trip_id", "left_semi")
    bounds = rollup.trip_thermal_bounds(bridge, lake.read("silver", "cargo"))
    parts = _parts(lake.pings("quick", days), lake.pings("slow", days), windows, bounds)
    together(*[partial(replace_partitions, part, lake.path("staging", name), "dt", days) for name, part in parts.items()])


def _parts(quick: DataFrame, slow: DataFrame, windows: DataFrame,
           bounds: DataFrame) -> dict[str, DataFrame]:
    """Rollup parts per trip and day of both topics."""
    long = any_long(windows)
    matched = match_trips(slow, rollup.bounded_windows(windows, bounds), "ts", long=long)
    parts = {"quick_parts": rollup.quick_parts(match_trips(quick, windows, "ts", long=long), ["trip_id", "_day"]),
             "slow_parts": rollup.join_chunks(rollup.slow_chunks(matched), ["trip_id", "_day"])}
    return {k: df.withColumnRenamed("_day", "dt") for k, df in parts.items()}


def touched_trips(lake: Lake, day: date) -> DataFrame:
    """Trips that started on the day or have pings on its event days, with their start."""
    days = event_days(lake, day)
    trips = lake.span("silver", "trips", lake.since(min(days)), max(days))
    ids = trips.where(F.col("start_date") == F.lit(day)).select("trip_id")
    for kind in ("quick_parts", "slow_parts"):
        parts = read_partitions(lake.spark, lake.path("staging", kind), "dt", days)
        ids = ids.unionByName(parts.select("trip_id"))
    return trips.join(ids.distinct(), "trip_id", "left_semi")


def telemetry_day(lake: Lake, day: date) -> int:
    """Store the day's parts, then add up the parts of the trips it touched."""
    match_days(lake, event_days(lake, day))
    touched = cut(touched_trips(lake, day).select("trip_id", "start_date"), "touched-trips")
    since = touched.agg(F.min("start_date")).first()[0] or day

    def parts(kind: str) -> DataFrame:
        return lake.span("staging", kind, since, None).join(touched.select("trip_id"), "trip_id", "left_semi")

    rolled = rollup.outer_join_rollups(rollup.quick_totals(parts("quick_parts")),
                                       rollup.slow_totals(parts("slow_parts")))
    rolled = cut(rolled.join(touched, "trip_id"), "rolled")
    lake.merge("staging", "trip_telemetry_agg", rolled, touched.select("trip_id"))
    return rolled.count()


def staging_day(lake: Lake, day: date) -> int:
    trips = lake.span("silver", "trips", day, day)
    bridge = lake.span("silver", "trip_cargo", day, day)
    agg = rollup.trip_cargo_agg(bridge.drop("start_date"), lake.read("silver", "cargo"))
    lake.merge("staging", "trip_cargo_agg", agg.withColumn("start_date", F.lit(day)), trips.select("trip_id"))
    return trips.count()


def gold_day(lake: Lake, day: date) -> int:
    """Merge the facts of the touched trips; the row count is not reported here."""
    touched = cut(touched_trips(lake, day), "touched-trips")
    first, last = touched.agg(F.min("start_date"), F.max("start_date")).first()
    trips = touched.select("trip_id")
    cargo_agg, telemetry = [
        lake.span("staging", t, first or day, last or day).drop("start_date").join(trips, "trip_id", "left_semi")
        for t in ("trip_cargo_agg", "trip_telemetry_agg")]
    lake.merge("gold", "fct_trip_operations", _fact(touched.drop("start_date"), cargo_agg, telemetry))
    return UNKNOWN_ROWS


DAY_STAGES: dict[str, Callable[[Lake, date], int]] = {
    "bronze": bronze_day,
    "silver": silver_day,
    "telemetry": telemetry_day,
    "staging": staging_day,
    "dbt": gold_day,
}


def daily_run(lake: Lake) -> None:
    """Run each stage for its own next date, in order, then the gate.

    A stage advances only after its work; if one fails, it and the later stages keep their
    dates and the next run repeats them.
    """
    for stage, work in DAY_STAGES.items():
        day = lake.control.target(stage)
        rows = work(lake, day)
        lake.control.advance(stage, day, rows)
    quality.enforce(lake.gate())
