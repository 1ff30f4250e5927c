"""The driver's benchmark tables, read as fleet tables.

Every table is derived by a formula from whole driver tables; ``checks/oracle.py`` states
the same formulas in SQL. ``FleetData`` gives the typed tables, ``RawFleetData`` the
string tables of the landing layer with malformed values, blanks and repeated keys.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.operators.joins import decode_routes
from coldhaul.streaming.messages import json_payload

DEPOTS = 25
EPOCH = "timestamp_ntz'2024-01-01 00:00:00'"
ORDERS_PER_TRIP = 20
QUICK_EVENTS = ["click", "view", "error"]
SLOW_EVENTS = ["purchase", "signup"]

# Cargo types and their thermal bounds.
CARGO_TYPES = ["Controlled ambient", "Chilled", "Frozen", "Pharmaceutical", "Deep frozen", "Other"]
MIN_TEMP = {"Controlled ambient": 8.0, "Chilled": 0.0, "Frozen": -100.0, "Pharmaceutical": 2.0,
            "Deep frozen": -1000.0, "Other": 0.0}
MAX_TEMP = {"Controlled ambient": 15.0, "Chilled": 8.0, "Frozen": -18.0, "Pharmaceutical": 8.0,
            "Deep frozen": -40.0, "Other": 25.0}


def _once(method):
    """Build each plan once per instance; nothing is cached but the plan."""
    @functools.wraps(method)
    def plan(self):
        if method.__name__ not in self.plans:
            self.plans[method.__name__] = method(self)
        return self.plans[method.__name__]
    return plan


def _minutes(expr: str) -> Column:
    return F.expr(f"make_dt_interval(0, 0, cast({expr} as int), 0)")


# The driver columns in use; declaring them spares a job per read to infer them.
DRIVER_TABLES = {
    "orders": schemas.typed(o_orderkey="bigint", o_custkey="bigint", o_totalprice="double"),
    "lineitem": schemas.typed(l_orderkey="bigint", l_partkey="bigint", l_returnflag="string",
                              l_linestatus="string"),
    "part": schemas.typed(p_partkey="bigint", p_size="int", p_retailprice="double"),
    "customer": schemas.typed(c_custkey="bigint", c_acctbal="double", c_mktsegment="string"),
    "supplier": schemas.typed(s_suppkey="bigint"),
    "nation": schemas.typed(n_nationkey="int", n_name="string", n_regionkey="int"),
    "region": schemas.typed(r_regionkey="int", r_name="string"),
    "events": schemas.typed(event_id="bigint", ts="timestamp_ntz", user_id="bigint",
                            event_type="string", value="double", props="string"),
}


class FleetData:
    """Typed fleet tables over the parquet files of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.plans: dict[str, DataFrame] = {}

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(DRIVER_TABLES[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    @_once
    def trips(self) -> DataFrame:
        """One trip per group of consecutive orders."""
        first = (self.read("orders")
                 .groupBy(F.expr(f"o_orderkey div {ORDERS_PER_TRIP}").alias("trip_id"))
                 .agg(F.min_by("o_custkey", "o_orderkey").alias("cust")))
        keyed = first.select(
            "trip_id",
            F.expr("cust div 10").alias("vehicle_id"),
            F.expr("cust div 14").alias("driver_id"),
            F.expr("(trip_id * 7) % 600").alias("route_id"))
        timed = keyed.withColumn("actual_start_time", F.expr(EPOCH) + _minutes(
            "(trip_id * 7919) % 180 * 240 + vehicle_id % 240"))
        timed = timed.withColumn("actual_end_time", F.col("actual_start_time") + _minutes(
            "1440 + (trip_id * 257) % 5820"))
        return timed.select(
            "trip_id", "vehicle_id", "driver_id", "route_id",
            (F.col("actual_start_time") - _minutes("trip_id % 96 * 60")).alias("scheduled_start_time"),
            (F.col("actual_end_time") - _minutes("((trip_id * 11) % 120 - 24) * 60")).alias("scheduled_end_time"),
            "actual_start_time", "actual_end_time")

    @_once
    def vehicles(self) -> DataFrame:
        """One vehicle per group of ten customers, described by the first of them."""
        first = (self.read("customer").groupBy(F.expr("c_custkey div 10").alias("vehicle_id"))
                 .agg(F.min_by("c_mktsegment", "c_custkey").alias("model"),
                      F.min_by("c_acctbal", "c_custkey").alias("balance"),
                      F.count(F.lit(1)).alias("members")))
        return first.select(
            "vehicle_id", "model",
            (F.col("members") * 150).cast("double").alias("payload_capacity"),
            (F.col("vehicle_id") % 16 + 70).cast("double").alias("tank_capacity_l"),
            F.when(F.col("vehicle_id") % 4 == 0, "Petrol").otherwise("Diesel").alias("fuel_type"),
            (F.abs("balance") * 40).alias("current_mileage"))

    @_once
    def drivers(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.read("supplier").select(
            key.alias("driver_id"),
            F.concat(F.lit("F"), (key % 7).cast("string")).alias("first_name"),
            F.concat(F.lit("L"), (key % 5).cast("string")).alias("last_name"),
            F.concat(F.lit("C"), (key % 3).cast("string")).alias("license_class"),
            F.concat(F.lit("0"), (key + 1000000000).cast("string")).alias("phone_number"))

    @_once
    def cargo(self) -> DataFrame:
        def pick(value) -> Column:
            return F.element_at(F.array(*[F.lit(value(k)) for k in CARGO_TYPES]),
                                (F.col("p_partkey") % 6 + 1).cast("int"))

        return self.read("part").select(
            F.col("p_partkey").alias("cargo_id"), pick(str).alias("cargo_type"),
            pick(MAX_TEMP.get).alias("max_temp"), pick(MIN_TEMP.get).alias("min_temp"),
            (F.col("p_size") * 3 / F.lit(10.0)).alias("weight_kg"),
            F.col("p_retailprice").alias("price_egp"))

    @_once
    def depots(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        key = F.col("n_nationkey")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            key.cast("bigint").alias("depot_id"),
            F.concat(F.col("n_name"), F.lit(", Dock "), key.cast("string")).alias("address"),
            F.col("r_name").alias("governorate"),
            (key * 4 / F.lit(10.0) + 22).alias("lat"),
            ((key * 7) % 25 / F.lit(2.0) + 25).alias("lon"))

    @_once
    def route_ids(self) -> DataFrame:
        return self.trips().select("route_id").distinct()

    @_once
    def route_pairs(self) -> DataFrame:
        return decode_routes(self.route_ids(), DEPOTS)

    @_once
    def trip_cargo(self) -> DataFrame:
        """Whole lineitem. Most trips carry one cargo type, some mix types, some carry none."""
        item = self.read("lineitem").select(
            F.expr(f"l_orderkey div {ORDERS_PER_TRIP}").alias("t"), "l_partkey", "l_linestatus",
            "l_returnflag")
        typed = F.col("l_partkey") - F.col("l_partkey") % 6 + F.col("t") % 6
        return item.select(
            (F.col("t") + F.when(F.col("t") % 40 == 7, 1).otherwise(0)).alias("trip_id"),
            F.when(F.col("t") % 4 == 1, F.col("l_partkey")).otherwise(typed).alias("cargo_id"),
            F.when(F.col("l_linestatus") == "O", "In Transit")
            .when(F.col("l_returnflag") == "R", "Loaded").otherwise("Delivered").alias("load_status"))

    def _events(self, kinds: list[str]) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return (self.read("events").where(F.col("event_type").isin(kinds))
                .select(F.col("user_id").alias("vehicle_id"),
                        F.concat(F.lit("S"), F.col("event_id").cast("string")).alias("sensor_id"),
                        "ts", "event_id", "value", k.alias("k")))

    @_once
    def quick(self) -> DataFrame:
        seconds = F.timestamp_diff("SECOND", F.expr(EPOCH), F.col("ts"))
        return self._events(QUICK_EVENTS).select(
            "vehicle_id", "sensor_id", "ts",
            (F.col("k") / F.lit(10.0) + 22).alias("lat"),
            (F.col("event_id") % 100 / F.lit(10.0) + 25).alias("lon"),
            (F.floor(seconds * 10 / 9) / F.lit(100.0)).alias("odometer_km"),
            (F.col("value") * 40 + 1000).alias("rpm"),
            F.col("k").cast("double").alias("throttle_pct"),
            (F.col("value") / 100).alias("accel_ay_abs"),
            ((F.lit(1400) - F.col("k") * 3) / F.lit(100.0)).alias("battery_v"))

    @_once
    def slow(self) -> DataFrame:
        return self._events(SLOW_EVENTS).select(
            "vehicle_id", "sensor_id", "ts", F.col("value").alias("fuel_amount_l"),
            F.when(F.col("k") % 10 == 0, 1).otherwise(0).alias("is_door_open"),
            (F.col("value") / 10).alias("cargo_temp_c"))


def _text_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


class RawFleetData:
    """The landing layer: every column a string, with dirt to clean."""

    def __init__(self, fleet: FleetData):
        self.fleet = fleet

    @staticmethod
    def _repeat(df: DataFrame, repeated: Column) -> DataFrame:
        """Add a second copy, marked ``copy = 1``, of the rows where ``repeated`` holds."""
        copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return df.withColumn("copy", F.explode(copies))

    @staticmethod
    def _as_strings(df: DataFrame, table: str) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in schemas.RAW_COLUMNS[table]])

    def vehicles(self) -> DataFrame:
        df = self._repeat(self.fleet.vehicles(), F.col("vehicle_id") % 5 == 0)
        return self._as_strings(df.withColumns({
            "model": F.concat(F.lit("  "), F.col("model"),
                              F.when(F.col("copy") == 1, " II ").otherwise(" ")),
            "current_mileage": F.when(F.col("vehicle_id") % 7 == 0, F.lit("n/a"))
            .otherwise(F.col("current_mileage").cast("string"))}), "vehicles")

    def drivers(self) -> DataFrame:
        df = self._repeat(self.fleet.drivers(), F.col("driver_id") % 6 == 0)
        return self._as_strings(df.withColumns({
            "first_name": F.concat(F.lit(" "), F.col("first_name")),
            "last_name": F.concat(F.col("last_name"), F.lit("  ")),
            "license_class": F.when(F.col("copy") == 1, F.lit(None))
            .otherwise(F.col("license_class"))}), "drivers")

    def cargo(self) -> DataFrame:
        df = self._repeat(self.fleet.cargo(), F.col("cargo_id") % 8 == 0)
        return self._as_strings(df.withColumns({
            "cargo_type": F.concat(F.lit(" "), F.col("cargo_type")),
            "weight_kg": F.when(F.col("cargo_id") % 50 == 3, F.lit("heavy"))
            .otherwise(F.col("weight_kg").cast("string"))}), "cargo")

    def depots(self) -> DataFrame:
        return self._as_strings(self.fleet.depots().withColumns({
            "address": F.concat(F.lit(" "), F.col("address")),
            "vehicles_capacity": F.lit("40")}), "depots")

    def routes(self) -> DataFrame:
        df = self._repeat(self.fleet.route_pairs(), F.col("route_id") % 9 == 0)
        return self._as_strings(df, "routes")

    def trips(self) -> DataFrame:
        df = self._repeat(self.fleet.trips(), F.col("trip_id") % 9 == 0)
        return self._as_strings(df.select(
            "trip_id",
            F.when(F.col("trip_id") % 37 == 5, F.lit("x"))
            .otherwise(F.col("vehicle_id").cast("string")).alias("vehicle_id"),
            "driver_id", "route_id",
            _text_time("scheduled_start_time"), _text_time("scheduled_end_time"),
            _text_time("actual_start_time"),
            F.when(F.col("trip_id") % 31 == 4, F.lit("soon"))
            .otherwise(F.date_format("actual_end_time", "yyyy-MM-dd HH:mm:ss"))
            .alias("actual_end_time")), "trips")

    def trip_cargo(self) -> DataFrame:
        return self._as_strings(self.fleet.trip_cargo().withColumn(
            "load_status", F.concat(F.lit(" "), F.col("load_status"), F.lit(" "))), "trip_cargo")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def quick_messages(self) -> DataFrame:
        return _messages(self.fleet.quick(), schemas.QUICK_COLUMNS, "vehicle.quick.sensors")

    def slow_messages(self) -> DataFrame:
        return _messages(self.fleet.slow(), schemas.SLOW_COLUMNS, "vehicle.slow.sensors")


def _messages(pings: DataFrame, columns: list[str], topic: str) -> DataFrame:
    named = pings.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return json_payload(named, columns).select(
        "key", "value", F.lit(topic).alias("topic"), F.col("ts").alias("timestamp"))
