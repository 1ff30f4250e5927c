"""The star schema: dimensions, calendar and the trip fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.functions import columns as c

# The calendar's span.
CALENDAR = (date(2022, 1, 1), date(2025, 12, 31))

FACT_COLUMNS = [
    "trip_sk", "trip_id_bk", "vehicle_key_sk", "driver_key_sk", "route_key_sk",
    "start_date_key_sk", "cargo_type", "total_distance_km", "quick_pings_count",
    "slow_pings_count", "engine_fault_ticks", "speeding_ticks", "drift_ticks",
    "battery_fault_ticks", "door_open_ticks", "cargo_breach_ticks", "delivery_delay_min",
    "loading_lag_min", "total_fuel_consumed_l", "fuel_cost_egp", "total_cargo_weight_kg",
    "total_cargo_value_egp", "base_cargo_type_fees", "weight_surcharge_fees",
    "total_trip_cost_egp",
]


def dim_vehicles(vehicles: DataFrame) -> DataFrame:
    return vehicles.select(
        c.surrogate_key("vehicle_id").alias("vehicle_sk"), "vehicle_id", "model",
        "payload_capacity", "tank_capacity_l", "fuel_type", "current_mileage")


def dim_drivers(drivers: DataFrame) -> DataFrame:
    return drivers.select(
        c.surrogate_key("driver_id").alias("driver_sk"), "driver_id", "first_name", "last_name",
        c.full_name("first_name", "last_name").alias("full_name"), "license_class",
        "phone_number")


def dim_routes(routes: DataFrame) -> DataFrame:
    return routes.select(c.surrogate_key("route_id").alias("route_sk"), *routes.columns)


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row ``(first_day, last_day)`` table."""
    days = bounds.select(F.explode(F.sequence(
        "first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.select(*[col.alias(name) for name, col in c.calendar_parts("day").items()])


def dim_date(spark: SparkSession, first: date = CALENDAR[0], last: date = CALENDAR[1]) -> DataFrame:
    return calendar(spark.createDataFrame([(first, last)], "first_day date, last_day date"))


def join_trip_inputs(trips: DataFrame, cargo_agg: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Trips with their two per-trip rollups; missing measures become 0."""
    measures = [*schemas.TELEMETRY_COUNTERS, *schemas.TELEMETRY_MEASURES,
                "total_cargo_weight_kg", "total_cargo_value_egp"]
    joined = trips.join(cargo_agg, "trip_id", "left").join(telemetry, "trip_id", "left")
    return joined.withColumns({m: F.coalesce(m, F.lit(0).cast(joined.schema[m].dataType))
                               for m in measures})


def fct_trip_operations(joined: DataFrame) -> DataFrame:
    litres, kg, kind = "total_fuel_consumed_l", "total_cargo_weight_kg", "cargo_type"
    derived: dict[str, Column] = {
        "trip_sk": c.surrogate_key("trip_id"),
        "trip_id_bk": F.col("trip_id"),
        "vehicle_key_sk": c.surrogate_key("vehicle_id"),
        "driver_key_sk": c.surrogate_key("driver_id"),
        "route_key_sk": c.surrogate_key("route_id"),
        "start_date_key_sk": c.date_key("actual_start_time"),
        "delivery_delay_min": c.minutes_between("scheduled_end_time", "actual_end_time"),
        "loading_lag_min": c.minutes_between("scheduled_start_time", "actual_start_time"),
        "fuel_cost_egp": c.fuel_cost(litres),
        "base_cargo_type_fees": c.base_fee(kind),
        "weight_surcharge_fees": c.weight_surcharge(kg),
        "total_trip_cost_egp": c.total_trip_cost(litres, kind, kg),
    }
    return joined.select(*[derived.get(name, F.col(name)).alias(name) for name in FACT_COLUMNS])
