"""The business questions over the star.

Measures are summed per surrogate key before a dimension is joined: the shuffle then
carries one row per key and task, a busy driver or route cannot skew the join, and the
join and the second aggregation run on a key-sized table. Questions that sum per key take
the fact, or the sums per key and day of it that ``star.StarStore`` keeps bucketed by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.functions.columns import (
    corridor_label, distance_bin, mileage_bracket, rounded_ratio, severity_code)
from coldhaul.operators.ordered import top_rows

TICK_LIMIT = 50
MINUTES = "decimal(24,6)"
# what the questions sum per surrogate key, over the fact's columns
MEASURES = {
    "driver_key_sk": {"speeding": "speeding_ticks", "drift": "drift_ticks"},
    "vehicle_key_sk": {"battery": "battery_fault_ticks", "engine": "engine_fault_ticks"},
    "route_key_sk": {
        "delay": f"cast(delivery_delay_min AS {MINUTES})", "delays": "cast(delivery_delay_min IS NOT NULL AS int)",
        "lag": f"cast(loading_lag_min AS {MINUTES})", "lags": "cast(loading_lag_min IS NOT NULL AS int)",
        "cost": "fuel_cost_egp", "litres": "total_fuel_consumed_l",
        "revenue": "base_cargo_type_fees + weight_surcharge_fees"},
}


def sums_of(fact: DataFrame, *keys: str) -> DataFrame:
    """Trips and all measures of the first key, per value of the keys."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("trips"), *[
        F.sum(F.expr(m)).alias(n) for n, m in MEASURES[keys[0]].items()])


def _sums(fact: DataFrame, key: str, *measures: str) -> DataFrame:
    if "trips" in fact.columns:
        return fact.groupBy(key).agg(*[F.sum(n).alias(n) for n in ("trips", *measures)])
    return sums_of(fact, key).select(key, "trips", *measures)


def _with_driver(sums: DataFrame, drivers: DataFrame) -> DataFrame:
    return sums.join(drivers.select("driver_sk", "driver_id", "full_name"),
                     sums.driver_key_sk == drivers.driver_sk)


def _with_vehicle(sums: DataFrame, vehicles: DataFrame) -> DataFrame:
    return sums.join(vehicles.select("vehicle_sk", "vehicle_id", "model", "current_mileage"),
                     sums.vehicle_key_sk == vehicles.vehicle_sk)


def _with_route(sums: DataFrame, routes: DataFrame) -> DataFrame:
    return sums.join(routes.select("route_sk", "origin_governorate", "destination_governorate"),
                     sums.route_key_sk == routes.route_sk)


# ---- drivers ----

def _aggressive(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    return _with_driver(_sums(fact, "driver_key_sk", "speeding", "drift"), drivers)


def dangerous_drivers(fact: DataFrame, drivers: DataFrame, limit: int = 5) -> DataFrame:
    totals = (_aggressive(fact, drivers).groupBy("driver_id", "full_name")
              .agg(F.sum("speeding").alias("speeding"), F.sum("drift").alias("drift"))
              .withColumn("aggressive_ticks", F.col("speeding") + F.col("drift")))
    return top_rows(totals, [F.desc("aggressive_ticks"), F.col("driver_id")], limit)


def aggressive_by_name(fact: DataFrame, drivers: DataFrame) -> DataFrame:
    return (_aggressive(fact, drivers).groupBy("full_name")
            .agg(F.sum(F.col("speeding") + F.col("drift")).alias("aggressive_ticks")))


def speeding_vs_engine(fact: DataFrame) -> DataFrame:
    return (fact.where((F.col("speeding_ticks") > 0) | (F.col("engine_fault_ticks") > 0))
            .select("trip_id_bk", "speeding_ticks", "engine_fault_ticks"))


# ---- vehicles ----

def vehicles_at_risk(fact: DataFrame, limit: int = TICK_LIMIT) -> DataFrame:
    """Vehicles with a single trip above the limit."""
    return (fact.where(F.col("battery_fault_ticks") > limit)
            .agg(F.countDistinct("vehicle_key_sk").alias("vehicles_at_risk")))


def risk_list(fact: DataFrame, vehicles: DataFrame, limit: int = TICK_LIMIT) -> DataFrame:
    """Vehicles whose ticks over all trips exceed the limit."""
    return (_with_vehicle(_sums(fact, "vehicle_key_sk", "battery"), vehicles)
            .groupBy("vehicle_id", "model").agg(F.sum("battery").alias("battery_fault_ticks"))
            .where(F.col("battery_fault_ticks") > limit)
            .orderBy(F.desc("battery_fault_ticks"), "vehicle_id"))


def risk_band(fact: DataFrame, limit: int = TICK_LIMIT) -> DataFrame:
    band = F.when(F.col("battery") > limit, "At risk").otherwise("Healthy")
    return (_sums(fact, "vehicle_key_sk", "battery")
            .groupBy(band.alias("risk_band")).agg(F.count(F.lit(1)).alias("vehicles")))


def mileage_wear(fact: DataFrame, vehicles: DataFrame) -> DataFrame:
    ticks, trips = F.sum("engine"), F.sum("trips")
    return (_with_vehicle(_sums(fact, "vehicle_key_sk", "engine"), vehicles)
            .groupBy("model", mileage_bracket("current_mileage").alias("mileage_bracket"))
            .agg(rounded_ratio(ticks, trips, 1).alias("avg_engine_fault_ticks"),
                 (ticks.cast("double") / trips).alias("avg_engine_fault"))
            .orderBy("model", "mileage_bracket"))


# ---- cold chain ----

def breach_by_type(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("cargo_type").isNotNull()).groupBy("cargo_type")
            .agg(F.sum("cargo_breach_ticks").alias("breach_ticks"))
            .orderBy(F.desc("breach_ticks"), "cargo_type"))


def breach_by_distance(fact: DataFrame) -> DataFrame:
    ticks, trips = F.sum("cargo_breach_ticks"), F.count(F.lit(1))
    return (fact.where(F.col("total_distance_km") > 0)
            .groupBy(distance_bin("total_distance_km").alias("distance_bin_km"))
            .agg(rounded_ratio(ticks, trips, 2).alias("avg_breach_ticks"), trips.alias("trips"))
            .orderBy("distance_bin_km"))


# ---- routes ----

def corridors(fact: DataFrame, routes: DataFrame, limit: int | None = 15) -> DataFrame:
    sums = _sums(fact, "route_key_sk", "delay", "delays")
    totals = (_with_route(sums, routes).groupBy("origin_governorate", "destination_governorate")
              .agg(F.sum("trips").alias("trip_volume"),
                   rounded_ratio(F.sum("delay"), F.nullif(F.sum("delays"), F.lit(0)), 1)
                   .alias("avg_delay_min")))
    if limit is None:
        return totals
    return top_rows(totals, [F.desc("trip_volume"), F.col("origin_governorate"),
                             F.col("destination_governorate")], limit)


def loading_lag(fact: DataFrame, routes: DataFrame) -> DataFrame:
    sums = _sums(fact, "route_key_sk", "lag", "lags")
    return (_with_route(sums, routes).groupBy("origin_governorate")
            .agg(rounded_ratio(F.sum("lag"), F.nullif(F.sum("lags"), F.lit(0)), 1)
                 .alias("avg_loading_lag_min"), F.sum("trips").alias("trips"))
            .orderBy(F.desc("avg_loading_lag_min"), "origin_governorate"))


# ---- fuel and finance ----

def fuel_cost_by_governorate(fact: DataFrame, routes: DataFrame) -> DataFrame:
    sums = _sums(fact, "route_key_sk", "cost", "litres")
    return (_with_route(sums, routes).groupBy("origin_governorate")
            .agg(F.round(F.sum("cost"), 0).alias("fuel_cost_egp"),
                 F.round(F.sum("litres"), 0).alias("liters"))
            .orderBy(F.desc("fuel_cost_egp"), "origin_governorate"))


def total_fuel_cost(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("fuel_cost_egp").alias("total_fuel_cost_egp"))


def _profit(fact: DataFrame, routes: DataFrame) -> DataFrame:
    return _with_route(_sums(fact, "route_key_sk", "revenue", "cost"), routes)


def net_profit(fact: DataFrame, routes: DataFrame, limit: int = 15) -> DataFrame:
    revenue, cost = F.sum("revenue"), F.sum("cost")
    totals = (_profit(fact, routes).groupBy("origin_governorate", "destination_governorate")
              .agg(F.round(revenue, 0).alias("revenue_egp"), F.round(cost, 0).alias("fuel_cost_egp"),
                   F.round(revenue - cost, 0).alias("net_profit_egp")))
    return top_rows(totals, [F.desc("net_profit_egp"), F.col("origin_governorate"),
                             F.col("destination_governorate")], limit)


def net_profit_by_corridor(fact: DataFrame, routes: DataFrame) -> DataFrame:
    revenue, cost = F.sum("revenue"), F.sum("cost")
    label = corridor_label("origin_governorate", "destination_governorate")
    return (_profit(fact, routes).groupBy(label.alias("corridor"))
            .agg(revenue.alias("revenue_egp"), cost.alias("fuel_cost_egp"),
                 (revenue - cost).alias("net_profit_egp")))


# ---- live panels ----

def live_map(status: DataFrame) -> DataFrame:
    return status.select("vehicle_id", "lat", "lon", severity_code("incident_color").alias("severity"),
                         "incident_label", "last_event_time")


def live_feed(feed: DataFrame, limit: int = 50) -> DataFrame:
    newest = top_rows(feed, [F.desc_nulls_last("event_time"), F.col("sensor_id"),
                             F.col("incident_type")], limit)
    return newest.select("event_time", "vehicle_id", "incident_color", "incident_type", "detail")


def fleet_ticker(status: DataFrame) -> DataFrame:
    colour = F.col("incident_color")
    return status.agg(
        F.count(F.lit(1)).alias("total_active"),
        F.count_if(colour == "WHITE").alias("nominal"),
        F.count_if(colour.isin("YELLOW", "BLUE")).alias("warnings"),
        F.count_if(colour.isin("RED", "ORANGE")).alias("critical"))


def incidents_by_colour(feed: DataFrame) -> DataFrame:
    return feed.groupBy("incident_color").agg(F.count(F.lit(1)).alias("incidents"))
