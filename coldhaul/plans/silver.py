"""The clean layer: raw string tables to typed, deduplicated, key-checked tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul.operators.joins import keep_known
from coldhaul.operators.ordered import dedupe_by_key


def _int(name: str) -> Column:
    return F.col(name).try_cast("bigint").alias(name)


def _num(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def _text(name: str) -> Column:
    return F.trim(name).alias(name)


def _time(name: str) -> Column:
    return F.col(name).try_cast("timestamp_ntz").alias(name)


def silver_vehicles(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(raw.select(
        _int("vehicle_id"), _text("model"), _num("payload_capacity"), _num("tank_capacity_l"),
        _text("fuel_type"), _num("current_mileage")), ["vehicle_id"])


def silver_drivers(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(raw.select(
        _int("driver_id"), _text("first_name"), _text("last_name"), _text("license_class"),
        _text("phone_number")), ["driver_id"])


def silver_cargo(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(raw.select(
        _int("cargo_id"), _text("cargo_type"), _num("max_temp"), _num("min_temp"),
        _num("weight_kg"), _num("price_egp")), ["cargo_id"])


def typed_depots(raw: DataFrame) -> DataFrame:
    return raw.select(_int("depot_id"), _text("address"), _text("governorate"), _num("lat"),
                      _num("lon"))


def depot_role(depots: DataFrame, role: str) -> DataFrame:
    """The depot table with every column named for one end of a route."""
    named = {"depot_id": f"{role}_depot_id"}
    named.update({c: f"{role}_{c}" for c in ("address", "governorate", "lat", "lon")})
    return depots.select(*[F.col(old).alias(new) for old, new in named.items()])


def flatten_routes(routes: DataFrame, depots: DataFrame) -> DataFrame:
    ends = ("origin", "destination")
    for role in ends:
        routes = routes.join(depot_role(depots, role), f"{role}_depot_id", "left")
    columns = [f"{role}_{c}" for role in ends
               for c in ("depot_id", "address", "governorate", "lat", "lon")]
    return routes.select("route_id", *columns)


def silver_routes(raw_routes: DataFrame, raw_depots: DataFrame) -> DataFrame:
    """Routes are deduplicated before the joins, so that only single rows are widened."""
    typed = dedupe_by_key(raw_routes.select(
        _int("route_id"), _int("origin_depot_id"), _int("destination_depot_id")), ["route_id"])
    return flatten_routes(typed, dedupe_by_key(typed_depots(raw_depots), ["depot_id"]))


def typed_trips(raw: DataFrame) -> DataFrame:
    return dedupe_by_key(raw.select(
        _int("trip_id"), _int("vehicle_id"), _int("driver_id"), _int("route_id"),
        _time("scheduled_start_time"), _time("scheduled_end_time"),
        _time("actual_start_time"), _time("actual_end_time")), ["trip_id"])


def silver_trips(raw: DataFrame, vehicles: DataFrame, drivers: DataFrame,
                 routes: DataFrame) -> DataFrame:
    return keep_known(typed_trips(raw), {"vehicle_id": vehicles, "driver_id": drivers,
                                         "route_id": routes})


def typed_trip_cargo(raw: DataFrame) -> DataFrame:
    return raw.select(_int("trip_id"), _int("cargo_id"), _text("load_status"))


def silver_trip_cargo(raw: DataFrame, trips: DataFrame, cargo: DataFrame) -> DataFrame:
    return keep_known(typed_trip_cargo(raw), {"trip_id": trips, "cargo_id": cargo})
