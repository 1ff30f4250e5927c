"""Declared schemas of every table; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "double": T.DoubleType(), "timestamp": T.TimestampType(),
          "timestamp_ntz": T.TimestampNTZType()}


def typed(**columns: str) -> T.StructType:
    """A schema from column names and type names."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in columns.items()])


RAW_COLUMNS = {
    "vehicles": ["vehicle_id", "model", "payload_capacity", "tank_capacity_l", "fuel_type",
                 "current_mileage"],
    "drivers": ["driver_id", "first_name", "last_name", "license_class", "phone_number"],
    "cargo": ["cargo_id", "cargo_type", "max_temp", "min_temp", "weight_kg", "price_egp"],
    "depots": ["depot_id", "address", "governorate", "lat", "lon", "vehicles_capacity"],
    "routes": ["route_id", "origin_depot_id", "destination_depot_id"],
    "trips": ["trip_id", "vehicle_id", "driver_id", "route_id", "scheduled_start_time",
              "scheduled_end_time", "actual_start_time", "actual_end_time"],
    "trip_cargo": ["trip_id", "cargo_id", "load_status"],
}

QUICK_COLUMNS = ["vehicle_id", "sensor_id", "timestamp", "lat", "lon", "odometer_km", "rpm",
                 "throttle_pct", "accel_ay_abs", "battery_v"]
SLOW_COLUMNS = ["vehicle_id", "sensor_id", "timestamp", "fuel_amount_l", "is_door_open",
                "cargo_temp_c"]

RAW = {name: strings(*cols) for name, cols in RAW_COLUMNS.items()}
QUICK_JSON = strings(*QUICK_COLUMNS)
SLOW_JSON = strings(*SLOW_COLUMNS)

MESSAGE = typed(key="string", value="string", topic="string", timestamp="timestamp_ntz")
ENVELOPE = typed(kafka_key="string", raw_json="string", topic="string", kafka_ts="timestamp_ntz",
                 ingestion_ts="timestamp")

TELEMETRY_COUNTERS = ["quick_pings_count", "slow_pings_count", "engine_fault_ticks",
                      "speeding_ticks", "drift_ticks", "battery_fault_ticks",
                      "door_open_ticks", "cargo_breach_ticks"]
TELEMETRY_MEASURES = ["total_fuel_consumed_l", "total_distance_km"]
TELEMETRY_COLUMNS = ["trip_id", *TELEMETRY_COUNTERS, *TELEMETRY_MEASURES]

INCIDENT_COLUMNS = ["vehicle_id", "trip_id", "driver_id", "event_time", "incident_color",
                    "incident_type", "detail", "lat", "lon", "sensor_id"]

CHECKPOINTS = T.StructType([
    T.StructField("stage_name", T.StringType(), False),
    T.StructField("last_processed_date", T.DateType(), False),
    T.StructField("last_run_at", T.TimestampNTZType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("status", T.StringType()),
])
