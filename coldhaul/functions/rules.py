"""Alert thresholds and the incident rules, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert thresholds.
RPM_FAULT = 4200
THROTTLE_SPEEDING = 85
DRIFT_G = 0.75
BATTERY_LOW = 11.4
FUEL_DROP_FRAUD = 10
DOOR_EDGE_SECONDS = 180
LIVE_FLEET_SIZE = 100
RECENT_WINDOW = "2 minutes"


def engine_fault() -> Column:
    return F.col("rpm") > RPM_FAULT


def speeding() -> Column:
    return F.col("throttle_pct") > THROTTLE_SPEEDING


def drifting() -> Column:
    return F.col("accel_ay_abs") > DRIFT_G


def battery_low() -> Column:
    return F.col("battery_v") < BATTERY_LOW


def tick(flag: Column) -> Column:
    """1 when the flag is true; 0 when false or unknown."""
    return F.when(flag, 1).otherwise(0)


def out_of_bounds(temp: Column, low: Column, high: Column) -> Column:
    """Null bounds never raise a breach."""
    return F.coalesce((temp > high) | (temp < low), F.lit(False))


def mid_route(ts: Column, start: Column, end: Column) -> Column:
    """Strictly more than the edge time after the start and before the end."""
    edge = F.expr(f"INTERVAL {DOOR_EDGE_SECONDS} SECONDS")
    return F.coalesce((ts > start + edge) & (ts < end - edge), F.lit(False))


def _incident(colour: str, kind: str, detail: Column) -> Column:
    return F.struct(F.lit(colour).alias("incident_color"), F.lit(kind).alias("incident_type"),
                    detail.alias("detail"))


def quick_incident_list() -> Column:
    """Zero to two incidents of one quick ping; speeding hides drift."""
    battery = F.when(battery_low(), _incident(
        "BLUE", "BATTERY_LOW",
        F.concat(F.lit("Battery "), F.col("battery_v").cast("string"), F.lit("V"))))
    driving = F.when(speeding(), _incident(
        "YELLOW", "SPEEDING",
        F.concat(F.lit("Throttle "), F.col("throttle_pct").cast("string"), F.lit("%")))
    ).when(drifting(), _incident(
        "YELLOW", "DRIFT", F.concat(F.lit("Lateral G "), F.col("accel_ay_abs").cast("string"))))
    return F.array_compact(F.array(battery, driving))


def slow_incident() -> Column:
    """The first rule that holds for one slow ping, else null.

    Reads ``fuel_drop`` and the trip columns ``trip_id``, ``start_ts``, ``end_ts``,
    ``min_temp``, ``max_temp`` (null without a trip).
    """
    in_trip = F.col("trip_id").isNotNull()
    temp = F.col("cargo_temp_c")
    drop_text = F.round(F.col("fuel_drop"), 1).cast("decimal(18,1)").cast("string")
    return F.when(F.col("fuel_drop") >= FUEL_DROP_FRAUD, _incident(
        "RED", "FUEL_FRAUD", F.concat(F.lit("Fuel siphoned "), drop_text, F.lit("L")))
    ).when((F.col("is_door_open") == 1) & in_trip
           & mid_route(F.col("event_time"), F.col("start_ts"), F.col("end_ts")), _incident(
        "RED", "DOOR_OPEN", F.lit("Cargo door open mid-route"))
    ).when(in_trip & out_of_bounds(temp, F.col("min_temp"), F.col("max_temp")), _incident(
        "ORANGE", "CARGO_BREACH",
        F.concat(F.lit("Temp "), temp.cast("string"), F.lit("C (limit "),
                 F.col("min_temp").cast("string"), F.lit(".."),
                 F.col("max_temp").cast("string"), F.lit(")"))))
