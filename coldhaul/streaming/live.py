"""Live rules as DataFrame functions, shared by the streams and by history queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.functions import rules
from coldhaul.functions.columns import reading, severity_code
from coldhaul.operators.asof import match_window_days, trip_windows, window_days
from coldhaul.operators.joins import anti_join_reset, update_from_join
from coldhaul.operators.ordered import latest_by_key, previous_value
from coldhaul.operators.rollup import bounded_trips, fuel_drop, trip_thermal_bounds

EXTRAS = ["driver_id", "cargo_type", "min_temp", "max_temp"]


def live_windows(trips: DataFrame, trip_cargo: DataFrame, cargo: DataFrame,
                 fleet_size: int | None = None) -> DataFrame:
    """Active-trip windows by day, with driver, cargo type and bounds.

    Half-dated trips are skipped. Windows reach to tomorrow at most: a live message is not stamped later.
    """
    if fleet_size is not None:
        trips = trips.where(F.col("vehicle_id") < fleet_size)
    dated = trips.where(F.col("actual_end_time").isNotNull())
    bounded = bounded_trips(dated, trip_thermal_bounds(trip_cargo, cargo))
    return window_days(trip_windows(bounded, EXTRAS), last=F.date_add(F.current_date(), 1))


def attach_trip(pings: DataFrame, days: DataFrame) -> DataFrame:
    """Every ping stays; without an active trip its trip columns are null.

    ``days`` are the windows by day, see :func:`coldhaul.operators.asof.window_days`.
    """
    return match_window_days(pings, days, "event_time", "left")


def quick_incidents(pings: DataFrame, days: DataFrame) -> DataFrame:
    """Only pings that raise something reach the trip lookup."""
    raised = pings.withColumn("i", F.explode(rules.quick_incident_list())).select("*", "i.*")
    return attach_trip(raised, days).select(*schemas.INCIDENT_COLUMNS)


def slow_incidents(pings: DataFrame, days: DataFrame) -> DataFrame:
    """At most one incident per ping that carries its ``fuel_drop``."""
    found = attach_trip(pings, days).withColumn("i", rules.slow_incident())
    return (found.where(F.col("i").isNotNull()).select("*", "i.*")
            .withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
            .select(*schemas.INCIDENT_COLUMNS))


def _with_previous(pings: DataFrame) -> DataFrame:
    return previous_value(pings.withColumn("fuel", reading("fuel_amount_l")), ["vehicle_id"],
                          "event_time", ["sensor_id"], "fuel", "prev_fuel")


def fuel_drop_batch(pings: DataFrame) -> DataFrame:
    """The fuel drop of each ping against the vehicle's previous reading, over history."""
    return _with_previous(pings).withColumn("fuel_drop", fuel_drop(F.col("prev_fuel"), F.col("fuel")))


def fuel_drop_step(pings: DataFrame, state: DataFrame) -> DataFrame:
    """The same for one micro-batch, whose first reading per vehicle looks into the state."""
    known = state.select("vehicle_id", F.col("last_fuel_l").alias("_state"))
    return (_with_previous(pings).join(known, "vehicle_id", "left")
            .withColumn("prev_fuel", F.coalesce("prev_fuel", "_state")).drop("_state")
            .withColumn("fuel_drop", fuel_drop(F.col("prev_fuel"), F.col("fuel"))))


def last_fuel(pings: DataFrame) -> DataFrame:
    """The last reading of each vehicle of a micro-batch."""
    return latest_by_key(pings.select(
        "vehicle_id", reading("fuel_amount_l").alias("last_fuel_l"),
        F.col("event_time").alias("last_event_time"), "sensor_id"),
        "vehicle_id", ["last_event_time", "sensor_id"]).drop("sensor_id")


def position_state(pings: DataFrame) -> DataFrame:
    """The last position of each vehicle; on a stream, Spark keeps it and a batch yields the vehicles that it moved.

    The latest event time wins, not the last arrival. A ping without a position counts if there is none with one, and its
    time does not.
    """
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    found = F.struct("lat", "lon", F.when(placed, F.col("event_time")).alias("last_event_time"))
    return pings.groupBy("vehicle_id").agg(
        F.max_by(found, F.struct(placed, "event_time", "sensor_id")).alias("p")).select("vehicle_id", "p.*")


def latest_position(pings: DataFrame) -> DataFrame:
    return latest_by_key(pings.select("vehicle_id", "lat", "lon", "event_time", "sensor_id"),
                         "vehicle_id", ["event_time", "sensor_id"])


def recent(feed: DataFrame, as_of: Column, window: str = rules.RECENT_WINDOW) -> DataFrame:
    """Incidents detected within the window; a feed by date is read from the window's first date on."""
    since = as_of - F.expr(f"INTERVAL {window}")
    if "detected_date" in feed.columns:
        feed = feed.where(F.col("detected_date") >= F.to_date(since))
    return feed.where(F.col("detected_at") > since)


def highest_severity(feed: DataFrame) -> DataFrame:
    """The worst incident per vehicle, the newest among equals."""
    ranked = feed.select("vehicle_id", severity_code("incident_color").alias("severity"),
                         "event_time", "incident_type", "sensor_id", "incident_color")
    return latest_by_key(ranked, "vehicle_id",
                         ["severity", "event_time", "incident_type", "sensor_id"])


def refresh_colours(status: DataFrame, feed: DataFrame, as_of: Column,
                    window: str = rules.RECENT_WINDOW) -> DataFrame:
    """Recolour from recent incidents; vehicles without one become WHITE / OK."""
    return coloured(status, highest_severity(recent(feed, as_of, window)))


def coloured(status: DataFrame, worst: DataFrame) -> DataFrame:
    """The status by the worst recent incident of each vehicle."""
    busy = update_from_join(status, worst).join(worst.select("vehicle_id"), "vehicle_id", "left_semi")
    return busy.unionByName(anti_join_reset(status, worst))


def vehicle_status(positions: DataFrame, feed: DataFrame, as_of: Column,
                   window: str = rules.RECENT_WINDOW) -> DataFrame:
    """Current status of all vehicles from their last positions and the incident feed.

    One left join does both halves of :func:`refresh_colours`.
    """
    blank = positions.select(
        "vehicle_id", "lat", "lon", F.col("event_time").alias("last_event_time"),
        F.lit("WHITE").alias("incident_color"), F.lit("OK").alias("incident_label"))
    return update_from_join(blank, highest_severity(recent(feed, as_of, window)))


def incident_feed(quick: DataFrame, slow: DataFrame) -> DataFrame:
    return quick.unionByName(slow, allowMissingColumns=True)
