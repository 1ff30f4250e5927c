"""As-of match of sensor pings to trips.

A ping belongs to the trip of its vehicle with the latest start at or before it, unless
that trip had already ended: then it belongs to none, even if an older trip still runs.
Bounding each trip by the start of the next one makes the windows of a vehicle disjoint,
so the match becomes an equality on (vehicle, day) with a range check, and each ping has
at most one partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul.operators.ordered import next_value

#: Windows of more days are laid on the days of their vehicle's pings.
LONG_DAYS = 31


def trip_windows(trips: DataFrame, extras: list[str] | None = None) -> DataFrame:
    """Disjoint trip windows: ``vehicle_id, start_ts, end_ts, next_start, trip_id, *extras``.

    Of trips with equal starts on one vehicle the largest ``trip_id`` stays: in the order
    (start, trip) it is the one whose next start differs from its own.
    """
    dated = (trips.where(F.col("vehicle_id").isNotNull() & F.col("actual_start_time").isNotNull())
             .select("vehicle_id", F.col("actual_start_time").alias("start_ts"),
                     F.col("actual_end_time").alias("end_ts"), "trip_id", *(extras or [])))
    following = next_value(dated, ["vehicle_id"], "start_ts", ["trip_id"], "start_ts", "next_start")
    return following.where(F.col("next_start").isNull() | (F.col("next_start") > F.col("start_ts")))


def window_days(windows: DataFrame, last: Column | None = None) -> DataFrame:
    """One row per window and calendar day it covers, as ``_day``, up to ``last`` if given.

    Windows of a vehicle are disjoint, so this yields at most one row per window plus one
    per vehicle and day. A window may end millennia late; ``last`` bounds it.
    """
    begin, end = F.to_date("start_ts"), F.to_date(F.least("end_ts", "next_start"))
    if last is not None:
        end = F.least(end, last)
    return (windows.where(F.col("end_ts") >= F.col("start_ts")).withColumns({"_begin": begin, "_end": end})
            .where(F.col("_end") >= F.col("_begin"))
            .withColumn("_day", F.explode(F.sequence("_begin", "_end", F.expr("INTERVAL 1 DAY"))))
            .drop("_begin", "_end"))


def any_long(trips: DataFrame) -> bool:
    """Whether a trip, as planned or cut by the next one, takes more than ``LONG_DAYS``: one small job over the trips."""
    cut_trips = "start_ts" in trips.columns
    end = F.least("end_ts", "next_start") if cut_trips else F.col("actual_end_time")
    days = F.datediff(end, F.col("start_ts" if cut_trips else "actual_start_time"))
    return (trips.agg(F.max(days)).first()[0] or 0) > LONG_DAYS


def match_trips(pings: DataFrame, windows: DataFrame, ts: str, how: str = "inner",
                long: bool | None = None) -> DataFrame:
    """Match over the days that the windows cover.

    Windows up to ``LONG_DAYS`` long cover a few days each. A longer one, whose end is most likely wrong, is laid on those
    of its days only that its vehicle has pings on. ``long`` says whether there may be such windows, by :func:`any_long`;
    without them the pings are read once.
    """
    if long is None:
        long = any_long(windows)
    if not long:
        return match_window_days(pings, window_days(windows), ts, how)
    wide = F.coalesce(F.datediff(F.least("end_ts", "next_start"), "start_ts") > LONG_DAYS, F.lit(False))
    longer = windows.where(wide)
    present = (pings.select("vehicle_id", F.to_date(ts).alias("_day")).where("_day IS NOT NULL")
               .join(longer.select("vehicle_id"), "vehicle_id", "left_semi").distinct())
    days = window_days(windows.where(~wide)).unionByName(present_days(longer, present))
    return match_window_days(pings, days, ts, how)


def present_days(windows: DataFrame, present: DataFrame) -> DataFrame:
    """One row per window and day of ``present`` (vehicle_id, _day) that it covers, as ``_day``."""
    covered = F.col("_day").between(F.to_date("start_ts"), F.to_date(F.least("end_ts", "next_start")))
    return (windows.where(F.col("end_ts") >= F.col("start_ts")).join(present, "vehicle_id").where(covered)
            .select(*windows.columns, "_day"))


def match_window_days(pings: DataFrame, days: DataFrame, ts: str, how: str = "inner") -> DataFrame:
    """Attach the active trip's columns, and the ping's day as ``_day``, to each ping.

    The day in the join key spreads a busy vehicle over the days of its history and leaves
    a ping one or two candidate windows. Spark broadcasts the windows when their size is
    under its threshold; above it the join is a shuffle join whose skewed (vehicle, day)
    partitions are split at run time.
    """
    right = days.withColumnsRenamed({"vehicle_id": "_w_vehicle", "_day": "_w_day"})
    active = F.expr(f"""vehicle_id = _w_vehicle AND _day = _w_day AND {ts} >= start_ts
        AND {ts} <= end_ts AND (next_start IS NULL OR {ts} < next_start)""")
    return (pings.withColumn("_day", F.to_date(ts)).join(right, active, how)
            .drop("_w_vehicle", "_w_day"))
