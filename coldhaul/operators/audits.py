"""Data profiles and quality counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldhaul.functions.columns import rounded_ratio


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def share_by(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage of all rows per value; the total is a scalar subquery."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", rounded_ratio(F.col("n") * 100, total, 2).alias("share_pct"))


def mixed_cargo_trips(trip_cargo: DataFrame, cargo: DataFrame) -> DataFrame:
    """Trips carrying more than one cargo type."""
    return (trip_cargo.join(cargo, "cargo_id").groupBy("trip_id")
            .agg(F.countDistinct("cargo_type").alias("cargo_types"))
            .where(F.col("cargo_types") > 1))


def double_bookings(trips: DataFrame) -> DataFrame:
    """Rows that repeat a (vehicle, scheduled start), beyond the first."""
    return (trips.groupBy("vehicle_id", "scheduled_start_time")
            .agg((F.count(F.lit(1)) - 1).alias("extra"))
            .agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("double_booked")))


def table_profile(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("row_count"),
                     F.min("scheduled_start_time").alias("first_start"),
                     F.max("scheduled_start_time").alias("last_start"))


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null counts of several columns in one pass, as (column_name, violations)."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "violations")
