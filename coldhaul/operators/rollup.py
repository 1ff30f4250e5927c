"""Per-trip aggregates over cargo and telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.functions import rules
from coldhaul.functions.columns import AMOUNT, amount, reading
from coldhaul.operators.asof import any_long, match_trips, trip_windows
from coldhaul.operators.ordered import previous_value, time_chunk

FUEL_CHUNK_MINUTES = 10
LITRES = "decimal(28,6)"


CARRIED = {"weight_kg": F.sum, "price_egp": F.sum}
BOUNDS = {"min_temp": F.min, "max_temp": F.max}


def trip_cargo_summary(trip_cargo: DataFrame, cargo: DataFrame, measures: dict = CARRIED | BOUNDS) -> DataFrame:
    """Per trip: the smallest type name of its cargo, and its measures.

    Items are gathered per trip and type first, by hash and map-side: the minimum of names alone would sort them all.
    """
    known = cargo.select("cargo_id", "cargo_type", *[
        reading(c).alias(c) if c in CARRIED else c for c in measures])
    per_type = trip_cargo.join(known, "cargo_id", "left").groupBy("trip_id", "cargo_type").agg(
        *[of(c).alias(c) for c, of in measures.items()])
    return per_type.groupBy("trip_id").agg(
        F.min("cargo_type").alias("cargo_type"), *[of(c).alias(c) for c, of in measures.items()])


def cargo_totals(summary: DataFrame) -> DataFrame:
    """Per trip: the smallest cargo type name, total weight and value."""
    return summary.select("trip_id", "cargo_type", amount(F.col("weight_kg")).alias("total_cargo_weight_kg"),
                          amount(F.col("price_egp")).alias("total_cargo_value_egp"))


def thermal_bounds(summary: DataFrame) -> DataFrame:
    """Per trip: lowest minimum, highest maximum and smallest type name of its cargo."""
    return summary.select("trip_id", "min_temp", "max_temp", "cargo_type")


def trip_cargo_agg(trip_cargo: DataFrame, cargo: DataFrame) -> DataFrame:
    return cargo_totals(trip_cargo_summary(trip_cargo, cargo, CARRIED))


def trip_thermal_bounds(trip_cargo: DataFrame, cargo: DataFrame) -> DataFrame:
    return thermal_bounds(trip_cargo_summary(trip_cargo, cargo, BOUNDS))


def bounded_trips(trips: DataFrame, bounds: DataFrame) -> DataFrame:
    return trips.join(bounds, "trip_id", "left")


def quick_flags(pings: DataFrame) -> DataFrame:
    return pings.withColumns({
        "engine_fault": rules.tick(rules.engine_fault()),
        "speeding": rules.tick(rules.speeding()),
        "drift": rules.tick(rules.drifting()),
        "battery_fault": rules.tick(rules.battery_low()),
    })


def quick_parts(matched: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, tick totals and odometer range per group; all partial sums combine map-side."""
    odometer = reading("odometer_km")
    return quick_flags(matched).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("quick_pings_count"),
        F.sum("engine_fault").alias("engine_fault_ticks"),
        F.sum("speeding").alias("speeding_ticks"),
        F.sum("drift").alias("drift_ticks"),
        F.sum("battery_fault").alias("battery_fault_ticks"),
        F.min(odometer).alias("first_km"), F.max(odometer).alias("last_km"))


def quick_totals(parts: DataFrame) -> DataFrame:
    """Parts of a trip added up, with the odometer span as its distance."""
    sums = ["quick_pings_count", "engine_fault_ticks", "speeding_ticks", "drift_ticks",
            "battery_fault_ticks"]
    return parts.groupBy("trip_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        amount(F.max("last_km") - F.min("first_km")).alias("total_distance_km"))


def quick_rollup(matched: DataFrame) -> DataFrame:
    return quick_totals(quick_parts(matched, ["trip_id"]))


def breach_flags(matched: DataFrame) -> DataFrame:
    return matched.withColumn("breach", rules.tick(rules.out_of_bounds(
        F.col("cargo_temp_c"), F.col("min_temp"), F.col("max_temp"))))


def lag_fuel(matched: DataFrame) -> DataFrame:
    """Each slow ping with the previous fuel reading of its trip."""
    return previous_value(matched.withColumn("fuel", reading("fuel_amount_l")),
                          ["trip_id"], "ts", ["sensor_id"], "fuel", "prev_fuel")


def fuel_drop(prev, cur):
    """A positive drop; a refuel or a missing reading counts as 0."""
    return F.coalesce(F.greatest(prev - cur, F.lit(0)), F.lit(0))


def slow_chunks(matched: DataFrame, minutes: int = FUEL_CHUNK_MINUTES) -> DataFrame:
    """Counts, ticks, litres and the first and last reading per (trip, time chunk).

    Fuel needs the order of readings, so the window runs inside a chunk and no task sorts a
    whole trip's pings. A chunk lies within one vehicle and day: after a shuffle join on
    those the window needs no further shuffle of the pings.
    """
    keys = ["vehicle_id", "_day", "trip_id", "_chunk"]
    chunked = (breach_flags(matched)
               .withColumn("fuel", reading("fuel_amount_l"))
               .withColumn("_chunk", time_chunk("ts", minutes)))
    inside = Window.partitionBy(*keys).orderBy("ts", "sensor_id")
    return (chunked
            .withColumns({"_drop": fuel_drop(F.lag("fuel").over(inside), F.col("fuel")), **_ends(inside)})
            .groupBy(*keys).agg(
                F.count(F.lit(1)).alias("pings"),
                F.sum("is_door_open").alias("door"),
                F.sum("breach").alias("breach"),
                F.sum("_drop").cast(LITRES).alias("drop"),
                F.max(F.when(F.col("_first"), F.col("fuel"))).alias("first_fuel"),
                F.max(F.when(F.col("_last"), F.col("fuel"))).alias("last_fuel")))


def join_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Merge consecutive chunks of a group into one, adding the drops between them."""
    across = Window.partitionBy(*keys).orderBy("_chunk")
    between = fuel_drop(F.lag("last_fuel").over(across), F.col("first_fuel"))
    return (chunks.withColumns({"_between": between, **_ends(across)})
            .groupBy(*keys).agg(
                F.min("_chunk").alias("_chunk"),
                F.sum("pings").alias("pings"),
                F.sum("door").alias("door"),
                F.sum("breach").alias("breach"),
                F.sum(F.col("drop") + F.col("_between")).cast(LITRES).alias("drop"),
                F.max(F.when(F.col("_first"), F.col("first_fuel"))).alias("first_fuel"),
                F.max(F.when(F.col("_last"), F.col("last_fuel"))).alias("last_fuel")))


def _ends(window) -> dict[str, Column]:
    """Flags of the first and last row of a window."""
    return {"_first": F.lag(F.lit(True)).over(window).isNull(),
            "_last": F.lead(F.lit(True)).over(window).isNull()}


def slow_totals(chunks: DataFrame) -> DataFrame:
    return join_chunks(chunks, ["trip_id"]).select(
        "trip_id",
        F.col("pings").alias("slow_pings_count"),
        F.coalesce("door", F.lit(0)).cast("bigint").alias("door_open_ticks"),
        F.col("breach").alias("cargo_breach_ticks"),
        amount(F.col("drop")).alias("total_fuel_consumed_l"))


def slow_rollup(matched: DataFrame, minutes: int = FUEL_CHUNK_MINUTES) -> DataFrame:
    """Counts, door and breach ticks and litres consumed per trip."""
    return slow_totals(slow_chunks(matched, minutes))


def fill_missing_measures(df: DataFrame) -> DataFrame:
    """Add absent telemetry columns and turn nulls into 0, with fixed types and order."""
    def column(name: str, kind: str):
        value = F.col(name) if name in df.columns else F.lit(0)
        return F.coalesce(value.cast(kind), F.lit(0).cast(kind)).alias(name)

    return df.select(
        "trip_id",
        *[column(c, "bigint") for c in schemas.TELEMETRY_COUNTERS],
        *[column(c, AMOUNT) for c in schemas.TELEMETRY_MEASURES])


def outer_join_rollups(quick: DataFrame, slow: DataFrame) -> DataFrame:
    """Both rollups are already partitioned by trip, so the join adds no shuffle."""
    return fill_missing_measures(quick.join(slow, "trip_id", "full_outer"))


def bounded_windows(windows: DataFrame, bounds: DataFrame) -> DataFrame:
    return windows.join(bounds.select("trip_id", "min_temp", "max_temp"), "trip_id", "left")


def trip_telemetry_agg(trips: DataFrame, bounds: DataFrame, quick: DataFrame,
                       slow: DataFrame) -> DataFrame:
    """Both topics are matched to the same windows, whose shuffles Spark then reuses."""
    windows, long = trip_windows(trips), any_long(trips)
    quick_part = quick_rollup(match_trips(quick, windows, "ts", long=long))
    slow_part = slow_rollup(match_trips(slow, bounded_windows(windows, bounds), "ts", long=long))
    return outer_join_rollups(quick_part, slow_part)
