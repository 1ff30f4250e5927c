import random
from datetime import timedelta
from decimal import Decimal

from conftest import t, trips, values
from pyspark.sql import functions as F

from coldhaul.operators import rollup
from coldhaul.operators.asof import match_trips, trip_windows

SLOW = ("vehicle_id bigint, sensor_id string, ts timestamp_ntz, fuel_amount_l double, "
        "is_door_open int, cargo_temp_c double")
QUICK = ("vehicle_id bigint, sensor_id string, ts timestamp_ntz, odometer_km double, rpm double, "
         "throttle_pct double, accel_ay_abs double, battery_v double")


def slow_match(spark, rows, trip_rows, bounds):
    pings = spark.createDataFrame([(v, f"S{i:03}", t(x) if isinstance(x, str) else x, f, d, c)
                                   for i, (v, x, f, d, c) in enumerate(rows)], SLOW)
    b = spark.createDataFrame(bounds, "trip_id bigint, min_temp double, max_temp double")
    windows = rollup.bounded_windows(trip_windows(trips(spark, trip_rows)), b)
    return match_trips(pings, windows, "ts")


def test_fuel_sums_positive_drops(spark):
    rows = [(0, "08:05", 50.0, 0, 5.0), (0, "08:10", 48.0, 1, 5.0), (0, "08:40", 60.0, 1, 5.0),
            (0, "09:50", 57.5, 0, 5.0)]
    m = slow_match(spark, rows, [(1, 0, "08:00", "10:00")], [(1, 2.0, 8.0)])
    r = rollup.slow_rollup(m).first()
    assert (r.total_fuel_consumed_l, r.slow_pings_count, r.door_open_ticks) == (Decimal("4.50"), 4, 2)
    assert [x.prev_fuel for x in rollup.lag_fuel(m).orderBy("ts").collect()] == [None, 50, 48, 60]


def test_fuel_starts_anew_in_the_next_trip(spark):
    rows = [(0, "08:05", 50.0, 0, 5.0), (0, "11:05", 40.0, 0, 5.0), (0, "11:06", 39.0, 0, 5.0)]
    m = slow_match(spark, rows, [(1, 0, "08:00", "10:00"), (2, 0, "11:00", "12:00")], [])
    assert values(rollup.slow_rollup(m), "trip_id", "total_fuel_consumed_l") == [
        (1, Decimal("0.00")), (2, Decimal("1.00"))]


def test_breach_is_strict_and_needs_bounds(spark):
    rows = [(v, f"08:0{i}", 50.0, 0, c) for v in (0, 1) for i, c in enumerate([2.0, 8.0, 8.01, 1.99])]
    m = slow_match(spark, rows, [(1, 0, "08:00", "10:00"), (2, 1, "08:00", "10:00")], [(1, 2.0, 8.0)])
    assert values(rollup.slow_rollup(m), "trip_id", "cargo_breach_ticks") == [(1, 2), (2, 0)]


def test_hot_trip_fuel_equals_brute_force_at_any_chunk(spark):
    rng = random.Random(3)
    start = t("00:00")
    rows = [(0, start + timedelta(seconds=rng.randrange(0, 80000)), rng.randrange(0, 900) / 10, 0, 1.0)
            for _ in range(500)]
    m = slow_match(spark, rows, [(1, 0, "00:00", "23:59")], []).repartition(5)
    ordered = sorted((ts, f"S{i:03}", Decimal(str(f))) for i, (_, ts, f, _, _) in enumerate(rows))
    expected = sum(max(a[2] - b[2], Decimal(0)) for a, b in zip(ordered, ordered[1:]))
    for minutes in (1, 10, 1440):
        assert rollup.slow_rollup(m, minutes).first().total_fuel_consumed_l == expected


def test_thresholds_are_strict(spark):
    limits = [(4200.0, 85.0, 0.75, 11.4), (4201.0, 86.0, 0.76, 11.39)]
    df = spark.createDataFrame([(0, f"S{i}", t(f"08:0{i}"), 10.0 + i, *x) for i, x in enumerate(limits)], QUICK)
    m = match_trips(df, trip_windows(trips(spark, [(1, 0, "08:00", "09:00")])), "ts")
    r = rollup.quick_rollup(m).first()
    assert (r.engine_fault_ticks, r.speeding_ticks, r.drift_ticks, r.battery_fault_ticks) == (1, 1, 1, 1)
    assert (r.quick_pings_count, r.total_distance_km) == (2, Decimal("1.00"))


def test_one_sided_trips_fill_with_zero(spark):
    q = spark.createDataFrame([(0, "S1", t("08:01"), 5.0, 1.0, 1.0, 0.1, 13.0)], QUICK)
    s = spark.createDataFrame([(1, "S2", t("08:01"), 5.0, 1, 3.0)], SLOW)
    b = spark.createDataFrame([], "trip_id bigint, min_temp double, max_temp double")
    out = rollup.trip_telemetry_agg(trips(spark, [(1, 0, "08:00", "09:00"), (2, 1, "08:00", "09:00")]), b, q, s)
    assert values(out, "trip_id", "quick_pings_count", "slow_pings_count", "door_open_ticks") == [
        (1, 1, 0, 0), (2, 0, 1, 1)]


def test_cargo_rollup_rounds_once_and_keeps_cargoless_lines(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 9)], "trip_id bigint, cargo_id bigint")
    cargo = spark.createDataFrame([(1, "Frozen", -18.0, -100.0, 0.285, 1.0), (2, "Chilled", 8.0, 0.0, 0.1, 2.0)],
                                  "cargo_id bigint, cargo_type string, max_temp double, min_temp double, "
                                  "weight_kg double, price_egp double")
    assert values(rollup.trip_cargo_agg(bridge, cargo)) == [
        (1, "Chilled", Decimal("0.39"), Decimal("3.00")), (2, None, None, None)]
    assert values(rollup.trip_thermal_bounds(bridge, cargo)) == [
        (1, -100.0, 8.0, "Chilled"), (2, None, None, None)]
    assert values(rollup.fill_missing_measures(spark.range(1).withColumnRenamed("id", "trip_id")).select(
        F.col("door_open_ticks"), F.col("total_distance_km"))) == [(0, Decimal("0.00"))]


def test_cargo_items_are_not_sorted_for_the_smallest_name(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, None), (None, 1), (2, 2)], "trip_id bigint, cargo_id bigint")
    cargo = spark.createDataFrame([(1, None, 5.0, 1.0, 1.005, 1.0), (2, "Chilled", 8.0, 0.0, 0.1, None)],
                                  "cargo_id bigint, cargo_type string, max_temp double, min_temp double, weight_kg double, price_egp double")
    summary = rollup.trip_cargo_summary(bridge, cargo)
    assert values(rollup.cargo_totals(summary)) == values(rollup.trip_cargo_agg(bridge, cargo)) == [
        (1, "Chilled", Decimal("1.21"), Decimal("1.00")), (2, "Chilled", Decimal("0.10"), None),
        (None, None, Decimal("1.01"), Decimal("1.00"))]
    assert values(rollup.thermal_bounds(summary)) == values(rollup.trip_thermal_bounds(bridge, cargo)) == [
        (1, 0.0, 8.0, "Chilled"), (2, 0.0, 8.0, "Chilled"), (None, 1.0, 5.0, None)]
    for made in (summary, rollup.trip_cargo_agg(bridge, cargo), rollup.trip_thermal_bounds(bridge, cargo)):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        # items are added up by hash; only the rows per trip and type are ordered
        items = plan[plan.rindex("SortAggregate"):] if "SortAggregate" in plan else plan
        assert "HashAggregate(keys=[trip_id" in items and "cargo_type" in items.split("HashAggregate", 1)[1].split("functions", 1)[0]
