"""Daily runs against a full rebuild: late and undated rows, corrected trips, dirty numbers."""

from datetime import date, timedelta

import pytest
from conftest import values
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.plans import daily
from coldhaul.session import scratch_path
from coldhaul.streaming.messages import json_payload

FIRST, SECOND = date(2024, 3, 1), date(2024, 3, 2)

RAW = {
    "vehicles": [("1", "A", "1", "70", "Diesel", "10"), ("2", "B", "1", "70", "Diesel", "10")],
    "drivers": [("1", "F", "L", "C", "01")],
    "cargo": [("1", "Chilled", "8", "2", "4", "9")],
    "depots": [("1", "x", "G", "30", "31", "4"), ("2", "y", "H", "30", "31", "4")],
    "routes": [("1", "1", "2")],
    "trips": [("1", "1", "1", "1", "2024-03-01 08:00:00", "2024-03-01 23:00:00", "2024-03-01 08:00:00", "2024-03-01 23:59:30"),
              ("2", "1", "1", "1", "2024-03-02 00:10:00", "2024-03-02 09:00:00", "2024-03-02 00:10:00", "2024-03-02 09:00:00"),
              ("3", "2", "1", "1", "2024-03-01 20:00:00", "2024-03-02 09:00:00", "2024-03-01 20:00:00", "9999-01-01 00:00:00"),
              ("4", "2", "1", "1", "bad", "bad", "bad", "bad")],
    "trip_cargo": [("1", "1", "Delivered"), ("2", "1", "Loaded"), ("3", "1", "Loaded")],
}
# vehicle, event time, arrival, rpm, throttle; the last two numbers are dirt
QUICK = [("1", "2024-03-01 23:59:00", "2024-03-01 23:59:01", "5000", "90"),
         ("1", "2024-03-01 23:59:20", "2024-03-02 00:00:01", "5000", "90"),
         ("1", "2024-03-02 08:00:00", "2024-03-02 08:00:01", "NaN", "NaN"),
         ("2", "2024-03-01 22:00:00", "2024-03-02 10:00:00", "900", "1e400"),
         ("2", "2024-03-02 22:00:00", "2024-03-02 22:00:00", "4201", "x"),
         ("2", "soon", "2024-03-02 22:00:00", "5000", "90"), ("2", "soon", "2024-03-01 22:00:00", "5000", "90")]
SLOW = [("1", "2024-03-01 23:59:00", "2024-03-01 23:59:02", "50", "9"),
        ("1", "2024-03-01 23:59:20", "2024-03-02 00:00:02", "40", "NaN"),
        ("1", "2024-03-02 08:00:00", "2024-03-02 08:00:02", "1e13", "5"),
        ("2", "2024-03-01 23:00:00", "2024-03-02 00:00:02", "NaN", "1e300")]


def raw(spark, trips):
    return {n: spark.createDataFrame(trips if n == "trips" else rows, schemas.RAW[n]) for n, rows in RAW.items()}


def messages(spark):
    def sent(rows, columns, fill):
        df = spark.createDataFrame([(v, f"S{i}", ts, *fill(rest), at) for i, (v, ts, at, *rest) in enumerate(rows)],
                                   schemas.strings(*columns, "at"))
        return json_payload(df, columns).select("key", "value", F.lit("t").alias("topic"),
                                                F.col("at").cast("timestamp_ntz").alias("timestamp"))
    return {"quick": sent(QUICK, schemas.QUICK_COLUMNS, lambda r: ("1", "2", "5", r[0], r[1], "NaN", "13")),
            "slow": sent(SLOW, schemas.SLOW_COLUMNS, lambda r: (r[0], "0", r[1]))}


def landed(spark, trips=None):
    lake = daily.Lake(spark, scratch_path(spark, "lake"), FIRST)
    lake.land(raw(spark, trips or RAW["trips"]), messages(spark))
    return lake


def test_daily_run_equals_rebuild(spark):
    whole, grown = landed(spark), landed(spark)
    daily.backfill_run(whole, SECOND)
    daily.backfill_run(grown, FIRST)
    assert {r.dt for r in grown.read("silver", "quick").select("dt").distinct().collect()} == {FIRST, None}
    daily.daily_run(grown)
    expected = values(whole.fact())
    assert values(grown.fact()) == expected
    telemetry = {r.trip_id: r for r in whole.read("staging", "trip_telemetry_agg").collect()}
    assert (telemetry[1].quick_pings_count, telemetry[1].slow_pings_count) == (2, 2)
    assert (telemetry[1].engine_fault_ticks, telemetry[1].drift_ticks, telemetry[1].cargo_breach_ticks) == (2, 0, 1)
    assert (telemetry[2].engine_fault_ticks, telemetry[2].speeding_ticks) == (0, 0)
    assert telemetry[3].engine_fault_ticks == 1 and telemetry[3].quick_pings_count == 2
    for kind in daily.TOPICS:
        assert values(grown.read("silver", kind)) == values(whole.read("silver", kind))
    # the day again changes nothing
    for stage in daily.DAY_STAGES:
        grown.control.rewind(stage, FIRST)
    daily.daily_run(grown)
    assert values(grown.fact()) == expected


def test_a_trip_that_gets_its_start_moves(spark):
    lake = landed(spark)
    daily.backfill_run(lake, FIRST)
    assert lake.read("silver", "trips").where("start_date IS NULL").count() == 1
    fixed = ("4", "2", "1", "1", *["2024-03-02 12:00:00", "2024-03-02 13:00:00"] * 2)
    spark.createDataFrame([fixed], schemas.RAW["trips"]).write.mode("append").parquet(
        f"{lake.path('landing', 'trips')}/dt={SECOND}")
    daily.daily_run(lake)
    trips = lake.read("silver", "trips")
    assert values(trips.where("trip_id = 4"), "start_date") == [(SECOND,)]
    assert trips.count() == trips.select("trip_id").distinct().count() == 4
    lake.control.rewind("silver", SECOND)
    daily.silver_day(lake, SECOND + timedelta(days=1))
    assert lake.read("silver", "trips").count() == 4


@pytest.mark.parametrize("kind", ["quick", "slow"])
def test_days_read_their_partitions_only(spark, kind):
    lake = landed(spark)
    daily.backfill_run(lake, SECOND)
    plan = lake.pings(kind, [FIRST])._jdf.queryExecution().executedPlan().toString()
    assert f"dt={SECOND}" not in plan
    plan = lake.read("silver", "trips").where(F.col("start_date") < F.lit(SECOND))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_date" in plan


def test_backfill_passes_once_over_the_cargo_of_trips(spark, monkeypatch):
    """Totals and bounds come from one summary of the bridge, the largest table."""
    made, summary = [], daily.rollup.trip_cargo_summary
    monkeypatch.setattr(daily.rollup, "trip_cargo_summary", lambda *args: made.append(args) or summary(*args))
    lake = landed(spark)
    daily.backfill_run(lake, SECOND)
    assert len(made) == 1
    assert {r.trip_id: r.total_cargo_weight_kg for r in lake.read("staging", "trip_cargo_agg").collect()} == {1: 4, 2: 4, 3: 4}
