from datetime import timedelta

from conftest import t, trips, values
from pyspark.sql import functions as F

from coldhaul.sinks.tables import upsert_positions
from coldhaul.streaming import live, messages

QUICK = "vehicle_id bigint, sensor_id string, event_time timestamp_ntz, lat double, lon double, " \
        "throttle_pct double, accel_ay_abs double, battery_v double"
SLOW = "vehicle_id bigint, sensor_id string, event_time timestamp_ntz, fuel_amount_l double, " \
       "is_door_open int, cargo_temp_c double"
FEED = "vehicle_id bigint, incident_color string, incident_type string, event_time timestamp_ntz, " \
       "sensor_id string, detected_at timestamp_ntz"


def windows(spark):
    bridge = spark.createDataFrame([(1, 1)], "trip_id bigint, cargo_id bigint")
    cargo = spark.createDataFrame([(1, "Chilled", 8.0, 2.0)],
                                  "cargo_id bigint, cargo_type string, max_temp double, min_temp double")
    return live.live_windows(trips(spark, [(1, 0, "08:00", "10:00"), (2, 5, "08:00", "10:00")]), bridge, cargo)


def test_quick_rules(spark):
    rows = [(0, "a", t("08:30"), 1.0, 2.0, 90.0, 1.0, 11.0), (0, "b", t("08:31"), 1.0, 2.0, 50.0, 1.0, 13.0),
            (0, "c", t("11:00"), 1.0, 2.0, 85.0, 0.75, 11.4), (9, "d", t("08:30"), 1.0, 2.0, 90.0, 0.1, 13.0),
            (0, "e", None, 1.0, 2.0, 90.0, 0.1, 13.0)]
    out = live.quick_incidents(spark.createDataFrame(rows, QUICK), windows(spark))
    assert values(out, "sensor_id", "incident_type", "incident_color", "trip_id", "detail") == sorted([
        ("a", "BATTERY_LOW", "BLUE", 1, "Battery 11.0V"), ("a", "SPEEDING", "YELLOW", 1, "Throttle 90.0%"),
        ("b", "DRIFT", "YELLOW", 1, "Lateral G 1.0"), ("d", "SPEEDING", "YELLOW", None, "Throttle 90.0%"),
        ("e", "SPEEDING", "YELLOW", None, "Throttle 90.0%")], key=repr)


def test_slow_rules_take_the_first_match(spark):
    rows = [(0, "a", t("08:10"), 50.0, 0, 5.0), (0, "b", t("08:20"), 38.0, 1, 50.0),   # fraud hides the rest
            (0, "c", t("08:30"), 38.0, 1, 50.0),                                     # door hides breach
            (0, "d", t("09:58"), 38.0, 1, 5.0),                                      # near the end: no door
            (0, "e", t("09:59"), 28.1, 0, 8.01),                                     # drop 9.9, breach
            (0, "f", t("11:00"), 18.1, 1, 50.0),                                     # no trip: drop 10.0 only
            (5, "g", t("08:03"), 9.0, 1, 50.0),                                      # exactly 180 s, no bounds
            (7, "h", t("08:30"), 9.0, 1, 50.0)]
    out = live.slow_incidents(live.fuel_drop_batch(spark.createDataFrame(rows, SLOW)), windows(spark))
    assert values(out, "sensor_id", "incident_type", "detail", "trip_id") == [
        ("b", "FUEL_FRAUD", "Fuel siphoned 12.0L", 1), ("c", "DOOR_OPEN", "Cargo door open mid-route", 1),
        ("e", "CARGO_BREACH", "Temp 8.01C (limit 2.0..8.0)", 1), ("f", "FUEL_FRAUD", "Fuel siphoned 10.0L", None)]


def test_fuel_memory_carries_over_batches(spark):
    first = spark.createDataFrame([(0, "a", t("08:00"), 50.0, 0, 1.0), (0, "b", t("08:05"), 57.5, 0, 1.0)], SLOW)
    second = spark.createDataFrame([(0, "c", t("11:00"), 40.0, 0, 1.0), (1, "d", t("11:00"), 9.0, 0, 1.0)], SLOW)
    empty = spark.createDataFrame([], "vehicle_id bigint, last_fuel_l decimal(18,6), last_event_time timestamp_ntz")
    assert {float(r.fuel_drop) for r in live.fuel_drop_step(first, empty).collect()} == {0.0}
    state = live.last_fuel(first)
    drops = {r.sensor_id: float(r.fuel_drop) for r in live.fuel_drop_step(second, state).collect()}
    assert drops == {"c": 17.5, "d": 0.0}
    assert values(live.last_fuel(second).select("vehicle_id", F.col("last_fuel_l").cast("int"))) == [
        (0, 40), (1, 9)]


def test_status_colours(spark):
    now = t("12:00")
    ago = lambda s: now - timedelta(seconds=s)
    feed = spark.createDataFrame([
        (1, "YELLOW", "DRIFT", ago(30), "a", ago(30)), (1, "ORANGE", "CARGO_BREACH", ago(90), "b", ago(90)),
        (2, "RED", "DOOR_OPEN", ago(121), "c", ago(121)), (3, "BLUE", "BATTERY_LOW", ago(10), "d", ago(10))], FEED)
    positions = spark.createDataFrame([(v, 1.0, 2.0, ago(5)) for v in (1, 2, 3)],
                                      "vehicle_id bigint, lat double, lon double, event_time timestamp_ntz")
    expected = [(1, "ORANGE", "CARGO_BREACH"), (2, "WHITE", "OK"), (3, "BLUE", "BATTERY_LOW")]
    status = live.vehicle_status(positions, feed, F.lit(now))
    columns = ("vehicle_id", "incident_color", "incident_label")
    assert values(status, *columns) == expected
    stale = status.withColumns({"incident_color": F.lit("RED"), "incident_label": F.lit("DOOR_OPEN")})
    assert values(live.refresh_colours(stale, feed, F.lit(now)), *columns) == expected


def test_upsert_keeps_the_colour_of_known_vehicles(spark):
    schema = "vehicle_id bigint, lat double, lon double, last_event_time timestamp_ntz, incident_color string, " \
             "incident_label string"
    old = spark.createDataFrame([(1, 1.0, 1.0, t("08:00"), "RED", "DOOR_OPEN"),
                                 (2, 1.0, 1.0, t("08:00"), "BLUE", "BATTERY_LOW")], schema)
    new = spark.createDataFrame([(1, 5.0, 6.0, t("09:00")), (3, 7.0, 8.0, t("09:00"))],
                                "vehicle_id bigint, lat double, lon double, event_time timestamp_ntz")
    assert values(upsert_positions(old, new)) == [
        (1, 5.0, 6.0, t("09:00"), "RED", "DOOR_OPEN"), (2, 1.0, 1.0, t("08:00"), "BLUE", "BATTERY_LOW"),
        (3, 7.0, 8.0, t("09:00"), "WHITE", "OK")]


def test_malformed_messages(spark):
    good = '{"vehicle_id":"4","sensor_id":"a","timestamp":"2024-03-01 08:00:00","fuel_amount_l":"1.5",' \
           '"is_door_open":"1","cargo_temp_c":"2"}'
    bodies = [good, good.replace('"4"', '"x"'), good.replace("2024-03-01", "2024-99-01"),
              good.replace('"1.5"', 'null'), "not json"]
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    assert values(messages.slow_from_messages(df), "vehicle_id", "event_time", "fuel_amount_l") == [
        (4, None, 1.5), (4, t("08:00"), 1.5)]
