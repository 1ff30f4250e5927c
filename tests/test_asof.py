import random
from datetime import timedelta

from conftest import t, trips, values
from pyspark.sql import functions as F

from coldhaul.operators.asof import match_trips, present_days, trip_windows, window_days
from coldhaul.operators.ordered import _chunk, next_value, previous_value, resequence, top_rows

PLANNED = [(1, 0, "08:00", "10:00"), (2, 0, "09:00", "09:30"), (3, 0, "11:00", "12:00"),
           (4, 0, "11:00", "12:00")]


def pings(spark, rows):
    return spark.createDataFrame([(v, f"S{i}", t(ts) if isinstance(ts, str) else ts)
                                  for i, (v, ts) in enumerate(rows)],
                                 "vehicle_id bigint, sensor_id string, ts timestamp_ntz")


def test_latest_start_wins_then_end_is_checked(spark):
    times = ["07:59:59", "08:00:00", "08:30:00", "09:30:00", "09:45:00", "11:10:00"]
    df = pings(spark, [(0, x) for x in times] + [(9, "08:30:00")])
    out = match_trips(df, trip_windows(trips(spark, PLANNED)), "ts", "left")
    found = {(r.vehicle_id, r.ts): r.trip_id for r in out.collect()}
    assert [found[0, t(x)] for x in times] == [None, 1, 1, 2, None, 4]
    assert found[9, t("08:30:00")] is None
    assert out.count() == 7


def test_backward_trip_matches_nothing_and_still_blocks(spark):
    df = trips(spark, [(1, 0, "08:00", "12:00"), (2, 0, "09:00", "08:30")])
    out = match_trips(pings(spark, [(0, "08:30"), (0, "09:10")]), trip_windows(df), "ts")
    assert values(out, "trip_id") == [(1,)]


def _brute(trip_rows, ping_rows):
    found = {}
    for i, (v, ts) in enumerate(ping_rows):
        before = [(s, tid, e) for tid, tv, s, e in trip_rows if tv == v and s <= ts]
        best = max(before, default=None)
        found[f"S{i}"] = best[1] if best and ts <= best[2] else None
    return found


def test_hot_vehicle_equals_brute_force(spark):
    """One vehicle holds most trips and pings, over many chunks and days, with tied starts."""
    rng = random.Random(7)
    base = t("00:00")
    trip_rows, ping_rows = [], []
    for i in range(300):
        v = 0 if i % 3 else rng.randrange(1, 5)
        start = base + timedelta(hours=rng.randrange(0, 1500))
        trip_rows.append((i, v, start, start + timedelta(hours=rng.randrange(1, 120))))
    for _ in range(600):
        v = 0 if rng.random() < 0.7 else rng.randrange(1, 6)
        ping_rows.append((v, base + timedelta(minutes=rng.randrange(-500, 95000))))
    table = spark.createDataFrame([(i, v, i, s, e) for i, v, s, e in trip_rows],
                                  "trip_id bigint, vehicle_id bigint, driver_id bigint, "
                                  "actual_start_time timestamp_ntz, actual_end_time timestamp_ntz")
    out = match_trips(pings(spark, ping_rows), trip_windows(table.repartition(5)), "ts", "left")
    assert {r.sensor_id: r.trip_id for r in out.collect()} == _brute(trip_rows, ping_rows)


def test_neighbours_cross_chunks_and_keep_nulls(spark):
    rows = [("a", t("08:00"), 1, 5), ("a", t("08:00"), 2, None), ("a", t("10:30"), 3, 7),
            ("a", t("23:00"), 4, 8), ("b", t("09:00"), 5, 1), (None, t("09:00"), 6, 2)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v int")
    prev = previous_value(df, ["k"], "ts", ["id"], "v", "p", minutes=60)
    assert [r.p for r in prev.orderBy("id").collect()] == [None, 5, None, 7, None, None]
    nxt = next_value(df, ["k"], "ts", ["id"], "v", "n", minutes=60)
    assert [r.n for r in nxt.orderBy("id").collect()] == [None, 7, 8, None, None, None]


def test_rows_without_a_timestamp_do_not_share_a_chunk(spark):
    rows = [("a", None, f"S{i:06d}", float(i)) for i in range(300)] + [("a", t("08:00"), "S000001", -1.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id string, v double")
    prev = previous_value(df, ["k"], "ts", ["id"], "v", "p")
    found = {(r.ts, r.id): r.p for r in prev.collect()}
    assert all(found[None, f"S{i:06d}"] == (float(i - 1) if i else None) for i in range(300))
    assert found[t("08:00"), "S000001"] == 299.0
    chunks = df.select(_chunk(df, ["k"], "ts", ["id"], 10).alias("c")).distinct().count()
    assert chunks == 31


def test_neighbours_take_one_exchange_of_the_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(f"v{i % 9}", t("08:00") + timedelta(minutes=i), f"S{i}", float(i), "x" * 20)
                           for i in range(500)], "k string, ts timestamp_ntz, id string, v double, other string").write.parquet(path)
    df = previous_value(spark.read.parquet(path), ["k"], "ts", ["id"], "v", "p")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 and final.count("ReusedExchange") == 1


def test_a_trip_that_ends_in_9999_covers_the_days_of_the_pings(spark):
    windows = trip_windows(trips(spark, [(1, 0, "08:00", "9999-12-31 00:00:00"), (2, 1, "08:00", "09:30")]))
    assert window_days(windows, last=F.lit("2024-03-05").cast("date")).count() == 6
    rows = [(0, "07:00"), (0, "09:00"), (0, "2024-03-20 10:00:00"), (1, "09:00"), (1, "10:00"), (0, None)]
    for wild in ([], [(0, "9999-12-30 00:00:00"), (1, "9999-12-30 00:00:00")]):
        df = pings(spark, rows + wild)
        found = match_trips(df, windows, "ts")
        assert values(found, "sensor_id", "trip_id") == sorted(
            [("S1", 1), ("S2", 1), ("S3", 2)] + [("S6", 1)] * bool(wild))
        present = df.select("vehicle_id", F.to_date("ts").alias("_day")).where("_day IS NOT NULL").distinct()
        # a row per day with pings in place of millions: two of March, and the wild one
        assert present_days(windows.where("vehicle_id = 0"), present).count() == 2 + bool(wild)
    assert match_trips(df, windows, "ts", "left").count() == 8
    assert match_trips(df.limit(0), windows, "ts").count() == 0


def test_long_windows_equal_brute_force(spark):
    rng = random.Random(8)
    base = t("00:00")
    trip_rows = [(i, i % 4, base + timedelta(days=rng.randrange(0, 400), hours=i), base + timedelta(days=rng.randrange(0, 900)))
                 for i in range(60)]
    ping_rows = [(rng.randrange(0, 5), base + timedelta(hours=rng.randrange(-50, 24000))) for _ in range(500)]
    table = spark.createDataFrame([(i, v, i, s, e) for i, v, s, e in trip_rows],
                                  "trip_id bigint, vehicle_id bigint, driver_id bigint, "
                                  "actual_start_time timestamp_ntz, actual_end_time timestamp_ntz")
    out = match_trips(pings(spark, ping_rows), trip_windows(table), "ts", "left")
    assert {r.sensor_id: r.trip_id for r in out.collect()} == _brute(trip_rows, ping_rows)


def test_without_long_windows_the_pings_are_read_once(spark, tmp_path):
    path = str(tmp_path / "pings")
    pings(spark, [(0, "09:00"), (1, "09:00")]).write.parquet(path)
    df = match_trips(spark.read.parquet(path), trip_windows(trips(spark, PLANNED)), "ts")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1


def test_resequence_is_a_total_numbering(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), "id").repartition(7)
    out = resequence(df, ["k", "id"], "n").orderBy("k", "id").collect()
    assert [r.n for r in out] == list(range(1000))


def test_top_rows_come_in_order(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(6)
    assert [r.k for r in top_rows(df, [F.col("k").desc()], 3).collect()] == sorted(
        [(i * 7919) % 1000 for i in range(500)], reverse=True)[:3]
    assert [r.k for r in df.orderBy("k").collect()] == sorted((i * 7919) % 1000 for i in range(500))
