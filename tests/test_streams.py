from datetime import date

from conftest import t, trips, values
from pyspark.sql import functions as F

from coldhaul import schemas
from coldhaul.session import scratch_path
from coldhaul.sources import files
from coldhaul.streaming import jobs, live, messages, series
from coldhaul.streaming.windows import WindowStore

WINDOW = "2 minutes"


def windows(spark):
    bridge = spark.createDataFrame([(1, 1)], "trip_id bigint, cargo_id bigint")
    cargo = spark.createDataFrame([(1, "Chilled", 8.0, 2.0)],
                                  "cargo_id bigint, cargo_type string, max_temp double, min_temp double")
    return live.live_windows(trips(spark, [(1, 0, "08:00", "10:00")]), bridge, cargo)


def sent(spark, topic, columns, rows):
    """Messages of rows ``(vehicle, sensor, time, *numbers)``."""
    df = spark.createDataFrame([tuple(str(x) for x in r) for r in rows], schemas.strings(*columns))
    return messages.json_payload(df, columns).select(
        "key", "value", F.lit(topic).alias("topic"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def quick(spark, *rows):
    return sent(spark, "quick", schemas.QUICK_COLUMNS,
                [(v, s, t(x), 1.0, 2.0, 5.0, 900, thr, 0.1, 13.0) for v, s, x, thr in rows])


def slow(spark, *rows):
    return sent(spark, "slow", schemas.SLOW_COLUMNS, [(v, s, t(x), f, 0, 5.0) for v, s, x, f in rows])


QUICK_PARTS = [[(0, "a", "08:10:00", 90), (1, "b", "08:11:00", 10)], [(0, "c", "08:30:00", 10)]]
SLOW_PARTS = [[(0, "d", "08:10:00", 50.0)], [(0, "e", "11:00:00", 38.0), (1, "f", "08:00:00", 9.0)]]


def replay(spark, out, inbox):
    for q_rows, s_rows in zip(QUICK_PARTS, SLOW_PARTS):
        quick(spark, *q_rows).write.mode("append").parquet(f"{inbox}/quick")
        slow(spark, *s_rows).write.mode("append").parquet(f"{inbox}/slow")
        jobs.replay_alerts(
            messages.message_stream(spark, "parquet", path=f"{inbox}/quick"),
            messages.message_stream(spark, "parquet", path=f"{inbox}/slow"), windows(spark), out, WINDOW)


FEED = [(0, 1, "SPEEDING"), (0, None, "FUEL_FRAUD")]


def test_restarted_streams_equal_history(spark):
    out, inbox = scratch_path(spark, "out"), scratch_path(spark, "inbox")
    replay(spark, out, inbox)
    assert values(jobs.read_feed(spark, out), "vehicle_id", "trip_id", "incident_type") == sorted(FEED, key=repr)
    # the stored table carries the colours as of the last incident, 11:00
    red = jobs.read_status(spark, out)
    assert values(red, "vehicle_id", "incident_color", "incident_label") == [(0, "RED", "FUEL_FRAUD"), (1, "WHITE", "OK")]
    later = live.refresh_colours(red, jobs.read_feed(spark, out), F.lit(t("12:00")), WINDOW)
    assert values(later, "vehicle_id", "incident_color") == [(0, "WHITE"), (1, "WHITE")]
    assert [n for n in files.child_names(spark, f"{out}/feed") if "=" in n] == ["detected_date=2024-03-01"]

    # a batch that is delivered again leaves the same rows
    batch = slow(spark, *SLOW_PARTS[1])
    last = max(written(spark, f"{out}/fuel", "vehicle_id"))
    jobs.slow_step(store(spark), out, jobs.at_event_time)(batch, last)
    assert values(jobs.read_feed(spark, out), "vehicle_id", "trip_id", "incident_type") == sorted(FEED, key=repr)
    fuel = jobs.read_state(spark, f"{out}/fuel", jobs.FUEL_SCHEMA)
    assert values(fuel.select("vehicle_id", F.col("last_fuel_l").cast("int"))) == [(0, 38), (1, 9)]
    # each batch wrote the rows of its vehicles only
    assert list(written(spark, f"{out}/fuel", "vehicle_id").values()) == [[0], [0, 1]]
    assert list(written(spark, f"{out}/positions", "vehicle_id").values()) == [[0, 1], [0]]


def written(spark, path, column):
    """What each batch of a series wrote. A watermark that moves on brings batches without rows."""
    found = {r.first: sorted(row[0] for row in spark.read.parquet(f"{path}/{r.folder}").select(column).collect())
             for r in series.ranges(spark, path)}
    return {batch: rows for batch, rows in found.items() if rows}


def store(spark):
    made = WindowStore(spark, scratch_path(spark, "store"))
    made.publish(windows(spark))
    return made


def test_landing_partitions_by_message_date(spark):
    root = scratch_path(spark, "land")
    quick(spark, *QUICK_PARTS[0]).write.parquet(f"{root}/inbox")
    for _ in range(2):
        source = messages.message_stream(spark, "parquet", topic="quick", path=f"{root}/inbox")
        jobs.land_topic(source, f"{root}/quick", f"{root}/cp", jobs.DRAIN).awaitTermination()
    landed = spark.read.parquet(f"{root}/quick")
    assert values(landed.select("kafka_key", F.col("ingest_date").cast("string"))) == [
        ("0", "2024-03-01"), ("1", "2024-03-01")]
    assert landed.first().ingestion_ts is not None


def positions(spark, *rows):
    return live.position_state(messages.quick_from_messages(quick(spark, *rows)))


def test_colours_follow_the_window_and_old_versions_go(spark):
    out = scratch_path(spark, "versions")
    incidents, status = jobs.incident_step(store(spark), out, jobs.at_event_time), jobs.status_step(out, jobs.at_event_time, WINDOW)
    for n, minute in enumerate(["08:10:00", "08:11:00", "08:12:00", "08:13:00"]):
        row = (0, f"s{n}", minute, 90 if n == 1 else 10)
        incidents(quick(spark, row), n)
        status(positions(spark, row), n)
    assert [n for n in files.child_names(spark, f"{out}/colours")] == ["batch=2", "batch=3"]
    assert values(jobs.read_status(spark, out), "vehicle_id", "last_event_time", "incident_color") == [(0, t("08:11"), "YELLOW")]
    jobs.status_step(out, lambda: t("08:13:00"), WINDOW)(positions(spark, (0, "s4", "08:13:30", 10)), 4)
    assert values(jobs.read_status(spark, out), "last_event_time", "incident_color") == [(t("08:13:30"), "WHITE")]


def test_a_replay_past_midnight_finds_what_it_wrote(spark):
    out, windows_ = scratch_path(spark, "midnight"), store(spark)
    batch = quick(spark, (0, "a", "08:10:00", 90), (0, "b", "08:11:00", 95))
    before, after = t("2024-03-01 23:59:59"), t("2024-03-02 00:00:01")
    for clock in (lambda: before, lambda: after):
        jobs.incident_step(windows_, out, clock)(batch, 0)
    assert values(jobs.read_feed(spark, out), "sensor_id", "detected_at") == [("a", before), ("b", before)]
    # cut off between the log and the feed: the next attempt keeps the time
    jobs.BatchLog(spark, out, "quick", 1).record(before, [before.date()])
    jobs.incident_step(windows_, out, lambda: after)(quick(spark, (0, "c", "08:12:00", 90)), 1)
    assert values(jobs.read_feed(spark, out), "sensor_id", "detected_at")[2:] == [("c", before)]
    # by event time, a replay that finds other dates takes back what the first attempt wrote
    jobs.incident_step(windows_, out, jobs.at_event_time)(quick(spark, (0, "d", "2024-03-05 08:12:00", 90)), 2)
    jobs.incident_step(windows_, out, jobs.at_event_time)(quick(spark, (0, "d", "2024-03-06 08:12:00", 90)), 2)
    found = jobs.read_feed(spark, out).where("sensor_id = 'd'")
    assert values(found, "event_time") == [(t("2024-03-06 08:12:00"),)]
    assert {n.split(".")[0] for n in files.child_names(spark, f"{out}/_batches/quick")} == {"1", "2"}


def feed_rows(spark, n):
    return spark.createDataFrame([(n, None, None, t("08:00"), "RED", "X", "", None, None, f"s{n}")],
                                 ", ".join(jobs.FEED_SCHEMA.split(", ")[:10]))


def test_a_feed_of_a_thousand_batches_lists_as_one_of_few(spark, monkeypatch):
    """The folders of a day are folded by sixteens, so the listing does not follow the number of batches."""
    def listed(batches):
        out = scratch_path(spark, f"feed-{batches}")
        root = f"{out}/feed/detected_date=2024-03-01/topic=quick"
        source = f"{out}/one"
        feed_rows(spark, 0).withColumn("detected_at", F.lit(t("08:00"))).write.parquet(source)
        for n in range(batches):
            if n == 0 or n % 16 == 15 or n >= batches - 2:
                # copies of one file stand for batches; only the fold is Spark's work
                for m in range(max(0, n - 15), n + 1):
                    copy(spark, source, f"{root}/batches={m}-{m}-0")
            series.fold(spark, root, jobs._in_feed_folder(), n)
        calls = []
        names = files.child_names
        for module in (jobs, series):
            monkeypatch.setattr(module, "child_names", lambda spark_, path: (calls.append(path), names(spark_, path))[1])
        day = date(2024, 3, 1)
        folders = jobs.feed_folders(spark, out, day, day)
        rows = jobs.read_feed(spark, out, day, day).count()
        for module in (jobs, series):
            monkeypatch.setattr(module, "child_names", names)
        return len(calls), len(folders), rows

    def copy(spark_, source, target):
        if not files.path_exists(spark_, target) and not any(
                r.first <= int(target.split("=")[-1].split("-")[0]) <= r.last
                for r in series.ranges(spark_, target.rsplit("/", 1)[0])):
            fs, p = files._hadoop(spark_, source)
            spark_._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, fs, files._hadoop(spark_, target)[1], False,
                                                          spark_._jsc.hadoopConfiguration())

    few, many = listed(10), listed(1000)
    assert few[0] == many[0] and few[2] == 10 and many[2] == 1000
    assert many[1] <= 3 * series.FOLD


def test_folds_and_readers(spark):
    path = scratch_path(spark, "series")
    schema = "vehicle_id bigint, v int"

    def write(n):
        rows = spark.createDataFrame([(n % 3, n), (100 + n, n)], schema).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{path}/{series.Range(n, n, 0).folder}")

    for n in range(16):
        write(n)
    listed = series.paths(spark, path)
    merge = lambda rows: series.newest(rows, "vehicle_id")
    series.fold(spark, path, schema, 16, merge)
    assert series.ranges(spark, path) == [(0, 15, 1)]
    # who had listed the folders before can still read them
    assert series.read(spark, path, schema, listed).count() == 32
    write(16)
    state = series.newest(series.read(spark, path, schema, series.paths(spark, path)), "vehicle_id")
    assert values(state.where("vehicle_id < 3")) == [(0, 15), (1, 16), (2, 14)] and state.count() == 20
    assert series.read(spark, path, schema, series.paths(spark, path, 16)).count() == 19
    # a running batch is not folded, and a draft is not read
    spark.createDataFrame([(7, 7)], schema).write.parquet(f"{path}/_batches-0-16-2")
    series.fold(spark, path, schema, 16, merge)
    assert series.ranges(spark, path) == [(0, 15, 1), (16, 16, 0)]
    series.close(spark, path, schema, 17, merge)
    assert series.ranges(spark, path) == [(0, 16, 2)]
    assert values(series.read(spark, path, schema, series.paths(spark, path)).where("vehicle_id < 3"), "v") == [(14,), (15,), (16,)]
    assert series.read(spark, path, schema, []).count() == 0 == len(series.ranges(spark, f"{path}/none"))


def test_a_day_that_is_over_is_closed(spark):
    out, windows_ = scratch_path(spark, "closed"), store(spark)
    times = [t("2024-03-01 23:59:00"), t("2024-03-01 23:59:10"), t("2024-03-01 23:59:20"), t("2024-03-02 00:00:10")]
    for n, now in enumerate(times):
        jobs.incident_step(windows_, out, lambda now=now: now)(quick(spark, (0, f"s{n}", f"08:1{n}:00", 90)), n)
    held = {d: series.ranges(spark, f"{out}/feed/detected_date={d}/topic=quick") for d in ("2024-03-01", "2024-03-02")}
    assert held == {"2024-03-01": [(0, 2, 1)], "2024-03-02": [(3, 3, 0)]}
    jobs.incident_step(windows_, out, lambda: t("2024-03-02 00:00:20"))(quick(spark, (0, "s3", "08:13:00", 90)), 3)
    assert values(jobs.read_feed(spark, out), "sensor_id") == [("s0",), ("s1",), ("s2",), ("s3",)]


def test_messages_sent_twice_count_once_and_late_ones_are_counted(spark):
    out, inbox, rows = scratch_path(spark, "once"), scratch_path(spark, "once-inbox"), []
    store_ = store(spark)
    first = quick(spark, (0, "a", "08:10:00", 90))
    parts = [first.unionByName(first), first, quick(spark, (0, "b", "09:00:00", 90)),
             quick(spark, (0, "late", "08:20:00", 90)).unionByName(quick(spark, (1, "c", "09:00:01", 90)))
             .unionByName(quick(spark, (0, "held", "07:00:00", 90)).withColumn("timestamp", F.lit(t("09:00:02"))))]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(inbox)
        query = jobs.run_each_batch(messages.once(messages.message_stream(spark, "parquet", path=inbox)),
                                    jobs.incident_step(store_, out, jobs.at_event_time), f"{out}/cp", jobs.DRAIN)
        query.awaitTermination()
        rows.append(jobs.late_rows(query))
    # held back by its device for two hours, but sent now: that is not late
    assert values(jobs.read_feed(spark, out), "vehicle_id", "sensor_id") == [(0, "a"), (0, "b"), (0, "held"), (1, "c")]
    assert rows == [0, 0, 0, 1]
    undated = first.withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    undated.write.mode("append").parquet(f"{inbox}-undated")
    query = jobs.append_stream(messages.once(messages.message_stream(spark, "parquet", path=f"{inbox}-undated")), f"{out}/u", f"{out}/ucp")
    query.awaitTermination()
    assert spark.read.parquet(f"{out}/u").count() == 1


def test_a_trip_added_while_the_stream_runs_counts_from_the_next_batch(spark):
    out, inbox = scratch_path(spark, "added"), scratch_path(spark, "added-inbox")
    empty = windows(spark).limit(0)
    quick(spark, (0, "a", "08:10:00", 90)).write.parquet(f"{inbox}/quick")
    slow(spark, (0, "x", "08:10:00", 50.0)).write.parquet(f"{inbox}/slow")
    soon = {"processingTime": "1 second"}
    running = jobs.start_alerts(
        messages.message_stream(spark, "parquet", path=f"{inbox}/quick"), messages.message_stream(spark, "parquet", path=f"{inbox}/slow"),
        empty, out, soon, soon, clock=lambda: t("12:00"), as_of=lambda: t("12:00"), window=WINDOW)
    try:
        for q in running:
            q.processAllAvailable()
        WindowStore(spark, f"{out}/windows").publish(windows(spark))
        quick(spark, (0, "b", "08:20:00", 90)).write.mode("append").parquet(f"{inbox}/quick")
        for q in running:
            q.processAllAvailable()
    finally:
        for q in running:
            q.stop()
    assert values(jobs.read_feed(spark, out), "sensor_id", "trip_id") == sorted([("a", None), ("b", 1)], key=repr)
    assert values(jobs.read_status(spark, out), "vehicle_id", "incident_color") == [(0, "YELLOW")]


def test_published_windows_by_day(spark):
    made = store(spark)
    day, other = date(2024, 3, 1), date(2024, 3, 2)
    assert values(made.read([day, other]), "trip_id") == [(1,)]
    two = live.live_windows(trips(spark, [(5, 0, "08:00", "2024-03-02 10:00:00")]), *[spark.createDataFrame([], s) for s in (
        "trip_id bigint, cargo_id bigint", "cargo_id bigint, cargo_type string, max_temp double, min_temp double")])
    made.publish(two, [other])  # the first day stays as it was
    assert values(made.read([day, other]), "trip_id", "_day") == [(1, day), (5, other)]
    # written, but its publication was cut off
    two.withColumn("version", F.lit("3-lost")).write.mode("append").partitionBy("_day", "version").parquet(made.path)
    assert values(made.read([day, other]), "trip_id") == [(1,), (5,)]
    made.publish(two.limit(0), [day])
    assert values(WindowStore(spark, made.path).read([day, other]), "trip_id") == [(5,)]
    pings = spark.createDataFrame([(t("9999-03-01 00:00:00"),), (t("09:00"),), (None,)], "event_time timestamp_ntz")
    assert made.for_pings(pings).count() == 0
    made.publish(two)
    assert values(made.for_pings(pings), "trip_id", "_day") == [(5, day)]


def test_triggers_and_waiting_for_any(spark, monkeypatch):
    started = {}

    class Writer:
        def __getattr__(self, name):
            def call(*args, **kwargs):
                started.setdefault(name, []).append(kwargs or args)
                return self
            return call

    stream = type("Stream", (), {"writeStream": Writer()})()
    monkeypatch.setattr(jobs.live, "position_state", lambda pings: pings)
    monkeypatch.setattr(jobs, "once", lambda rows: rows)
    monkeypatch.setattr(jobs, "quick_from_messages", lambda rows: rows)
    jobs.start_alerts(stream, stream, windows(spark), scratch_path(spark, "triggers"))
    assert started["trigger"] == [{"processingTime": "15 seconds"}, *[{"processingTime": "10 seconds"}] * 2]
    assert jobs.LAND_TRIGGER == {"processingTime": "30 seconds"}

    root = scratch_path(spark, "any")
    quick(spark, *QUICK_PARTS[0]).write.parquet(f"{root}/inbox")
    source = messages.message_stream(spark, "parquet", path=f"{root}/inbox")
    spark.streams.resetTerminated()
    query = jobs.append_stream(source, f"{root}/rows", f"{root}/cp")
    jobs.await_any(spark)
    assert not query.isActive and spark.read.parquet(f"{root}/rows").count() == 2


def test_a_batch_is_worked_on_outside_the_streams_own_settings(spark, monkeypatch):
    seen, path, inbox = [], scratch_path(spark, "settings"), scratch_path(spark, "settings-inbox")
    for name in ("quick_incidents", "slow_incidents", "highest_severity"):
        def spy(first, *rest, name=name, made=getattr(live, name)):
            seen.append((name, first.sparkSession.conf.get("spark.sql.adaptive.enabled")))
            return made(first, *rest)
        monkeypatch.setattr(live, name, spy)
    kept = []
    monkeypatch.setattr(jobs, "remove", lambda s, p, gone=jobs.remove: (kept.append(p), gone(s, p)))
    replay(spark, path, inbox)
    assert {n for n, _ in seen} == {"quick_incidents", "slow_incidents", "highest_severity"} and {on for _, on in seen} == {"true"}
    batches = [p for p in kept if "micro-batch" in p]
    assert batches and not any(files.path_exists(spark, p) for p in batches)
    assert values(jobs.read_feed(spark, path), "vehicle_id", "trip_id", "incident_type") == sorted(FEED, key=repr)
