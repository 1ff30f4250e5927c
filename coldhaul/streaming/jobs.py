"""The streaming jobs: raw landing, and live alerts.

A micro-batch of the alert streams writes the rows it brings and nothing else: its incidents to the feed, the positions of
its vehicles, the fuel readings of its vehicles. Each goes to a folder named by the batch, which a replay overwrites, and old folders
are folded (:mod:`coldhaul.streaming.series`). The time of detection and the dates of a batch are logged before the feed is written
and used again on a replay, so that it finds what it wrote, also past midnight. Positions are Spark's own keyed state;
the fuel memory compares with the reading that arrived before, which an aggregate can't tell, and is a series of readings.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coldhaul.functions.rules import RECENT_WINDOW
from coldhaul.session import cut, cut_at, scratch_path
from coldhaul.sinks.tables import folder_of
from coldhaul.sources.files import child_names, read_text, remove, write_text
from coldhaul.streaming import live, series
from coldhaul.streaming.messages import envelope, once, quick_from_messages, slow_from_messages
from coldhaul.streaming.windows import WindowStore

# Trigger intervals of the three jobs.
LAND_TRIGGER = {"processingTime": "30 seconds"}
QUICK_TRIGGER = {"processingTime": "10 seconds"}
SLOW_TRIGGER = {"processingTime": "15 seconds"}
DRAIN = {"availableNow": True}

STATUS_SCHEMA = ("vehicle_id bigint, lat double, lon double, last_event_time timestamp_ntz, "
                 "incident_color string, incident_label string")
POSITION_SCHEMA = "vehicle_id bigint, lat double, lon double, last_event_time timestamp_ntz"
FEED_SCHEMA = ("vehicle_id bigint, trip_id bigint, driver_id bigint, event_time timestamp_ntz, incident_color string, "
               "incident_type string, detail string, lat double, lon double, sensor_id string, "
               "detected_at timestamp_ntz, detected_date date")
WORST_SCHEMA = ("vehicle_id bigint, severity int, event_time timestamp_ntz, incident_type string, sensor_id string, "
                "incident_color string")
FUEL_SCHEMA = "vehicle_id bigint, last_fuel_l decimal(18,6), last_event_time timestamp_ntz"


def land_topic(messages: DataFrame, path: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Append the raw envelope to Parquet, one partition per message date."""
    return (envelope(messages).writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy("ingest_date").trigger(**(trigger or LAND_TRIGGER)).start())


def append_stream(df: DataFrame, path: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or DRAIN)).start())


def wall_clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def at_event_time() -> None:
    """The clock of replayed history: an incident is detected when it happens."""
    return None


Clock = Callable[[], datetime | None]


# ---- the feed ----

class BatchLog:
    """What a batch of a topic decided before it wrote: the time of detection and the dates of its incidents."""

    def __init__(self, spark: SparkSession, out: str, topic: str, batch_id: int):
        self.spark, self.folder, self.batch_id = spark, f"{out}/_batches/{topic}", batch_id

    def _attempts(self) -> list[dict]:
        names = [n for n in child_names(self.spark, self.folder) if n.endswith(".json") and n.startswith(f"{self.batch_id}.")]
        return [json.loads(read_text(self.spark, f"{self.folder}/{n}"))
                for n in sorted(names, key=lambda n: int(n.split(".")[1]))]

    def detected_at(self, clock: Clock) -> datetime | None:
        """The time the first attempt took, or the clock's now."""
        earlier = self._attempts()
        if earlier:
            return earlier[0]["detected_at"] and datetime.fromisoformat(earlier[0]["detected_at"])
        return clock()

    def record(self, detected_at: datetime | None, dates: list[date | None]) -> set[str]:
        """Log this attempt; returns the date folders that it or an earlier one writes. Logs of settled batches go."""
        earlier, folders = self._attempts(), sorted(folder_of("detected_date", d) for d in dates)
        write_text(self.spark, f"{self.folder}/{self.batch_id}.{len(earlier)}.json", json.dumps(
            {"detected_at": detected_at and detected_at.isoformat(), "folders": folders}))
        for name in child_names(self.spark, self.folder):
            if int(name.split(".")[0]) < self.batch_id - 1:
                remove(self.spark, f"{self.folder}/{name}")
        return {f for attempt in earlier for f in attempt["folders"]} | set(folders)


def write_feed(incidents: DataFrame, out: str, topic: str, batch_id: int, clock: Clock = wall_clock) -> None:
    """Write a batch's incidents, once however often the batch runs, and fold older batches of the topic."""
    spark, log = incidents.sparkSession, BatchLog(incidents.sparkSession, out, topic, batch_id)
    now = log.detected_at(clock)
    found = F.col("event_time") if now is None else F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    dated = incidents.withColumn("detected_at", found).withColumns({
        "detected_date": F.to_date("detected_at"), "topic": F.lit(topic), series.COLUMN: F.lit(series.of_batch(batch_id))})
    dates = [None if now is None else now.date()]
    if now is None:
        dated = cut(dated, "incidents")
        # one row per event date of a batch
        dates = [r[0] for r in dated.select("detected_date").distinct().collect()]
    folders = log.record(now, dates)
    single = series.Range(batch_id, batch_id, 0).folder
    for folder in folders:
        remove(spark, f"{out}/feed/{folder}/topic={topic}/{single}")
    (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("detected_date", "topic", series.COLUMN).parquet(f"{out}/feed"))
    for folder in folders:
        series.fold(spark, f"{out}/feed/{folder}/topic={topic}", _in_feed_folder(), batch_id)
    if now is not None:
        # the day before is over, also for this topic: batches before this one are not replayed
        over = folder_of("detected_date", now.date() - timedelta(days=1))
        series.close(spark, f"{out}/feed/{over}/topic={topic}", _in_feed_folder(), batch_id)


def _in_feed_folder() -> T.StructType:
    """The columns of the feed's files: those of the feed less the date, which names the folder."""
    return T.StructType([f for f in T.StructType.fromDDL(FEED_SCHEMA) if f.name != "detected_date"])


def feed_folders(spark: SparkSession, out: str, first: date | None = None, last: date | None = None) -> list[str]:
    """The folders that hold the feed, of the dates from ``first`` to ``last`` if given; other dates are not listed."""
    root = f"{out}/feed"
    if first is not None and last is not None:
        dates = [folder_of("detected_date", first + timedelta(days=n)) for n in range((last - first).days + 1)]
    else:
        dates = [n for n in child_names(spark, root) if n.startswith("detected_date=")]
    return [p for d in dates for t in child_names(spark, f"{root}/{d}") if t.startswith("topic=")
            for p in series.paths(spark, f"{root}/{d}/{t}")]


def read_feed(spark: SparkSession, out: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The incidents both streams have written, of the dates of detection from ``first`` to ``last`` if given."""
    return series.read(spark, f"{out}/feed", FEED_SCHEMA, feed_folders(spark, out, first, last)).drop("batch")


def newest_detection(spark: SparkSession, out: str) -> datetime | None:
    """The time of the newest incident, from the newest date that has one."""
    dates = [n for n in child_names(spark, f"{out}/feed") if n.startswith("detected_date=") and n[14:].replace("-", "").isdigit()]
    for name in reversed(dates):
        day = date.fromisoformat(name.split("=")[1])
        found = read_feed(spark, out, day, day).agg(F.max("detected_at")).first()[0]
        if found is not None:
            return found
    return None


# ---- state ----

def batch_path(table: str, batch_id: int) -> str:
    return f"{table}/batch={batch_id}"


def _write_version(df: DataFrame, table: str, batch_id: int) -> None:
    """Write a version of a small table. The one before it is kept for a replay; that before goes."""
    df.write.mode("overwrite").parquet(batch_path(table, batch_id))
    if batch_id >= 2:
        remove(df.sparkSession, batch_path(table, batch_id - 2))


def latest_version(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """The newest complete version of a small table."""
    done = [int(n.split("=")[1]) for n in child_names(spark, table) if n.startswith("batch=")
            and "_SUCCESS" in child_names(spark, f"{table}/{n}")]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(batch_path(table, max(done)))


def read_state(spark: SparkSession, table: str, schema: str, before: int | None = None) -> DataFrame:
    """The newest row of each vehicle in a series, as of the batches before ``before`` if given."""
    return series.newest(series.read(spark, table, schema, series.paths(spark, table, before)), "vehicle_id")


def _write_state(rows: DataFrame, table: str, schema: str, batch_id: int) -> None:
    """Add the rows of a batch's vehicles, and fold older batches to one row a vehicle."""
    rows.write.mode("overwrite").parquet(f"{table}/{series.Range(batch_id, batch_id, 0).folder}")
    series.fold(rows.sparkSession, table, schema, batch_id, partial(series.newest, key="vehicle_id"))


# ---- steps of a micro-batch ----

@contextmanager
def landed(rows: DataFrame, session: SparkSession) -> Iterator[DataFrame]:
    """The rows of a micro-batch, written once and read in a session that is not the stream's own.

    A stream plans its batches, and all that is made of them, with the number of partitions of its state and without adaptive
    execution: each shuffle would cost the square of that number in files, however few rows a batch brings.
    """
    at, path = cut_at(rows, "micro-batch")
    try:
        yield session.read.schema(at.schema).parquet(path)
    finally:
        remove(session, path)


def incident_step(windows: WindowStore, out: str, clock: Clock = wall_clock) -> Callable[[DataFrame, int], None]:
    """The incidents of one micro-batch of quick messages."""
    def step(batch: DataFrame, batch_id: int) -> None:
        with landed(quick_from_messages(batch), windows.spark) as pings:
            write_feed(live.quick_incidents(pings, windows.for_pings(pings)), out, "quick", batch_id, clock)
    return step


def slow_step(windows: WindowStore, out: str, clock: Clock = wall_clock) -> Callable[[DataFrame, int], None]:
    """The incidents of one micro-batch of slow messages, and the last fuel reading of its vehicles."""
    def step(batch: DataFrame, batch_id: int) -> None:
        with landed(slow_from_messages(batch), windows.spark) as pings:
            known = read_state(windows.spark, f"{out}/fuel", FUEL_SCHEMA, batch_id)
            drops = live.fuel_drop_step(pings, known)
            write_feed(live.slow_incidents(drops, windows.for_pings(pings)), out, "slow", batch_id, clock)
            _write_state(live.last_fuel(pings), f"{out}/fuel", FUEL_SCHEMA, batch_id)
    return step


def status_step(out: str, as_of: Clock = wall_clock, window: str = RECENT_WINDOW,
                session: SparkSession | None = None) -> Callable[[DataFrame, int], None]:
    """The positions that moved, and the colours of the vehicles with a recent incident.

    ``as_of`` gives the time to colour by; if it gives none, that of the newest incident counts. This step is the only writer of
    both tables; an incident colours its vehicle from the next batch on, ten seconds later at most. The feed is read in
    ``session`` if given, which spares the stream's own settings (:func:`landed`).
    """
    def step(moved: DataFrame, batch_id: int) -> None:
        spark = session or moved.sparkSession
        _write_state(moved, f"{out}/positions", POSITION_SCHEMA, batch_id)
        now = as_of() or newest_detection(spark, out)
        worst = spark.createDataFrame([], FEED_SCHEMA) if now is None else live.recent(
            read_feed(spark, out, _back(spark, now, window).date(), now.date()),
            F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"), window)
        _write_version(live.highest_severity(worst), f"{out}/colours", batch_id)
    return step


def _back(spark: SparkSession, now: datetime, window: str) -> datetime:
    return spark.range(1).select(F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") - F.expr(f"INTERVAL {window}")).first()[0]


def attach_step(windows: WindowStore, out: str) -> Callable[[DataFrame, int], None]:
    """The slow pings of one micro-batch with the trip that is active by the windows published when it runs."""
    def step(batch: DataFrame, batch_id: int) -> None:
        with landed(slow_from_messages(batch), windows.spark) as pings:
            live.attach_trip(pings, windows.for_pings(pings)).write.mode("overwrite").parquet(
                f"{out}/{series.Range(batch_id, batch_id, 0).folder}")
    return step


# ---- queries ----

def run_each_batch(rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict,
                   mode: str = "append") -> StreamingQuery:
    return (rows.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def _alerts(quick: DataFrame, slow: DataFrame, store: WindowStore, out: str, clock: Clock, as_of: Clock,
            window: str) -> dict[str, Callable[[dict], StreamingQuery]]:
    """How to start each alert stream, by name, slow messages first. Messages sent twice count once."""
    def start(name: str, rows: DataFrame, step: Callable[[DataFrame, int], None], mode: str):
        return lambda trigger: run_each_batch(rows, step, f"{out}/_checkpoints/{name}", trigger, mode)

    # positions are a maximum per vehicle, so a message sent twice moves nothing
    positions = live.position_state(quick_from_messages(quick))
    return {"slow": start("slow", once(slow), slow_step(store, out, clock), "append"),
            "quick": start("quick", once(quick), incident_step(store, out, clock), "append"),
            "status": start("status", positions, status_step(out, as_of, window, store.spark), "update")}


def start_alerts(quick: DataFrame, slow: DataFrame, windows: DataFrame, out: str,
                 quick_trigger: dict | None = None, slow_trigger: dict | None = None, clock: Clock = wall_clock,
                 as_of: Clock = wall_clock, window: str = RECENT_WINDOW) -> list[StreamingQuery]:
    """The alert streams, over trip windows that are published first.

    Windows published at ``f"{out}/windows"`` later on (:class:`coldhaul.streaming.windows.WindowStore`) count from the next batch.
    """
    store = WindowStore(windows.sparkSession, f"{out}/windows")
    store.publish(windows)
    triggers = {"slow": slow_trigger or SLOW_TRIGGER}
    return [start(triggers.get(name, quick_trigger or QUICK_TRIGGER))
            for name, start in _alerts(quick, slow, store, out, clock, as_of, window).items()]


def replay_alerts(quick: DataFrame, slow: DataFrame, windows: DataFrame, out: str, window: str = RECENT_WINDOW) -> None:
    """Drain what has arrived, slow messages first, so that the status is coloured by all of it."""
    store = WindowStore(windows.sparkSession, scratch_path(windows.sparkSession, "trip-windows"))
    store.publish(windows)
    for start in _alerts(quick, slow, store, out, at_event_time, at_event_time, window).values():
        start(DRAIN).awaitTermination()


def late_rows(query: StreamingQuery) -> int:
    """Messages that came later than the guard against repeats allows and were left out, by the query's recent progress."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


def read_status(spark: SparkSession, out: str) -> DataFrame:
    """The status of all vehicles as the last batch left it, colours included."""
    positions = read_state(spark, f"{out}/positions", POSITION_SCHEMA)
    blank = positions.withColumns({"incident_color": F.lit("WHITE"), "incident_label": F.lit("OK")})
    return live.coloured(blank, latest_version(spark, f"{out}/colours", WORST_SCHEMA))
