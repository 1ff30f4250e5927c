"""Per-stage date checkpoints."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul import schemas
from coldhaul.sinks.tables import insert_if_absent
from coldhaul.sources.files import path_exists

# The stages and the last day of the historical load.
STAGES = ["bronze", "silver", "telemetry", "staging", "dbt"]
BACKFILL_END = date(2025, 5, 8)
UNKNOWN_ROWS = -1


def seed_rows(spark: SparkSession, last: date = BACKFILL_END) -> DataFrame:
    return spark.createDataFrame([(s, last, None, None, "seeded") for s in STAGES],
                                 schemas.CHECKPOINTS)


def checkpoints_seed(existing: DataFrame, last: date = BACKFILL_END) -> DataFrame:
    return insert_if_absent(existing, seed_rows(existing.sparkSession, last), "stage_name")


def next_target_date(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.select("stage_name", F.date_add("last_processed_date", 1).alias("target_date"))


def checkpoint_report(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.orderBy("stage_name")


class ControlTable:
    """The checkpoint table on disk, as an append-only log.

    Every seed, advance and rewind appends rows with the next sequence number, and the
    newest row of a stage counts. A crash before the append leaves the stage where it was.
    The log has a handful of rows per processed day and one writer.
    """

    def __init__(self, spark: SparkSession, path: str, last: date = BACKFILL_END):
        self.spark, self.path, self.last = spark, path, last

    def _log(self) -> DataFrame:
        schema = T.StructType([*schemas.CHECKPOINTS.fields, T.StructField("seq", T.LongType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def current(self) -> DataFrame:
        columns = schemas.CHECKPOINTS.names
        newest = self._log().groupBy("stage_name").agg(
            F.max_by(F.struct(*columns[1:]), "seq").alias("r"))
        return newest.select("stage_name", "r.*")

    def _append(self, rows: DataFrame) -> None:
        seq = self._log().agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
        rows.withColumn("seq", F.lit(seq).cast("bigint")).write.mode("append").parquet(self.path)

    def ensure(self) -> None:
        """Seed the stages that are missing; doing it again changes nothing."""
        missing = seed_rows(self.spark, self.last).join(self.current(), "stage_name", "left_anti")
        if not missing.isEmpty():
            self._append(missing)

    def target(self, stage: str) -> date:
        row = self.current().where(F.col("stage_name") == stage).first()
        if row is None:
            self.ensure()
            row = self.current().where(F.col("stage_name") == stage).first()
        return row["last_processed_date"] + timedelta(days=1)

    def _set(self, stage: str, day: date, rows: int | None, status: str) -> None:
        """Log a stage that the table has; an unknown stage changes nothing."""
        if self.current().where(F.col("stage_name") == stage).isEmpty():
            return
        now = datetime.now()
        self._append(self.spark.createDataFrame([(stage, day, now, rows, status)],
                                                schemas.CHECKPOINTS))

    def advance(self, stage: str, day: date, rows: int) -> None:
        """The last step of a stage, after its work succeeded."""
        self._set(stage, day, rows, "success")

    def rewind(self, stage: str, day: date) -> None:
        """Set a stage back, to process the days after ``day`` again."""
        self._set(stage, day, None, "rewound")
