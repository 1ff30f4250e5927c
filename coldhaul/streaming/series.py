"""Tables that a stream writes batch by batch, without growing slower with every batch.

A series is a folder with one subfolder per batch, ``batches=<first>-<last>-<level>``. A batch writes its own folder and overwrites it on
replay. Batches before the running one can't be replayed any more; sixteen neighbours of a level are folded into one folder of
the next level, so a series holds a few folders per level however old it is. A fold is written under a hidden name and renamed,
and a reader takes the widest folders, so it sees every batch once at any moment.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul.sources.files import child_names, remove, rename

FOLD = 16
COLUMN = "batches"


class Range(NamedTuple):
    """Neighbouring batches in one folder."""

    first: int
    last: int
    level: int

    @property
    def folder(self) -> str:
        return f"{COLUMN}={self.first}-{self.last}-{self.level}"


def of_batch(batch_id: int) -> str:
    """The partition value of a single batch."""
    return f"{batch_id}-{batch_id}-0"


def ranges(spark: SparkSession, series: str) -> list[Range]:
    """The folders that hold the series, in order; those that a wider one replaces are left out."""
    found = [Range(*map(int, n.split("=")[1].split("-"))) for n in child_names(spark, series) if n.startswith(f"{COLUMN}=")]
    kept: list[Range] = []
    for r in sorted(found, key=lambda r: (r.first, -r.last, -r.level)):
        if not kept or r.last > kept[-1].last:
            kept.append(r)
    return kept


def paths(spark: SparkSession, series: str, before: int | None = None) -> list[str]:
    return [f"{series}/{r.folder}" for r in ranges(spark, series) if before is None or r.last < before]


def read(spark: SparkSession, base: str, schema: T.StructType | str, folders: list[str]) -> DataFrame:
    """The rows of the folders, with the first batch of each row's folder as ``batch``."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not folders:
        return spark.createDataFrame([], T.StructType([*wanted, T.StructField("batch", T.LongType())]))
    full = T.StructType([*wanted, T.StructField(COLUMN, T.StringType())])
    rows = spark.read.schema(full).option("basePath", base).parquet(*folders)
    return rows.select(*wanted.names, F.substring_index(COLUMN, "-", 1).cast("bigint").alias("batch"))


def newest(rows: DataFrame, key: str) -> DataFrame:
    """The row of each key that the newest batch wrote."""
    rest = [c for c in rows.columns if c not in (key, "batch")]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def fold(spark: SparkSession, series: str, schema: T.StructType | str, before: int,
         merge: Callable[[DataFrame], DataFrame] = lambda rows: rows.drop("batch")) -> None:
    """Fold full levels among the batches before ``before``.

    What a fold replaces stays until the next one, for readers that have listed it already.
    """
    while True:
        held = ranges(spark, series)
        run = [r for r in held if r.last < before]
        level = run[-1].level if run else 0
        same = [r for r in run if r.level == level]
        if len(same) < FOLD:
            return
        _fold(spark, series, schema, held, same, merge)


def close(spark: SparkSession, series: str, schema: T.StructType | str, before: int,
          merge: Callable[[DataFrame], DataFrame] = lambda rows: rows.drop("batch")) -> None:
    """Fold all batches before ``before`` into one folder: for a series that gets no more."""
    held = ranges(spark, series)
    run = [r for r in held if r.last < before]
    if len(run) > 1:
        _fold(spark, series, schema, held, run, merge)


def _fold(spark: SparkSession, series: str, schema: T.StructType | str, held: list[Range], some: list[Range],
          merge: Callable[[DataFrame], DataFrame]) -> None:
    for name in child_names(spark, series):
        if name.startswith(f"{COLUMN}=") and name not in {r.folder for r in held}:
            remove(spark, f"{series}/{name}")
    wide = Range(some[0].first, some[-1].last, max(r.level for r in some) + 1)
    rows = merge(read(spark, series, schema, [f"{series}/{r.folder}" for r in some]))
    draft = f"{series}/_{wide.folder.replace('=', '-')}"
    # few files: a fold holds what some folders held, or less
    rows.coalesce(max(1, len(some) // 4)).write.mode("overwrite").parquet(draft)
    rename(spark, draft, f"{series}/{wide.folder}")
