"""Write modes: overwrite, replace by date or key, merge, upsert, append."""

from __future__ import annotations

import itertools
import logging
import os
import re
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul.session import cut, scratch_path
from coldhaul.sinks.key_map import KeyMap, bucket_of
from coldhaul.sinks.schema_log import beside, declare, declared, read_table
from coldhaul.sources.files import (
    child_names, make_folder, mounted_path, path_exists, remove, rename, scan_daily_slice, scan_folders)

log = logging.getLogger(__name__)

#: The folder value that Hive-style layouts give to rows without a partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: How many rows of a key share a file, about.
ROWS_PER_FILE = 1_000_000
#: The characters that Spark escapes in folder names.
_UNSAFE = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_overwrite(df: DataFrame, path: str, audit_path: str | None = None) -> int:
    """Replace the table at ``path``; the row count comes from the same job.

    An audit copy is best effort: its failure is logged and the job goes on.
    """
    counted, seen = _counted(df)
    counted.write.mode("overwrite").parquet(path)
    declare(df.sparkSession, path, df.schema, fresh=True)
    if audit_path is not None:
        try:
            df.sparkSession.read.schema(df.schema).parquet(path).write.mode("overwrite").parquet(audit_path)
        except Exception as problem:
            log.warning("skipped the audit copy at %s: %s", audit_path, problem)
    return seen.get["rows"]


def write_staging(df: DataFrame, table: str, fmt: str = "parquet", **options: str) -> int:
    """Replace a staging table: a path for file formats, a table name for ``fmt="jdbc"``."""
    counted, seen = _counted(df)
    writer = counted.write.format(fmt).mode("overwrite").options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", table).save()
    else:
        writer.save(table)
    return seen.get["rows"]


def write_file_per_key(df: DataFrame, folder: str, key: str, threads: int = 16,
                       rows_per_file: int = ROWS_PER_FILE) -> int:
    """CSV files named ``<key>.csv``, as a collector per vehicle leaves them; returns the number of files.

    A large key is written by several tasks, as ``<key>.csv``, ``<key>-1.csv`` and so on. Rows without a key go to
    ``none.csv``. On a mounted file system the tasks write the files under their names, and the folder appears when all are
    there; elsewhere Spark writes a folder per key, and the files are renamed one by one.
    """
    local = mounted_path(df.sparkSession, folder)
    if local is None:
        return _files_by_rename(df, folder, key, threads)
    return _files_by_task(df, folder, local, key, rows_per_file)


def _files_by_rename(df: DataFrame, folder: str, key: str, threads: int) -> int:
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "per-key")
    (df.withColumn("_shard", F.col(key)).hint("rebalance", F.col("_shard"))
     .write.partitionBy("_shard").csv(staged, header=True))

    def name_files(shard: str) -> int:
        stem = shard.split("=")[1].replace(NULL_PARTITION, "none")
        parts = [n for n in child_names(spark, f"{staged}/{shard}") if n.endswith(".csv")]
        for i, part in enumerate(parts):
            rename(spark, f"{staged}/{shard}/{part}", f"{folder}/{stem}{f'-{i}' if i else ''}.csv")
        return len(parts)

    make_folder(spark, folder)
    shards = [n for n in child_names(spark, staged) if n.startswith("_shard=")]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return sum(pool.map(name_files, shards))


def _files_by_task(df: DataFrame, folder: str, local: str, key: str, rows_per_file: int) -> int:
    """Each file is written by one task, in a draft folder first, so a task that runs again overwrites its own files."""
    spark, draft = df.sparkSession, f"{folder.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    if path_exists(spark, folder):
        raise FileExistsError(folder)
    stem = F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), F.lit("none"))
    rows = df.select(stem.alias("stem"), F.to_csv(F.struct(*[F.col(c) for c in df.columns])).alias("line"))
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(df.columns)]))).first()[0]
    # at most a row per full file
    large = (rows.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_file)
             .select("stem", F.ceil(F.col("n") / rows_per_file).alias("pieces")))
    piece = F.coalesce(F.pmod(F.xxhash64("line"), "pieces"), F.lit(0))
    placed = (rows.join(F.broadcast(large), "stem", "left").select("stem", piece.alias("piece"), F.col("line").cast("binary").alias("line"))
              .repartition("stem", "piece").sortWithinPartitions("stem", "piece"))
    make_folder(spark, draft)
    at = f"{local.rstrip('/')}{draft[len(folder.rstrip('/')):]}"
    write = _named_writer(at, header.encode())
    written = placed.mapInPandas(write, "files long").agg(F.sum("files")).first()[0] or 0
    if sum(n.endswith(".csv") for n in os.listdir(at)) != written:
        raise FileExistsError(f"two keys of {folder} give one file name")
    rename(spark, draft, folder)
    return written


def _named_writer(folder: str, header: bytes):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in zip(b["stem"], b["piece"], b["line"]))
        # a draft folder of its own: tasks that create files in one folder wait for each other
        own, count = f"{folder}/_{uuid.uuid4().hex}.tmp", 0
        os.mkdir(own)
        for (stem, piece), group in itertools.groupby(rows, key=lambda r: r[:2]):
            name = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", stem) + (f"-{piece}" if piece else "") + ".csv"
            with open(f"{own}/{name}", "wb") as out:
                out.write(header + b"\n")
                out.writelines(line + b"\n" for _, _, line in group)
            os.replace(f"{own}/{name}", f"{folder}/{name}")
            count += 1
        os.rmdir(own)
        yield pd.DataFrame({"files": [count]})
    return write


def write_partitioned(df: DataFrame, path: str, column: str, dynamic: bool = False) -> None:
    """Overwrite a partitioned table, or only the partitions present if ``dynamic``.

    Rows are rebalanced by the partition column first: each partition gets few files, and a
    large one is still written by many tasks.
    """
    forget_keys(df.sparkSession, path)
    _overwrite(df.hint("rebalance", F.col(column)), path, column, dynamic)


def _overwrite(df: DataFrame, path: str, column: str, dynamic: bool) -> None:
    """The columns are declared before the files: a column too many is null, one too few would be lost."""
    declare(df.sparkSession, path, df.schema, fresh=not dynamic)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy(column).parquet(path))


def forget_keys(spark: SparkSession, path: str) -> None:
    """A write that does not go through the map of keys makes it untrue; the next merge builds it anew."""
    remove(spark, beside(path, "_keys"))


def folder_of(column: str, value: object) -> str:
    """The folder of a partition value, a date or a number, or of rows without one."""
    return f"{column}={NULL_PARTITION if value is None else value}"


def replace_partition(day_rows: DataFrame, path: str, column: str, day: date | None) -> int:
    """Replace one date partition, of undated rows if ``day`` is None; an empty slice clears it."""
    counted, seen = _counted(day_rows.drop(column))
    forget_keys(day_rows.sparkSession, path)
    declare(day_rows.sparkSession, path, T.StructType([*counted.schema, T.StructField(column, T.DateType())]))
    counted.write.mode("overwrite").parquet(f"{path}/{folder_of(column, day)}")
    return seen.get["rows"]


def replace_partitions(df: DataFrame, path: str, column: str, values: Iterable[object], keys_known: bool = False) -> None:
    """Replace exactly the partitions of ``values``, which hold all rows of ``df``; those without a row are emptied.

    The rows are written to the shared folder first, so ``df`` may read the table. The folders found there tell the
    filled partitions, and the others are removed as folders: no job runs per partition.
    """
    spark, staged = df.sparkSession, scratch_path(df.sparkSession, "staged")
    if not keys_known:
        forget_keys(spark, path)
    df.hint("rebalance", F.col(column)).write.partitionBy(column).parquet(staged)
    filled = {n for n in child_names(spark, staged) if n.startswith(f"{column}=")}
    if filled:
        _overwrite(spark.read.schema(df.schema).parquet(staged), path, column, dynamic=True)
    for emptied in {folder_of(column, v) for v in values} - filled:
        remove(spark, f"{path}/{emptied}")
    remove(spark, staged)


def read_partitioned(spark: SparkSession, path: str, column: str, kind: T.DataType | None = None) -> DataFrame:
    """A partitioned table with all its declared columns, and a declared type (a date) of the partition column."""
    return read_table(spark, path, T.StructField(column, kind or T.DateType()))


def read_partitions(spark: SparkSession, path: str, column: str, values: Iterable[object]) -> DataFrame:
    """The rows of some partitions of a table; only their folders are named, no others are listed."""
    schema = declared(spark, path) or read_partitioned(spark, path, column).schema
    return scan_folders(spark, path, schema, sorted({folder_of(column, v) for v in values}))


def read_span(spark: SparkSession, path: str, column: str, first: date | None, last: date | None) -> DataFrame:
    """The rows of the date partitions from ``first`` to ``last``, as far as there are; undated rows are left out."""
    schema = declared(spark, path) or read_partitioned(spark, path, column).schema
    dated = [n for n in child_names(spark, path) if n.startswith(f"{column}=") and not n.endswith(NULL_PARTITION)]
    return scan_folders(spark, path, schema, [n for n in dated if (first is None or n >= f"{column}={first}")
                                              and (last is None or n <= f"{column}={last}")])


def copy_partition_forward(spark: SparkSession, src: str, dst: str, schema, column: str,
                           day: date, to_column: str = "dt") -> int:
    """Copy one date's rows to the next zone and return how many there were."""
    rows = scan_daily_slice(spark, src, schema, column, day).drop(column)
    return replace_partition(rows, dst, to_column, day)


def on_day(ts: str, day: date) -> Column:
    """A half-open range, which reaches the Parquet scan as a filter."""
    nxt = day + timedelta(days=1)
    return ((F.col(ts) >= F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
            & (F.col(ts) < F.lit(f"{nxt} 00:00:00").cast("timestamp_ntz")))


def replace_by_key(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Drop target rows whose key is in ``rows``, then add ``rows``."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows)


def replace_by_start_date(target: DataFrame, rows: DataFrame, ts: str, day: date) -> DataFrame:
    """Drop target rows starting on ``day``, then add ``rows``; undated rows stay."""
    return target.where(~F.coalesce(on_day(ts, day), F.lit(False))).unionByName(rows)


def insert_if_absent(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Add the seed rows whose key does not exist yet."""
    return existing.unionByName(seed.join(existing.select(key), key, "left_anti"))


def append_new_columns(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Union by name; columns only one side has are null on the other."""
    return target.unionByName(rows, allowMissingColumns=True)


def _key_map(spark: SparkSession, path: str, schema: T.StructType, key: str, part: str) -> KeyMap:
    return KeyMap(spark, path, schema[key], schema[part])


def build_key_map(spark: SparkSession, path: str, key: str, part: str) -> None:
    """Learn the places of all keys from the table, so that the first merge need not."""
    target = read_table(spark, path)
    _key_map(spark, path, target.schema, key, part).build(target.select(key, part))


def merge_partitions(path: str, updates: DataFrame, key: str, part: str, replaced: DataFrame | None = None) -> None:
    """Merge into a table partitioned by ``part``, rewriting only the touched partitions.

    Touched are the partitions of the updates and those where their keys may lie by the map of keys; rows without a
    partition value are a partition like any other. Rows of the keys in ``replaced`` go even if no update has them. A merge
    reads the map and the touched partitions, and no other file of the table.
    """
    spark = updates.sparkSession
    updates = cut(updates, "merge-updates")
    if not path_exists(spark, path):
        write_partitioned(updates, path, part)
        _key_map(spark, path, updates.schema, key, part).build(updates)
        return
    keys = updates.select(key)
    if replaced is not None:
        keys = cut(keys.unionByName(replaced.select(key)).distinct(), "replaced-keys")
    schema = declare(spark, path, updates.schema)
    known = _key_map(spark, path, schema, key, part)
    if not known.exists():
        known.build(read_table(spark, path).select(key, part))
    # numbers below the count of buckets, and one row per touched date at most
    buckets = [r[0] for r in keys.select(bucket_of(key)).distinct().collect()]
    held = known.lookup(keys, buckets).unionByName(updates.select(F.col(part).alias("part"))).distinct()
    touched = [r[0] for r in held.collect()]
    generation = known.add(updates.select(key, part))
    target = read_partitions(spark, path, part, touched)
    merged = append_new_columns(target.join(keys, key, "left_anti"), updates)
    replace_partitions(merged, path, part, touched, keys_known=True)
    known.settle(generation)


def upsert_positions(status: DataFrame, latest: DataFrame) -> DataFrame:
    """New positions move known vehicles and keep their colour; new vehicles start WHITE / OK.

    A position older than the stored one, or without a time, comes too late and moves nothing.
    """
    new = latest.select("vehicle_id", *[F.col(c).alias(f"_{c}")
                                        for c in ("lat", "lon", "event_time")])
    newer = F.col("last_event_time").isNull() | F.coalesce(F.col("_event_time") >= F.col("last_event_time"), F.lit(False))
    moved = F.col("_lat").isNotNull() & (F.col("lat").isNull() | newer)
    return status.join(new, "vehicle_id", "full_outer").select(
        "vehicle_id",
        F.when(moved, F.col("_lat")).otherwise(F.col("lat")).alias("lat"),
        F.when(moved, F.col("_lon")).otherwise(F.col("lon")).alias("lon"),
        F.when(moved, F.col("_event_time")).otherwise(F.col("last_event_time")).alias("last_event_time"),
        F.coalesce("incident_color", F.lit("WHITE")).alias("incident_color"),
        F.coalesce("incident_label", F.lit("OK")).alias("incident_label"))
