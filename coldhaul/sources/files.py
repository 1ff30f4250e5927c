"""Batch readers: string CSV, Parquet tables, dated slices and per-vehicle files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul import schemas


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file; nothing happens if it is missing."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder or file to a name that must be free."""
    fs, p = _hadoop(spark, path)
    target = _hadoop(spark, to)[1]
    if fs.exists(target) or not fs.rename(p, target):
        raise FileExistsError(to)


def mounted_path(spark: SparkSession, path: str) -> str | None:
    """The path as tasks can open it themselves, if it lies on a mounted file system."""
    fs, p = _hadoop(spark, path)
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it is missing."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of our own, whole."""
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if the name is taken, by whatever it holds."""
    fs, p = _hadoop(spark, path)
    if fs.exists(p):
        return False
    draft = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = fs.rename(draft, p)
    if not done:
        fs.delete(draft, False)
    return done


def scan_csv_strings(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header, every declared column a string."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def scan_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven landing files ``<table>.csv`` as string tables."""
    return {name: scan_csv_strings(spark, f"{folder}/{name}.csv", schema)
            for name, schema in schemas.RAW.items()}


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; a folder without Parquet files is an error."""
    if not any(name.endswith(".parquet") or "=" in name for name in child_names(spark, path)):
        raise FileNotFoundError(f"no Parquet files under {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_days(spark: SparkSession, path: str, schema: T.StructType, column: str,
              days: Iterable[date]) -> DataFrame:
    """Only the given date partitions of a table. Missing ones add no rows.

    The partition folders are named directly, so other partitions are not even listed.
    """
    full = T.StructType([f for f in schema.fields if f.name != column]
                        + [T.StructField(column, T.DateType())])
    return scan_folders(spark, path, full, [f"{column}={d}" for d in days])


def scan_folders(spark: SparkSession, path: str, schema: T.StructType, folders: Iterable[str]) -> DataFrame:
    """The rows of the named partition folders of a table; missing ones add none."""
    found = [p for p in (f"{path}/{f}" for f in folders) if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def scan_daily_slice(spark: SparkSession, path: str, schema: T.StructType, column: str,
                     day: date) -> DataFrame:
    """One date partition; a quiet day is an empty table, not an error."""
    return scan_days(spark, path, schema, column, [day])


def scan_sharded_by_vehicle(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One CSV per vehicle, the vehicle number taken from the file name; null under another name.

    The folder is listed once: a pattern would be expanded to a path per file, and each be listed again.
    """
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.csv").csv(folder, header=True, enforceSchema=False)
    # the names stay in the JVM
    if not len(rows._jdf.inputFiles()):
        raise FileNotFoundError(f"no CSV files under {folder}")
    return (rows.withColumn("vehicle_id", F.regexp_extract(
                F.col("_metadata.file_name"), r"^(\d+)", 1).try_cast("bigint")))


def scan_vehicle_folders(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """CSV files in one ``shard=<vehicle>`` folder per vehicle, as Spark writes them."""
    return (spark.read.schema(schema).csv(f"{folder}/shard=*", header=True, enforceSchema=False)
            .withColumn("vehicle_id", F.regexp_extract(
                F.col("_metadata.file_path"), r"shard=(\d+)/", 1).try_cast("bigint")))


def register_sources(spark: SparkSession, tables: dict[str, DataFrame], prefix: str = "stg_") -> None:
    """Declare tables under their source names for SQL use."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
