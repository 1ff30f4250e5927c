"""The declared columns of the lake's tables.

A table grows columns over its life, and its files differ. Instead of opening every footer to find the union, each writer
declares the columns it writes; a version is logged when the union changes, and a reader takes the newest. A log lies beside its
table, under ``_schemas``, as one small file per version.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from coldhaul.sources.files import child_names, read_text, write_text


def beside(path: str, kind: str) -> str:
    """Where what is kept of this kind about the table at ``path`` lies: outside of it, so that overwriting it spares it."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/{kind}/{name}"


def _newest(spark: SparkSession, path: str) -> tuple[int, T.StructType | None]:
    log = beside(path, "_schemas")
    versions = [n for n in child_names(spark, log) if n.endswith(".json")]
    if not versions:
        return 0, None
    return int(versions[-1][1:-5]), T.StructType.fromJson(json.loads(read_text(spark, f"{log}/{versions[-1]}")))


def declared(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of the table, or None if no writer has declared any."""
    return _newest(spark, path)[1]


def union(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns and then the new ones; a column that changes its type is an error."""
    known = {f.name: f for f in old}
    for f in new:
        if f.name in known and f.dataType.simpleString() != known[f.name].dataType.simpleString():
            raise ValueError(f"column {f.name} is declared as {known[f.name].dataType.simpleString()}, "
                             f"not {f.dataType.simpleString()}")
    return T.StructType([*old, *[f for f in new if f.name not in known]])


def declare(spark: SparkSession, path: str, schema: T.StructType, fresh: bool = False) -> T.StructType:
    """Add the columns to those declared, or replace them if the table is written anew; returns what then holds."""
    columns = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    while True:
        version, old = _newest(spark, path)
        wanted = columns if fresh or old is None else union(old, columns)
        if wanted == old:
            return wanted
        # another writer may take the number first; then the union is made anew
        if write_text(spark, f"{beside(path, '_schemas')}/v{version + 1:08d}.json", wanted.json()):
            return wanted


def read_table(spark: SparkSession, path: str, *typed: T.StructField) -> DataFrame:
    """A table by its declared columns, without a look into its files.

    A table that nobody declared is read by its footers once, and declared. ``typed`` fixes the type of partition columns, which
    Spark would guess from the folder names, of which a single odd one makes all of them strings.
    """
    known = declared(spark, path)
    if known is None:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
        fixed = {f.name for f in typed}
        known = declare(spark, path, T.StructType([*[f for f in found if f.name not in fixed], *typed]))
    return spark.read.schema(known).parquet(path)
