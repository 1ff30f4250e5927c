"""In which partitions of a table its keys lie.

A merge has to know the partitions that hold the keys of its updates. The map answers that from a small table of (key, partition),
in folders by a hash of the key, of which it reads those that the updates can be in. A merge first adds the places its
rows go to and then writes them, so the map names at least the partitions where a key lies, even after a crash between the
two; a partition too many costs a rewrite of what it holds and no error. Additions are generations. A generation is settled when
its rows are written, and after some generations the map is folded: of a key everything before its newest settled place goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul.sinks.schema_log import beside
from coldhaul.sources.files import child_names, remove, scan_folders, write_text

BUCKETS = 32
MOST_GENERATIONS = 16
SETTLED = "_settled"


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


class KeyMap:
    """The map of one partitioned table, beside it under ``_keys``."""

    def __init__(self, spark: SparkSession, path: str, key: T.StructField, part: T.StructField):
        self.spark, self.root, self.key, self.part = spark, beside(path, "_keys"), key.name, part.name
        self.schema = T.StructType([
            T.StructField("key", key.dataType), T.StructField("part", part.dataType), T.StructField("seq", T.LongType()),
            T.StructField("sure", T.BooleanType()), T.StructField("bucket", T.IntegerType())])

    def _folder(self, generation: int) -> str:
        return f"{self.root}/gen={generation:010d}"

    def _generations(self) -> dict[int, list[str]]:
        """The complete generations, each with the names in its folder."""
        found = {int(n.split("=")[1]): child_names(self.spark, f"{self.root}/{n}")
                 for n in child_names(self.spark, self.root) if n.startswith("gen=")}
        return {g: names for g, names in found.items() if "_SUCCESS" in names}

    def exists(self) -> bool:
        return bool(self._generations())

    def _write(self, rows: DataFrame, generation: int) -> None:
        (rows.withColumn("bucket", _bucket(F.col("key"))).hint("rebalance", F.col("bucket"))
         .write.mode("overwrite").partitionBy("bucket").parquet(self._folder(generation)))

    def _next(self) -> int:
        taken = [int(n.split("=")[1]) for n in child_names(self.spark, self.root) if n.startswith("gen=")]
        return max(taken, default=0) + 1

    def add(self, rows: DataFrame, sure: bool = False) -> int:
        """Name the partitions of the rows' keys; returns the number of the generation, to settle once they are written."""
        generation = self._next()
        self._write(rows.where(F.col(self.key).isNotNull()).select(
            F.col(self.key).alias("key"), F.col(self.part).alias("part"), F.lit(generation).cast("long").alias("seq"),
            F.lit(sure).alias("sure")).distinct(), generation)
        return generation

    def settle(self, generation: int) -> None:
        write_text(self.spark, f"{self._folder(generation)}/{SETTLED}", "")
        if len(self._generations()) > MOST_GENERATIONS:
            self.fold()

    def build(self, target: DataFrame) -> None:
        """Start the map from the key and partition columns of the whole table."""
        self.drop()
        self.add(target, sure=True)

    def drop(self) -> None:
        remove(self.spark, self.root)

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """Entries of all generations, of the given buckets only if any are given; only their folders are named."""
        wanted = None if buckets is None else {f"bucket={b}" for b in buckets}
        folders = [f"gen={g:010d}/{n}" for g, names in self._generations().items() for n in names
                   if n.startswith("bucket=") and (wanted is None or n in wanted)]
        full = T.StructType([*self.schema, T.StructField("gen", T.LongType())])
        return scan_folders(self.spark, self.root, full, folders).drop("gen")

    def lookup(self, keys: DataFrame, buckets: list[int]) -> DataFrame:
        """The distinct partitions, as ``part``, where the keys may lie."""
        wanted = keys.select(F.col(self.key).alias("key"))
        return self.rows(buckets).join(wanted, "key", "left_semi").select("part").distinct()

    def fold(self) -> None:
        """One generation in place of all: per key its newest settled place and what was added since."""
        generations = self._generations()
        settled = [g for g, names in generations.items() if SETTLED in names]
        rows = self.rows().drop("bucket").withColumn("sure", F.col("sure") | F.col("seq").isin(settled))
        since = F.coalesce(F.max(F.when(F.col("sure"), F.col("seq"))), F.lit(0))
        kept = (rows.groupBy("key").agg(since.alias("since"), F.collect_set(F.struct("part", "seq", "sure")).alias("e"))
                .select("key", "since", F.explode("e").alias("e")).where(F.col("e.seq") >= F.col("since"))
                .select("key", "e.part", "e.seq", "e.sure"))
        self._write(kept, self._next())
        for generation in generations:
            remove(self.spark, self._folder(generation))


def bucket_of(key: str) -> Column:
    return _bucket(F.col(key))
