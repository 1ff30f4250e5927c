"""The star stored for the questions: sums per surrogate key and day, bucketed by key beside the dimensions.

A question then sums per key and joins the dimension without an exchange on the fact's side. Rows are kept per key and
day, not per trip, so the trips of a busy driver or route do not meet in one bucket: each key has a row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coldhaul.plans import bi
from coldhaul.session import together

# role -> key of the fact, key of the dimension
ROLES = {"driver": ("driver_key_sk", "driver_sk"), "vehicle": ("vehicle_key_sk", "vehicle_sk"),
         "route": ("route_key_sk", "route_sk")}
DAY = "start_date_key_sk"


class StarStore:
    """Bucketed tables ``<name>_<role>_sums`` and ``<name>_<role>_dim`` under ``root``.

    The bucket layout is known to the session's catalog only; ``attach`` tells it to another session, which has to name
    the same number of buckets.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "star", buckets: int = 200):
        self.spark, self.root, self.name, self.buckets = spark, root.rstrip("/"), name, buckets

    def _table(self, role: str, part: str) -> str:
        return f"{self.name}_{role}_{part}"

    def _path(self, role: str, part: str) -> str:
        return f"{self.root}/{role}_{part}"

    def _write(self, df: DataFrame, role: str, part: str, key: str) -> None:
        # by the bucket key, so that a bucket is one file
        (df.repartition(self.buckets, key).write.mode("overwrite").bucketBy(self.buckets, key).sortBy(key)
         .option("path", self._path(role, part)).format("parquet").saveAsTable(self._table(role, part)))

    def write(self, fact: DataFrame, dims: dict[str, DataFrame]) -> None:
        """Replace all tables; ``dims`` has a dimension per role. ``fact`` is scanned once per role, for its columns only."""
        jobs = []
        for role, (key, dim_key) in ROLES.items():
            jobs.append(lambda role=role, key=key: self._write(bi.sums_of(fact, key, DAY), role, "sums", key))
            jobs.append(lambda role=role, key=dim_key: self._write(dims[role], role, "dim", key))
        together(*jobs)

    def attach(self) -> None:
        """Make the tables known to a session that did not write them."""
        for role, keys in ROLES.items():
            for part, key in zip(("sums", "dim"), keys):
                path = self._path(role, part)
                schema = self.spark.read.parquet(path).schema
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self._table(role, part)} ({columns}) USING parquet "
                    f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def sums(self, role: str) -> DataFrame:
        return self.spark.table(self._table(role, "sums"))

    def dim(self, role: str) -> DataFrame:
        return self.spark.table(self._table(role, "dim"))
