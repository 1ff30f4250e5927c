"""Trip windows by day for running streams, which take up changes without a restart.

Each publication is a version: its days are written under ``_day=<day>/version=<name>``, and then a small file under ``_published`` names
them. What a publication that was cut off has written has a name that no file gives. A batch reads, for each day it has pings on, the newest published version of that day, so it sees a whole
version or the one before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul.sources.files import child_names, read_text, scan_folders, write_text


class WindowStore:
    """The published windows at a path. Any process may publish while streams read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._seen: dict[int, dict] = {}

    def _versions(self) -> dict[int, dict]:
        """All publications; each is read once."""
        for name in child_names(self.spark, f"{self.path}/_published"):
            if name.endswith(".json") and int(name[:-5]) not in self._seen:
                self._seen[int(name[:-5])] = json.loads(read_text(self.spark, f"{self.path}/_published/{name}"))
        return self._seen

    def publish(self, windows: DataFrame, days: Iterable[date] | None = None) -> int:
        """Write the windows by day, see :func:`coldhaul.operators.asof.window_days`; returns the version.

        ``windows`` replaces the given days, those without a window too, or all days if none are given.
        """
        version = max(self._versions(), default=0) + 1
        if days is not None:
            days = sorted(days)
            windows = windows.where(F.col("_day").isin(days))
        name = f"{version}-{uuid.uuid4().hex[:8]}"
        (windows.withColumn("version", F.lit(name)).hint("rebalance", F.col("_day"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_day", "version").parquet(self.path))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in windows.schema])
        given = None if days is None else [str(d) for d in days]
        if not write_text(self.spark, f"{self.path}/_published/{version:08d}.json",
                          json.dumps({"days": given, "name": name, "schema": schema.jsonValue()})):
            raise RuntimeError(f"version {version} of the windows was published by another process")
        return version

    def _version_of(self, day: date) -> str | None:
        for _, what in sorted(self._versions().items(), reverse=True):
            if what["days"] is None or str(day) in what["days"]:
                return what["name"]
        return None

    def read(self, days: Iterable[date]) -> DataFrame:
        """The windows of the days; only the folders of their newest versions are named."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no windows are published at {self.path}")
        schema = T.StructType.fromJson(versions[max(versions)]["schema"])
        full = T.StructType([*schema, T.StructField("version", T.StringType())])
        found = {d: self._version_of(d) for d in days}
        return scan_folders(self.spark, self.path, full, [
            f"_day={d}/version={v}" for d, v in found.items() if v is not None]).drop("version")

    def for_pings(self, pings: DataFrame) -> DataFrame:
        """The windows of the days a micro-batch has pings on, as far as there are windows of those days."""
        known = [n.split("=")[1] for n in child_names(self.spark, self.path) if n.startswith("_day=")]
        first, last = (F.lit(d).cast("date") for d in (min(known, default=None), max(known, default=None)))
        present = pings.select(F.to_date("event_time").alias("d")).where(F.col("d").between(first, last)).distinct()
        # at most one row per day that has windows
        return self.read([r[0] for r in present.collect()])
