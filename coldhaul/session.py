"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even where that costs the shuffle saved downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash instead of sort when every partition of a join side is measured to be this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "96MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "coldhaul", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return root


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="coldhaul-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; it does not exist yet."""
    return f"{shared_root(spark).rstrip('/')}/coldhaul/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, ending its lineage."""
    return cut_at(df, name)[0]


def cut_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same with the path, for tables that are removed once what was made of them is written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def together(*jobs: Callable[[], object]) -> list:
    """Submit independent Spark jobs at once and wait for all; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
