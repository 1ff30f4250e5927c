"""The data-quality gate over the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT = "fct_trip_operations"
# Key columns checked for uniqueness and nulls, and the fact's references.
KEYS = {
    "dim_vehicles": ["vehicle_sk", "vehicle_id"],
    "dim_drivers": ["driver_sk", "driver_id"],
    "dim_routes": ["route_sk", "route_id"],
    FACT: ["trip_sk", "trip_id_bk"],
}
REFERENCES = {
    "vehicle_key_sk": ("dim_vehicles", "vehicle_sk"),
    "driver_key_sk": ("dim_drivers", "driver_sk"),
    "route_key_sk": ("dim_routes", "route_sk"),
}


class QualityError(RuntimeError):
    """A test of the gate found violations."""


def _entries(model: str, df: DataFrame) -> DataFrame:
    """One row ``(audit, key, own, ref)`` per row of the model and key it holds.

    An audit is a key column of a model. The model's rows own their keys, and the fact's rows refer to those of dimensions.
    """
    def entry(audit: str, column: str, own: bool):
        return F.struct(F.lit(audit).alias("audit"), F.col(column).cast("string").alias("key"),
                        F.lit(int(own)).alias("own"), F.lit(int(not own)).alias("ref"))

    found = [entry(f"{model}_{c}", c, own=True) for c in KEYS[model]]
    if model == FACT:
        found += [entry(f"{parent}_{key}", column, own=False) for column, (parent, key) in REFERENCES.items()]
    return df.select(F.explode(F.array(*found)).alias("e")).select("e.*")


def summary(models: dict[str, DataFrame]) -> DataFrame:
    """One row ``(test, violations)`` per declared test of the models given.

    Every table is read once, for all its tests: its rows are counted per (audit, key), which combines before the shuffle, and
    a key's counts answer all of uniqueness, nulls and references.
    """
    given = [m for m in KEYS if m in models]
    counts = (reduce(DataFrame.unionByName, [_entries(m, models[m]) for m in given])
              .groupBy("audit", "key").agg(F.sum("own").alias("own"), F.sum("ref").alias("ref")))
    known = F.col("key").isNotNull()
    # a few rows: one per audit
    per_audit = counts.groupBy("audit").agg(
        F.count_if(known & (F.col("own") > 1)).alias("unique"),
        F.sum(F.when(~known, F.col("own"))).alias("not_null"),
        F.sum(F.when(known & (F.col("own") == 0), F.col("ref"))).alias("relationships"))
    tests = [(f"{kind}_{m}_{c}", f"{m}_{c}", kind) for m in given for c in KEYS[m] for kind in ("unique", "not_null")]
    tests += [(f"relationships_{FACT}_{column}", f"{parent}_{key}", "relationships")
              for column, (parent, key) in REFERENCES.items()]
    found = per_audit.unpivot(["audit"], ["unique", "not_null", "relationships"], "kind", "violations")
    declared = models[FACT].sparkSession.createDataFrame(tests, "test string, audit string, kind string")
    return declared.join(found, ["audit", "kind"], "left").select(
        "test", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def enforce(tests: DataFrame) -> None:
    """Fail the run on any violation. The summary has one row per declared test."""
    failed = tests.where(F.col("violations") > 0).collect()
    if failed:
        raise QualityError(", ".join(f"{r['test']}: {r['violations']}" for r in failed))
