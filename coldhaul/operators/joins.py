"""Key checks and table-to-table joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_known(df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Keep rows whose every foreign key exists in its parent table."""
    columns = df.columns
    for key, parent in parents.items():
        df = df.join(parent.select(key), key, "left_semi")
    return df.select(*columns)


def row_loss(df: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Rows before and after the key check, in one aggregate over flagged rows."""
    flagged = df
    for key, parent in parents.items():
        known = parent.select(key).where(F.col(key).isNotNull()).distinct()
        flagged = flagged.join(known.withColumn(f"_has_{key}", F.lit(True)), key, "left")
    good = F.lit(True)
    for key in parents:
        good = good & F.col(f"_has_{key}").isNotNull()
    return flagged.agg(F.count(F.lit(1)).alias("rows_before"),
                       F.count_if(good).alias("rows_after"),
                       F.count_if(~good).alias("rows_dropped"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a non-null key that the parent lacks."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def anti_join_reset(status: DataFrame, recent: DataFrame) -> DataFrame:
    """Status rows of vehicles without a recent incident become WHITE / OK."""
    busy = recent.where(F.col("vehicle_id").isNotNull()).select("vehicle_id")
    return (status.join(busy, "vehicle_id", "left_anti")
            .withColumns({"incident_color": F.lit("WHITE"), "incident_label": F.lit("OK")}))


def update_from_join(status: DataFrame, ranked: DataFrame) -> DataFrame:
    """Take colour, label and time from the ranked incident where a vehicle has one."""
    newer = ranked.select(
        "vehicle_id", F.col("incident_color").alias("_color"),
        F.col("incident_type").alias("_label"), F.col("event_time").alias("_time"))
    hit = F.col("_color").isNotNull()

    def pick(new: str, old: str):
        return F.when(hit, F.col(new)).otherwise(F.col(old))

    return (status.join(newer, "vehicle_id", "left")
            .withColumns({"incident_color": pick("_color", "incident_color"),
                          "incident_label": pick("_label", "incident_label"),
                          "last_event_time": pick("_time", "last_event_time")})
            .drop("_color", "_label", "_time"))


def decode_routes(route_ids: DataFrame, n_depots: int) -> DataFrame:
    """Origin and destination of numbered routes.

    Routes number the ordered depot pairs (origin first, no self pairs), so each id gives
    its pair by arithmetic and no pairs are enumerated.
    """
    r = F.col("route_id")
    origin = F.floor(r / (n_depots - 1)).cast("bigint")
    slot = r % (n_depots - 1)
    return route_ids.select(
        "route_id", origin.alias("origin_depot_id"),
        (slot + F.when(slot >= origin, 1).otherwise(0)).cast("bigint").alias("destination_depot_id"))


def encode_route(origin: str, destination: str, n_depots: int):
    """The inverse of :func:`decode_routes`, as a column."""
    o, d = F.col(origin), F.col(destination)
    return o * (n_depots - 1) + d - F.when(d > o, 1).otherwise(0)
