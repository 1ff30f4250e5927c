"""Order-dependent operators that never hold one key's rows in one task.

A plain window over a hot key sorts all of that key's rows in a single task. Here the
rows of a key are cut into time chunks: the window runs inside ``(key, chunk)``, and only
one edge value per chunk travels between chunks. The number of chunks of a key is bounded
by the covered time span divided by the chunk width, not by the number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldhaul.functions.columns import minute_index
from coldhaul.session import cut

NO_CHUNK = -(2**62)
#: Rows without a timestamp are chunked by so many leading characters, or so many numbers, of the tie-breaker.
TIE_CHARACTERS = 6
TIE_NUMBERS = 4096


def time_chunk(ts: str, minutes: int) -> Column:
    """Chunk number of a timestamp; rows without one share a number that sorts first."""
    return F.coalesce(F.floor(minute_index(ts) / minutes).cast("bigint"), F.lit(NO_CHUNK))


def _chunk(df: DataFrame, keys: list[str], ts: str, tie: list[str], minutes: int) -> Column:
    """Key and time chunk; rows without a timestamp are split further, in the order of the first tie-breaker.

    A struct is never null itself, so that joining by it adds no filter on either side.
    """
    text = not tie or isinstance(df.schema[tie[0]].dataType, T.StringType)
    first = F.col(tie[0]) if tie else F.lit("")
    part = F.substring(first, 1, TIE_CHARACTERS) if text else F.floor(first / TIE_NUMBERS).cast("bigint")
    unsplit = F.lit("") if text else F.lit(NO_CHUNK)
    return F.struct(*keys, time_chunk(ts, minutes).alias("_time"),
                    F.coalesce(F.when(F.col(ts).isNull(), part), unsplit).alias("_tie"))


def _neighbour(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str, out: str,
               minutes: int, ahead: bool) -> DataFrame:
    """One window per (key, chunk) marks the rows at the edges; only those are looked at across chunks.

    Both uses of the window read all columns, so they share its exchange and the scan under it, and the join's
    key is the window's, without null-safe equality that would shuffle again.
    """
    inside = Window.partitionBy("_chunk").orderBy(ts, *tie)
    here, there = (F.lead, F.lag) if ahead else (F.lag, F.lead)
    shifted = df.withColumn("_chunk", _chunk(df, keys, ts, tie, minutes)).withColumns({
        "_inner": here(value).over(inside),
        "_at_edge": here(F.lit(True)).over(inside).isNull(),
        "_at_end": there(F.lit(True)).over(inside).isNull()})
    # the row that the next chunk over looks back to; one per chunk, whole so that no column is pruned below
    edges = shifted.where("_at_end").groupBy("_chunk").agg(F.first(F.struct(*df.columns)).alias("_row"))
    across = Window.partitionBy(*[F.col("_chunk")[k] for k in keys]).orderBy("_chunk")
    carried = edges.select("_chunk", here(F.col("_row")[value]).over(across).alias("_carry"))
    return (shifted.join(carried, "_chunk", "left")
            .withColumn(out, F.when(F.col("_at_edge"), F.col("_carry")).otherwise(F.col("_inner")))
            .select(*df.columns, out))


def previous_value(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str, out: str,
                   minutes: int = 10) -> DataFrame:
    """``lag(value)`` per key in the order ``(ts, *tie)``, safe for hot keys."""
    return _neighbour(df, keys, ts, tie, value, out, minutes, ahead=False)


def next_value(df: DataFrame, keys: list[str], ts: str, tie: list[str], value: str, out: str,
               minutes: int = 7 * 1440) -> DataFrame:
    """``lead(value)`` per key in the order ``(ts, *tie)``, safe for hot keys."""
    return _neighbour(df, keys, ts, tie, value, out, minutes, ahead=True)


def dedupe_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the one with most values, and of those the smallest over all remaining columns.

    The survivor depends only on the data, and the minimum is combined map-side, so a key
    repeated in a third of all rows costs one row per map task in the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    empty = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in rest], F.lit(0))
    best = df.groupBy(*keys).agg(F.min(F.struct(empty.alias("_empty"), *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                         for c in df.columns])


def dedupe_full_row(df: DataFrame) -> DataFrame:
    return df.distinct()


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def latest_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key in the order given, by a map-side combined maximum."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c)
                         for c in df.columns])


def resequence(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Number all rows from 0 in a total order, without a one-task window.

    Range partitions are sorted and numbered on their own, written once (so that the
    sampled bounds are fixed), and shifted by the row count of the partitions before them.
    The offsets table has one row per range partition.
    """
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_seq", F.monotonically_increasing_id()))
    # the id holds the partition number in its upper 31 bits and the row number below
    ranged = cut(ranged.select(*df.columns, F.shiftright("_seq", 33).alias("_part"),
                               F.col("_seq").bitwiseAND(F.lit(2**33 - 1)).alias("_pos")),
                 "resequence")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (ranged.join(offsets, "_part")
            .select(*df.columns, (F.col("_offset") + F.col("_pos")).alias(out)))


def top_rows(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The first rows of a total order; each task keeps at most ``limit`` rows."""
    return df.orderBy(*order).limit(limit)
