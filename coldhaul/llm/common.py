"""Column expressions and two-level numbering shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
DRAW_BITS = 52


def n_words(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """A uniform long below 2^52 from the MD5 of the parts, joined by ':'; a null part counts as 'null'."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, DRAW_BITS // 4), 16, 10).cast("long")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: inside, it is a lambda variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(df: DataFrame, key: list[str], bucket: str, order: list[str], value: str, before: str,
            total: str | None = None) -> DataFrame:
    """Add ``before``: the sum of ``value`` over the rows of the same key that come earlier.

    Rows of a key are ordered by bucket, then by ``order``. Only one bucket of one key meets in a task; the
    totals of the buckets, at most one row each, are summed by key. ``total`` adds the sum over the key.
    """
    sums = df.groupBy(*key, bucket).agg(F.sum(value).alias("_part"))
    by_key = W.partitionBy(*key)
    earlier = by_key.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_offset", F.coalesce(F.sum("_part").over(earlier), F.lit(0)))
    if total:
        sums = sums.withColumn(total, F.sum("_part").over(by_key))
    within = W.partitionBy(*key, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    rows = df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (rows.join(sums.drop("_part"), [*key, bucket])
            .withColumn(before, F.col("_offset") + F.col("_within")).drop("_offset", "_within"))
