"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Each source's documents are shuffled by a hash of their id and laid end to end on a line of words, which is cut into
blocks of equal length. Slot ``i`` of the mix maps the golden-ratio point ``frac(i / phi)`` through the cumulative
targets to a source; slots are ranked per source, and the slot of rank ``r`` takes block ``r`` of the source's line, which
is run through at most twice. The last slot of a source is cut to the words still missing, and slots that the
schedule owes a source, at most its discrepancy, are put at even places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldhaul.llm.common import DRAW_BITS, WORD, draw, n_words, running
from coldhaul.session import cut

# Weights by the rank of the source, and the inverse of the golden ratio.
WEIGHTS = (3, 1, 2)
INVERSE_PHI = 0.6180339887498949
SHARE = 1.5
MOST = 2
BLOCK = 1024
SHUFFLE_BUCKETS = 1024
SLOT_CHUNK = 65536
KEY = ["_source", "_none"]


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of each document; the size is its number of words."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))


def targets(sizes: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target): one row per source.

    Sources by code point, null last, weigh 3, 1, 2, repeating. They share ``share`` of all words; a target stops at
    ``most`` times its source's size, and the excess is reshared by weight. That is a common level: sorted by
    size over weight, the first sources that stop leave the rest of the words to the weights of the others. One
    row per source passes through the window, whatever the number of documents.
    """
    stats = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    stats = stats.withColumn("weight", F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    everything = W.partitionBy()
    by_ratio = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    level = stats.select(
        "source", "source_size", "weight",
        (F.lit(share) * F.sum("source_size").over(everything)
         - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_words"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("_weights"))
    cap = (F.col("source_size") * most).cast("double")
    # the level of words per weight once all sources before this one have stopped; the first that fits holds for the rest
    level = level.withColumn("_level", F.col("_words") / F.col("_weights"))
    level = level.withColumn("_fits", F.when(F.col("_level") * F.col("weight") <= cap, F.col("_level")))
    level = level.withColumn("_first", F.first("_fits", ignorenulls=True).over(
        by_ratio.rowsBetween(W.unboundedPreceding, 0)))
    return level.select("source", "source_size", "weight",
                        F.coalesce(F.least(F.col("_first") * F.col("weight"), cap), cap).alias("target"))


def _keyed(df: DataFrame) -> DataFrame:
    """The source as two columns that join without null-safe equality."""
    return df.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn("_none", F.col("source").isNull())


def _lined_up(sizes: DataFrame, buckets: int) -> DataFrame:
    """Add ``start``: the document's place on its source's line of words, in shuffled order."""
    drawn = sizes.withColumn("_at", draw(F.lit("mix"), F.col("doc_id"))).withColumn(
        "_bucket", F.floor(F.col("_at") / F.lit(2 ** DRAW_BITS // buckets)).cast("int"))
    return running(drawn, KEY, "_bucket", ["_at", "doc_id", "size"], "size", "start")


def goals_of(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``targets`` with whole words: budget, its cumulative range [low, high), the blocks of a line and slots needed."""
    goals = _keyed(targets(sizes)).withColumn("budget", F.round("target").cast("long"))
    high = F.sum("budget").over(W.orderBy("_none", "_source"))
    size = F.col("source_size")
    later = F.greatest(F.col("budget") - size, F.lit(0))
    return (goals.withColumn("high", high).withColumn("low", F.col("high") - F.col("budget"))
            .withColumn("blocks", F.ceil(size / block).cast("long"))
            .withColumn("needed", F.ceil(F.least("budget", "source_size") / block) + F.ceil(later / block)))


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, rank, block, from_word, n_words): what each slot of the mix takes from its source's line.

    A slot's point is looked up by equality on one of as many cells as there are sources, so it meets two
    sources on average. Ranks beyond a source's need are dropped; ranks the schedule did not reach get even places.
    """
    spark = goals.sparkSession
    total = goals.agg(F.coalesce(F.sum("budget"), F.lit(0)).alias("words"), F.count("*").alias("sources")).first()
    words, cells = max(total["words"], 1), max(total["sources"], 1)
    slots = -(-total["words"] // block) + 2 * total["sources"]

    def cell(word):
        return F.floor(word * F.lit(float(cells)) / F.lit(float(words))).cast("long")

    ranges = goals.filter("budget > 0").withColumn("_cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    turn = F.col("id") * F.lit(INVERSE_PHI)
    points = spark.range(slots).select(F.col("id").alias("slot"), F.floor(
        (turn - F.floor(turn)) * F.lit(float(words))).cast("long").alias("_point"))
    hits = (points.withColumn("_cell", cell(F.col("_point"))).join(ranges.select("_cell", "low", "high", *KEY), "_cell")
            .filter((F.col("_point") >= F.col("low")) & (F.col("_point") < F.col("high")))
            .select("slot", *KEY, F.floor(F.col("slot") / SLOT_CHUNK).alias("_chunk"), F.lit(1).cast("long").alias("_one")))
    ranked = cut(running(hits, KEY, "_chunk", ["slot"], "_one", "rank").select("slot", "rank", *KEY), "mix-slots")
    reached = ranked.groupBy(*KEY).agg(F.count("*").alias("_reached"))
    owed = (goals.join(reached, KEY, "left").withColumn("_reached", F.coalesce("_reached", F.lit(0)))
            .filter(F.col("_reached") < F.col("needed"))
            .withColumn("rank", F.explode(F.sequence(F.col("_reached"), F.col("needed") - 1)))
            .select(F.floor((F.col("rank") + 0.5) / F.col("needed") * F.lit(slots)).alias("slot"), "rank", *KEY))
    places = ranked.unionByName(owed).join(goals.drop("source"), KEY).filter(F.col("rank") < F.col("needed"))
    places = places.withColumn("block", F.col("rank") % F.col("blocks")).withColumn("from_word", F.col("block") * block)
    lap = F.floor(F.col("rank") / F.col("blocks"))
    before = lap * F.col("source_size") + F.col("from_word")
    return places.select("slot", "rank", *KEY, lap.alias("lap"), "block", "from_word", F.least(
        F.lit(block), F.col("source_size") - F.col("from_word"), F.col("budget") - before).alias("n_words"))


def take(sizes: DataFrame, goals: DataFrame, buckets: int = SHUFFLE_BUCKETS, block: int = BLOCK) -> DataFrame:
    """Each row of ``sizes`` with ``first`` and ``second``: the words taken on the first and on the second run of its line.

    The documents' pieces, cut at the blocks' ends, are joined to the slots on source and block.
    """
    lined = _lined_up(_keyed(sizes).filter("size > 0"), buckets)
    end = F.col("start") + F.col("size")
    pieces = lined.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    met = pieces.join(schedule(goals, block), [*KEY, "block"], "left")
    words = F.least(end, F.col("from_word") + F.col("n_words")) - F.greatest(F.col("start"), F.col("from_word"))
    words = F.coalesce(F.greatest(words, F.lit(0)), F.lit(0))
    taken = met.groupBy("doc_id", "size", *KEY, "start").agg(
        F.sum(F.when(F.col("lap") == 0, words).otherwise(0)).alias("first"),
        F.sum(F.when(F.col("lap") > 0, words).otherwise(0)).alias("second"))
    nothing = F.lit(0).cast("long")
    empty = _keyed(sizes).filter("size = 0").select(
        "doc_id", "size", *KEY, nothing.alias("start"), nothing.alias("first"), nothing.alias("second"))
    return taken.unionByName(empty)


def mix(docs: DataFrame, buckets: int = SHUFFLE_BUCKETS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    A null text has no words and is never taken; a null source is a source of its own, the last. Rows that repeat an id
    are documents of their own; if they are equal in size, either may stand first on the line. An
    empty table gives no rows; other columns are ignored. The sizes are written once to the shared folder. A hot source
    is lined up in ``buckets`` parts and joined by block, so no task holds a whole source.
    """
    sizes = cut(sized(docs), "mix-sizes")
    goals = cut(goals_of(sizes, block), "mix-goals")
    return (take(sizes, goals, buckets, block).join(goals.select(*KEY, "source_size", "target"), KEY)
            .select("doc_id", "size", "source_size", "target", (F.col("first") + F.col("second")).alias("taken")))


def mixed_documents(docs: DataFrame, buckets: int = SHUFFLE_BUCKETS, block: int = BLOCK) -> DataFrame:
    """The mix as documents: a row for each run of the line that takes words of a document, with its columns.

    Only the document at the end of a source's budget is cut, to its first words joined by blanks. Rows are
    told apart by id, source and text hash, so equal rows are taken alike.
    """
    columns = docs.columns
    marked = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("_hash"),
                         *[F.col(c).alias(f"_of_{c}") for c in columns])
    sizes = cut(marked.select("doc_id", "source", n_words(F.col("text")).alias("size"), "_hash"), "mix-sizes")
    lined = sizes.select(F.struct("doc_id", "_hash").alias("doc_id"), "source", "size")
    goals = cut(goals_of(lined, block), "mix-goals")
    taken = (take(lined, goals, buckets, block).groupBy("doc_id", *KEY, "size")
             .agg(F.array(F.max("first"), F.max("second")).alias("_laps")))
    laps = taken.withColumn("_words", F.explode("_laps")).filter("_words > 0").select(
        F.col("doc_id._hash").alias("_hash"), F.coalesce("doc_id.doc_id", F.lit(0)).alias("_id"),
        F.col("doc_id.doc_id").isNull().alias("_no_id"), *KEY, F.col("size").alias("_size"), "_words")
    keyed = _keyed(marked).withColumn("_id", F.coalesce("doc_id", F.lit(0))).withColumn("_no_id", F.col("doc_id").isNull())
    rows = keyed.join(laps, ["_id", "_no_id", "_hash", *KEY])
    start = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("_words").cast("int")), " ")
    cut_text = F.when(F.col("_words") == F.col("_size"), F.col("text")).otherwise(start)
    made = {"text": cut_text, "n_chars": F.length(cut_text).cast("long")}
    return rows.select(*[made.get(c, F.col(f"_of_{c}")).alias(c) for c in columns])
