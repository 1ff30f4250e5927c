"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A document descends region, rack and shard. At every node each child draws a number from the MD5 of the document
id and the child's place in the tree, and the least ``-ln(draw) / weight`` wins, so that a child is taken in proportion
to its weight and a draw never depends on the other children. If the weight of one child grows, rows move only into
that child; other subtrees keep theirs. A shard added to a laid-out tree becomes a region of its own, so it takes
rows only into itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldhaul.llm.common import DRAW_BITS, draw, running

BUCKETS = 1024


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def layout(shards: int, laid_out: int, racks: int = 2, per_rack: int = 4) -> list[Leaf]:
    """Shards 0 to ``shards - 1``: the first ``laid_out`` in regions of racks, each later one a region of its own."""
    leaves = []
    for s in range(shards):
        if s < laid_out:
            leaves.append(Leaf(f"g{s // (racks * per_rack)}", f"k{s // per_rack}", s))
        else:
            leaves.append(Leaf(f"g+{s}", f"k+{s}", s))
    return leaves


def _levels(leaves: list[Leaf]) -> list[dict[str, dict[str, float]]]:
    """For each level, the children of a node with the weights of their subtrees."""
    levels: list[dict[str, dict[str, float]]] = [{}, {}, {}]
    for leaf in leaves:
        if leaf.weight <= 0:
            continue
        path = ["", leaf.region, f"{leaf.region}/{leaf.rack}", f"{leaf.region}/{leaf.rack}/{leaf.shard}"]
        for level, (node, child) in enumerate(zip(path, path[1:])):
            children = levels[level].setdefault(node, {})
            children[child] = children.get(child, 0.0) + leaf.weight
    return levels


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """The shard (int) that the key reaches."""
    node = F.lit("")
    for children in _levels(leaves):
        entries = []
        for name, kids in children.items():
            entries += [F.lit(name), F.array(*[F.struct(F.lit(w).alias("weight"), F.lit(c).alias("name"))
                                               for c, w in kids.items()])]

        def score(child: Column) -> Column:
            uniform = (draw(key, child["name"]).cast("double") + 0.5) / F.lit(float(2 ** DRAW_BITS))
            return F.struct((-F.ln(uniform) / child["weight"]).alias("score"), child["name"].alias("name"))

        node = F.array_min(F.transform(F.element_at(F.create_map(*entries), node), score))["name"]
    return F.element_at(F.split(node, "/"), -1).cast("int")


def shard_documents(docs: DataFrame, shards: int = 16, laid_out: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``key``: the id and the number of shards decide. ``laid_out`` is how many shards the tree began with, all of them if
    not given; those added since are regions of their own, and so is the one that ``grown_shard`` adds. ``size`` is the UTF-8 length plus 1, a null text counts
    as empty. Slots number a shard's rows from 0 without gaps, in the order of a hash of the id, then id, size
    and checksum; equal rows take neighbouring slots in any order. A null id is a key like any other, so rows that
    repeat an id meet in one shard. An empty table gives no rows; other columns are ignored. A hot shard is numbered
    in ``buckets`` parts, so no task holds a whole shard.
    """
    first = shards if laid_out is None else laid_out
    placed = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        descend(F.col("doc_id"), layout(shards, first)).alias("shard"),
        draw(F.col("doc_id")).alias("_at"),
        descend(F.col("doc_id"), layout(shards + 1, first)).alias("grown_shard"),
        F.lit(1).cast("long").alias("_one"),
    ).withColumn("_bucket", F.floor(F.col("_at") / F.lit(2 ** DRAW_BITS // buckets)).cast("int"))
    numbered = running(placed, ["shard"], "_bucket", ["_at", "doc_id", "size", "text_crc32"], "_one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
