"""Hard-negative mining by STR-packed R-trees.

Vectors are packed sort-tile-recursively: a range partitioning on the coordinate that varies most cuts them into slabs, one
tree each; a slab is tiled on the next coordinates into leaves, and neighbouring leaves share a parent. Every node has its minimum
bounding box. For an anchor, a box bounds the inner product with all vectors under it: per coordinate the product lies between those
with the two sides, and the sums of these intervals are the bounds. A best-first queue visits boxes by their upper bound, drops those outside
the window of scores, and stops at a bound strictly below the k-th score found.

Trees meet anchors in cells, one tree with one group of anchors, both of bounded size. Positives are found first; they set the
windows in which negatives are then looked for.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldhaul.session import cut

SCALE = 256
EVERY = 100
SHIFTED, CLASSES = 7, 10
POSITIVES, NEGATIVES = 5, 10
#: 100 times the share of the positive's score that a negative has at least and at most.
LOW, HIGH = 30, 90
#: Rows of a tree about, rows of a leaf, children of a node, and anchors of a group about.
TREE = 65_536
LEAF = 256
FANOUT = 8
GROUP = 8192
#: Coordinates that the vectors are tiled on.
TILED = 3
#: Tasks of a search; cells beyond share a task, one after the other.
MOST_TASKS = 50_000

ROWS = "vec_id long, label long, v array<double>"
NODES = "tree int, ids binary, labels binary, x binary, low binary, high binary, first binary, size binary"
ANCHORS = "part int, ids binary, labels binary, x binary, windows binary, n_windows binary"


def usable(vectors: DataFrame, scale: int = SCALE, shifted: int = SHIFTED, classes: int = CLASSES) -> DataFrame:
    """(vec_id, label, v), one row an id: floor(scale * x) of each component; every ``shifted``-th label moves up by one.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part. Of rows that repeat
    an id the one with the least label and vector stays.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % shifted == 0, (label + 1) % classes).otherwise(label)
    fit = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
           & F.forall("embedding", lambda x: finite(x.cast("double"))))
    rows = vectors.filter(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(
        moved.alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")).alias("r"))
    return rows.groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v")


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def tiles(x: np.ndarray, ids: np.ndarray, axes: list[int], leaf: int) -> list[np.ndarray]:
    """Row numbers of the leaves: sorted by the first axis and cut into slices, each tiled on the other axes alike."""
    def cut_up(rows: np.ndarray, left: list[int]) -> Iterator[np.ndarray]:
        rows = rows[np.lexsort((ids[rows], x[rows, left[0]]))]
        leaves = -(-len(rows) // leaf)
        slices = leaves if len(left) == 1 else int(np.ceil(leaves ** (1 / len(left))))
        for part in np.array_split(rows, max(1, slices)):
            if len(part):
                yield from cut_up(part, left[1:]) if len(left) > 1 else (part,)

    return list(cut_up(np.arange(len(ids)), axes))


def _boxes(x: np.ndarray, sizes: list[int], fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """low, high, first and size of each node: leaves first, then their parents level by level, the root last.

    ``first`` and ``size`` are rows for a leaf and nodes for a parent.
    """
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    low, high = np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)
    lows, highs, firsts, counts = [low], [high], [first], [np.array(sizes, dtype=np.int64)]
    start = 0
    while len(low) > 1:
        at = np.arange(0, len(low), fanout)
        firsts.append(start + at)
        counts.append(np.diff([*at, len(low)]))
        start += len(low)
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        lows.append(low)
        highs.append(high)
    return tuple(np.concatenate(part) for part in (lows, highs, firsts, counts))


def _trees(width: int, axes: list[int], leaf: int, fanout: int):
    """One tree a partition."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(b["vec_id"].to_numpy(), b["label"].to_numpy(), _matrix(b["v"], width)) for b in batches if len(b)]
        if not parts:
            return
        ids, labels, x = (np.concatenate(p) for p in zip(*parts))
        packed = tiles(x, ids, axes, leaf)
        order = np.concatenate(packed)
        low, high, first, size = _boxes(x[order], [len(p) for p in packed], fanout)
        yield pd.DataFrame([{
            "tree": TaskContext.get().partitionId(), "ids": ids[order].tobytes(), "labels": labels[order].tobytes(),
            "x": x[order].tobytes(), "low": low.tobytes(), "high": high.tobytes(), "first": first.tobytes(),
            "size": size.tobytes()}])

    return of


def _groups(width: int):
    """The anchors of a partition, in blocks of one Arrow batch, with the windows of each one after the other."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, rows in b.groupby("part", sort=True):
                windows = [np.array(w, dtype=np.int64) for w in rows["windows"]]
                yield pd.DataFrame([{
                    "part": part, "ids": rows["vec_id"].to_numpy().tobytes(), "labels": rows["label"].to_numpy().tobytes(),
                    "x": _matrix(rows["v"], width).tobytes(), "windows": np.concatenate(windows).tobytes(),
                    "n_windows": np.array([len(w) for w in windows], dtype=np.int64).tobytes()}])

    return of


class Tree:
    """An R-tree over rows that are sorted by leaf."""

    def __init__(self, row, width: int):
        self.ids, self.labels = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.labels, dtype=np.int64)
        self.x = np.frombuffer(row.x).reshape(-1, width)
        self.low, self.high = (np.frombuffer(b).reshape(-1, width) for b in (row.low, row.high))
        self.first, self.size = (np.frombuffer(b, dtype=np.int64) for b in (row.first, row.size))
        self.leaves = int(np.searchsorted(np.cumsum(self.size), len(self.ids))) + 1

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest inner product that each box allows with each anchor."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T

    def best(self, anchor: np.ndarray, fits: np.ndarray, least: np.ndarray, most: np.ndarray, low: float, high: float,
             k: int, scored: dict[int, np.ndarray]) -> list[tuple[float, int]]:
        """(score, id) of the k best rows that fit and whose score lies in the window, ties to the smaller id."""
        found: list[tuple[float, int]] = []  # a heap with the worst of the best on top, ids negated
        root = len(self.size) - 1
        queue = [(-min(most[root], high), root)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < low or len(found) == k and -bound < found[0][0]:
                break
            if node >= self.leaves:
                for child in range(self.first[node], self.first[node] + self.size[node]):
                    if most[child] >= low and least[child] <= high:
                        heapq.heappush(queue, (-min(most[child], high), child))
                continue
            rows = slice(self.first[node], self.first[node] + self.size[node])
            if node not in scored:
                scored[node] = self.x[rows] @ anchor
            scores = scored[node]
            bar = max(low, found[0][0]) if len(found) == k else low
            good = np.flatnonzero(fits[rows] & (scores >= bar) & (scores <= high))
            ids = self.ids[rows][good]
            for i in np.lexsort((ids, -scores[good]))[:k]:
                entry = (float(scores[good[i]]), -int(ids[i]))
                if len(found) < k:
                    heapq.heappush(found, entry)
                elif entry > found[0]:
                    heapq.heapreplace(found, entry)
        return [(score, -i) for score, i in found]


def _search(width: int, k: int, same: bool, low: int, high: int):
    """Rows come sorted by cell, the tree first and then the blocks of anchors."""
    def window(score: int) -> tuple[float, float]:
        return float(-(-low * score // 100)), float(high * score // 100)

    def met(tree: Tree, row) -> Iterator[tuple]:
        ids, labels = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.labels, dtype=np.int64)
        x, windows = np.frombuffer(row.x).reshape(-1, width), np.frombuffer(row.windows, dtype=np.int64)
        ends = np.cumsum(np.frombuffer(row.n_windows, dtype=np.int64))
        least, most = tree.bounds(x)
        for q in range(len(ids)):
            fits = (tree.labels == labels[q]) & (tree.ids != ids[q]) if same else tree.labels != labels[q]
            scored: dict[int, np.ndarray] = {}
            for score in windows[ends[q - 1] if q else 0:ends[q]]:
                bottom, top = (-np.inf, np.inf) if same else window(int(score))
                for s, i in tree.best(x[q], fits, least[q], most[q], bottom, top, k, scored):
                    yield int(ids[q]), int(score), i, int(s)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, number = None, -1
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.low is not None:
                    tree, number = Tree(row, width), row.tree
                elif row.tree == number and (out := list(met(tree, row))):
                    yield pd.DataFrame(out, columns=["anchor_id", "window", "vec_id", "score"])

    return of


def _cells(trees: DataFrame, blocks: DataFrame, n_trees: int, parts: int) -> DataFrame:
    """Every tree with every group of anchors. A tree is copied once a group, a group once a tree."""
    left = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = blocks.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
    return (left.unionByName(right, allowMissingColumns=True)
            .repartition(min(n_trees * parts, MOST_TASKS), "tree", "part")
            .sortWithinPartitions("tree", "part", F.col("low").isNull()))


class Index:
    """The packed trees of a table of vectors, written to the shared folder."""

    def __init__(self, rows: DataFrame, tree: int = TREE, leaf: int = LEAF, fanout: int = FANOUT, group: int = GROUP):
        self.rows, self.group = rows, group
        count, self.width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.n_trees = 0
        if not count:
            return
        spread = rows.select(F.posexplode("v").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("spread"))
        axes = [r["axis"] for r in spread.orderBy(F.col("spread").desc(), "axis").limit(TILED).collect()]
        wanted = max(-(-count // tree), min(rows.sparkSession.sparkContext.defaultParallelism, -(-count // leaf)))
        keys = [F.coalesce(F.get("v", F.lit(a)), F.lit(0.0)) for a in axes]
        # slabs on the first axis; ids part a slab of equal vectors
        slabs = rows.repartitionByRange(wanted, keys[0], "vec_id")
        self.trees = cut(slabs.mapInPandas(_trees(self.width, axes[1:] or axes, leaf, fanout), NODES), "trees")
        self.n_trees = self.trees.agg(F.max("tree")).first()[0] + 1

    def search(self, anchors: DataFrame, k: int, same: bool, low: int = LOW, high: int = HIGH) -> DataFrame:
        """(anchor_id, window, vec_id, score): per tree the k best of each anchor and each of its ``windows``."""
        anchors = cut(anchors, "anchors")
        parts = max(1, -(-anchors.count() // self.group))
        dealt = anchors.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
        blocks = cut(dealt.repartition("part").mapInPandas(_groups(self.width), ANCHORS), "anchor-blocks")
        return _cells(self.trees, blocks, self.n_trees, parts).mapInPandas(
            _search(self.width, k, same, low, high), "anchor_id long, window long, vec_id long, score long")


def _best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, tree: int = TREE, leaf: int = LEAF, group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; positives of an anchor the rows of its label with the
    highest integer inner products; negatives of a positive the best rows of other labels with a score of ``low`` to ``high`` hundredths
    of the positive's. Ties go to the smaller id. What :func:`usable` says of nulls and repeated ids holds; vectors
    of other lengths count as padded with zeros. Scores are exact below 2^53. A positive whose score is
    negative has an empty window. An empty table, one without anchors, and one of a single label give no rows.
    """
    rows = cut(usable(vectors), "usable")
    index = Index(rows, tree, leaf, group=group)
    if not index.n_trees:
        return rows.sparkSession.sql("SELECT 0L AS anchor_id, 0L AS positive_id, 0 AS rank, 0L AS negative_id, "
                                     "0L AS positive_score, 0L AS negative_score").limit(0)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    near = _best(index.search(anchors.withColumn("windows", F.array(F.lit(0).cast("long"))), positives, same=True),
                 ["anchor_id"], positives)
    near = cut(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
               "positives")
    windows = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("windows"))
    found = _best(index.search(anchors.join(windows, "vec_id"), negatives, same=False, low=low, high=high),
                  ["anchor_id", "window"], negatives)
    return near.join(found.withColumnRenamed("window", "positive_score"), ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
