"""Exact top-k inner products by a pivot-distance index.

Vectors are keyed by their nearest pivot and the distance to it. Sorted by both they are cut into annuli around their pivot, and
neighbouring annuli make a sector, the unit of the index. A query expands the sorted annuli of a sector outwards from its own
distance. With the distance of query and vector at least the gap between the query's distance to the pivot and the annulus, the triangle
inequality bounds the product by (|q|^2 + |x|^2 - gap^2) / 2, and the query stops where this bound falls below its k-th score.

A query begins in its own sector, while the index is built. Then come rounds: in each the queries visit the most promising
of the sectors left, four times as many as in the round before, and take the k-th score they have reached into the next one. Sectors
whose numbers already rule them out are not visited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coldhaul.session import cut

K = 20
EVERY = 20
SCALE = 64
PIVOTS = 32
#: Rows of an annulus and of a sector, and queries of a block.
BLOCK = 1024
SECTOR = 65_536
QUERIES = 1024
#: Sectors that a block visits in the first round, and how many times as many in each further one.
FIRST, MORE = 4, 4
#: Tasks of a round; sectors beyond share a task, one after the other.
MOST_TASKS = 50_000


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as double.

    Rows without an id, with a null or empty vector, or with a null or non-finite component take no part.
    """
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    usable = F.col(id_column).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: finite(x.cast("double")))
    return vectors.filter(usable).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))


def pivots_of(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """``n`` vectors at most, those of the least hashed ids; shorter vectors are padded with zeros."""
    rows = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).collect()]
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return np.unique(out, axis=0)


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def _key(pivots: np.ndarray):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                far = _distances(_matrix(batch["v"], pivots.shape[1]), pivots)
                near = far.argmin(axis=1)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "v": batch["v"], "pivot": near.astype(np.int32),
                                    "far": far[np.arange(len(near)), near]})

    return of


class Best:
    """The best (score, id) pairs of each query of a block: highest score first, ties by the smaller id, each pair once."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.held = [(np.zeros(0), np.zeros(0, dtype=np.int64))] * n
        self.score, self.id = np.full(n, -np.inf), np.full(n, np.iinfo(np.int64).max)

    def bar(self, q: int, score: float, vec_id: int) -> None:
        """Nothing worse than this pair is wanted any more."""
        self.score[q], self.id[q] = score, vec_id

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.held[q][0], scores)), np.concatenate((self.held[q][1], ids))
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        new = np.concatenate(([True], (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])))
        scores, ids = scores[new][:self.k], ids[new][:self.k]
        self.held[q] = scores, ids
        if len(scores) == self.k and scores[-1] >= self.score[q]:
            self.bar(q, scores[-1], ids[-1])


class Sector:
    """Rows around one pivot, sorted by their distance to it, in annuli of ``block`` rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, far: np.ndarray, block: int):
        self.ids, self.x, self.far = ids, x, far
        self.starts = np.arange(0, len(ids), block)
        self.ends = np.append(self.starts[1:], len(ids))
        self.low, self.high = far[self.starts], far[self.ends - 1]
        self.norm2 = np.maximum.reduceat((x * x).sum(axis=1), self.starts)
        self.once = len(np.unique(ids)) == len(ids)

    def expand(self, ids: np.ndarray, q: np.ndarray, far: np.ndarray, best: Best) -> None:
        """Let each query visit the annuli outwards from its distance ``far``, until its bound falls below its k-th score."""
        gap = np.maximum(0, np.maximum(self.low - far[:, None], far[:, None] - self.high)) * (1 - 1e-9)
        order = np.argsort(gap, axis=1, kind="stable")
        # the longest vector among the annuli that are left, so that the bound only falls
        longest = np.maximum.accumulate(self.norm2[order][:, ::-1], axis=1)[:, ::-1]
        bound = ((q * q).sum(axis=1)[:, None] + longest - np.take_along_axis(gap, order, axis=1) ** 2) / 2 + 1e-6
        live = np.arange(len(ids))
        for step in range(len(self.starts)):
            live = live[bound[live, step] >= best.score[live]]
            at = order[live, step]
            for annulus in np.unique(at):
                self._score(annulus, live[at == annulus], ids, q, best)

    def _score(self, annulus: int, some: np.ndarray, ids: np.ndarray, q: np.ndarray, best: Best) -> None:
        rows = slice(self.starts[annulus], self.ends[annulus])
        scores, theirs = q[some] @ self.x[rows].T, self.ids[rows]
        bar, bar_id = best.score[some][:, None], best.id[some][:, None]
        good = ((scores > bar) | (scores == bar) & (theirs < bar_id)) & (theirs != ids[some][:, None])
        for i in np.flatnonzero(good.any(axis=1)):
            found = np.flatnonzero(good[i])
            if len(found) > best.k and self.once:
                # the k best are among those that reach the k-th score
                least = np.partition(scores[i][found], len(found) - best.k)[len(found) - best.k]
                found = found[scores[i][found] >= least]
            best.add(some[i], scores[i][found], theirs[found])


SECTORS = ("sector long, pivot int, low double, high double, norm2 double, ids binary, x binary, far binary, asks binary, "
           "best_ids binary, best_scores binary, best_n binary")
BLOCKS = ("ask long, sector long, ids binary, x binary, far binary, low array<double>, high array<double>, norm2 double, "
          "best_ids binary, best_scores binary, best_n binary")
FOUND = "ask long, q int, query_id long, vec_id long, score long"


def _packed(best: Best) -> dict:
    return {"best_ids": np.concatenate([h[1] for h in best.held] or [np.zeros(0, np.int64)]).tobytes(),
            "best_scores": np.concatenate([h[0] for h in best.held] or [np.zeros(0)]).tobytes(),
            "best_n": np.array([len(h[0]) for h in best.held], dtype=np.int64).tobytes()}


def _sectors(width: int, block: int, size: int, every: int, k: int):
    """Rows come sorted by pivot and distance; a sector is closed at a new pivot or when it is full."""
    def row_of(held: list[tuple], number: int) -> dict:
        ids, far = np.array([h[0] for h in held], dtype=np.int64), np.array([h[3] for h in held])
        sector = Sector(ids, _matrix([h[1] for h in held], width), far, block)
        asks = np.flatnonzero(ids % every == 0)
        best = Best(len(asks), k)
        sector.expand(ids[asks], sector.x[asks], far[asks], best)
        return {"sector": (TaskContext.get().partitionId() << 24) + number, "pivot": held[0][2], "low": far[0], "high": far[-1],
                "norm2": float(sector.norm2.max()), "ids": ids.tobytes(), "x": sector.x.tobytes(), "far": far.tobytes(),
                "asks": asks.astype(np.int64).tobytes(), **_packed(best)}

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        number = 0
        for batch in batches:
            for row in zip(batch["vec_id"], batch["v"], batch["pivot"], batch["far"]):
                if held and (len(held) >= size or held[0][2] != row[2]):
                    yield pd.DataFrame([row_of(held, number)])
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield pd.DataFrame([row_of(held, number)])

    return of


def _query_blocks(width: int, size: int, pivots: np.ndarray):
    """The queries of each sector in blocks of at most ``size``, with what they found in it."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                asks = np.frombuffer(row.asks, dtype=np.int64)
                ids, x = np.frombuffer(row.ids, dtype=np.int64)[asks], np.frombuffer(row.x).reshape(-1, width)[asks]
                n = np.frombuffer(row.best_n, dtype=np.int64)
                ends = np.cumsum(n)
                found_ids, found = np.frombuffer(row.best_ids, dtype=np.int64), np.frombuffer(row.best_scores)
                for at in range(0, len(asks), size):
                    part = slice(at, min(at + size, len(asks)))
                    mine = slice(int(ends[at] - n[at]), int(ends[part.stop - 1]))
                    far = _distances(x[part], pivots)
                    yield pd.DataFrame([{
                        "ask": (row.sector << 16) + at // size, "sector": row.sector, "ids": ids[part].tobytes(),
                        "x": x[part].tobytes(), "far": far.tobytes(), "low": far.min(axis=0).tolist(),
                        "high": far.max(axis=0).tolist(), "norm2": float((x[part] * x[part]).sum(axis=1).max()),
                        "best_ids": found_ids[mine].tobytes(), "best_scores": found[mine].tobytes(), "best_n": n[part].tobytes()}])

    return of


def _own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What the queries of the blocks found in their own sectors."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            n = np.frombuffer(row.best_n, dtype=np.int64)
            q = np.repeat(np.arange(len(n)), n)
            yield pd.DataFrame({"ask": row.ask, "q": q.astype(np.int32), "query_id": np.frombuffer(row.ids, dtype=np.int64)[q],
                                "vec_id": np.frombuffer(row.best_ids, dtype=np.int64),
                                "score": np.frombuffer(row.best_scores).astype(np.int64)})


def _visit(width: int, block: int, k: int):
    """Rows come sorted by sector, its own row first and then the blocks that visit it, one after the other."""
    def met(sector: Sector, pivot: int, row) -> pd.DataFrame:
        ids, x = np.frombuffer(row.q_ids, dtype=np.int64), np.frombuffer(row.q_x).reshape(-1, width)
        best = Best(len(ids), k)
        for bar in row.bars if row.bars is not None else ():
            best.bar(bar["q"], bar["score"], bar["vec_id"])
        sector.expand(ids, x, np.frombuffer(row.q_far).reshape(len(ids), -1)[:, pivot], best)
        q = np.repeat(np.arange(len(ids)), [len(h[0]) for h in best.held])
        return pd.DataFrame({"ask": row.ask, "q": q.astype(np.int32), "query_id": ids[q],
                             "vec_id": np.concatenate([h[1] for h in best.held]),
                             "score": np.concatenate([h[0] for h in best.held]).astype(np.int64)})

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sector, pivot = None, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.q_ids is None:
                    sector = Sector(np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.x).reshape(-1, width),
                                    np.frombuffer(row.far), block)
                    pivot = int(row.pivot)
                elif len(found := met(sector, pivot, row)):
                    yield found

    return of


def _promising(sectors: DataFrame, blocks: DataFrame) -> DataFrame:
    """(ask, sector, bound, place): for each block the other sectors by the bound of their products, from the numbers alone."""
    around = blocks.select("ask", F.col("sector").alias("_own"), F.col("norm2").alias("q_norm2"),
                           F.posexplode(F.arrays_zip("low", "high")).alias("pivot", "r"))
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("r.high"), F.col("r.low") - F.col("high")) * (1 - 1e-9)
    bound = (F.col("q_norm2") + F.col("norm2") - gap * gap) / 2 + 1e-6
    met = sectors.select("sector", "pivot", "low", "high", "norm2").join(around, "pivot").filter("sector <> _own")
    by_bound = W.partitionBy("ask").orderBy(F.col("bound").desc(), "sector")
    return met.select("ask", "sector", bound.alias("bound")).withColumn("place", F.row_number().over(by_bound) - 1)


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query row."""
    order = W.partitionBy("ask", "q").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, n_pivots: int = PIVOTS, block: int = BLOCK,
          size: int = QUERIES, sector: int = SECTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query, ties to the smaller vec_id.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but those of the query's own id.
    If there are fewer than k, all are returned. Vectors of other lengths count as padded with zeros. Rows that repeat id and vector
    count once; rows of one id with other vectors are candidates of their own, and such a query is
    answered once, from the best of its rows. Products are exact as long as they stay below 2^53. An empty table gives no rows;
    other columns are ignored.
    """
    spark, whole = vectors.sparkSession, cut(quantised(vectors).dropDuplicates(["vec_id", "v"]), "vectors")
    pivots = pivots_of(whole, n_pivots)
    if not len(pivots):
        return spark.sql("SELECT 0L AS query_id, 0 AS rank, 0L AS vec_id, 0L AS score").limit(0)
    width = pivots.shape[1]
    keyed = whole.mapInPandas(_key(pivots), "vec_id long, v array<double>, pivot int, far double")
    # sectors and blocks are numbered as they are written, so every later read finds the same numbers
    sectors = cut(keyed.repartitionByRange("pivot", "far", "vec_id").sortWithinPartitions("pivot", "far", "vec_id")
                  .mapInPandas(_sectors(width, block, sector, every, k), SECTORS), "sectors")
    blocks = cut(sectors.filter(F.octet_length("asks") > 0).mapInPandas(_query_blocks(width, size, pivots), BLOCKS), "queries")
    best = cut(_kept(blocks.select("ask", "ids", "best_ids", "best_scores", "best_n").mapInPandas(_own, FOUND), k), "best")
    promising = cut(_promising(sectors, blocks), "visits")
    n_sectors = sectors.count()
    payload = blocks.select("ask", F.col("ids").alias("q_ids"), F.col("x").alias("q_x"), F.col("far").alias("q_far"),
                            (F.octet_length("ids") / 8).cast("long").alias("n"))
    done, width_of_round = 0, FIRST
    while done < n_sectors - 1:
        bars = best.filter(F.col("place") == k).groupBy("ask").agg(
            F.collect_list(F.struct("q", "score", "vec_id")).alias("bars"), F.min("score").alias("least"), F.count("*").alias("full"))
        asks = payload.join(bars, "ask", "left")
        # a block with a query that has fewer than k yet can't rule anything out
        worth = F.when(F.col("full") == F.col("n"), F.col("bound") >= F.col("least")).otherwise(F.lit(True))
        now = promising.filter(F.col("place").between(done, done + width_of_round - 1))
        calls = now.join(asks, "ask").filter(worth).select("sector", "ask", "q_ids", "q_x", "q_far", "bars")
        both = (sectors.select("sector", "pivot", "ids", "x", "far")
                .join(now.select("sector").distinct(), "sector", "left_semi").unionByName(calls, allowMissingColumns=True))
        found = (both.repartition(min(n_sectors, MOST_TASKS), "sector")
                 .sortWithinPartitions("sector", F.col("q_ids").isNotNull()).mapInPandas(_visit(width, block, k), FOUND))
        best = cut(_kept(best.drop("place").unionByName(found), k), "best")
        done, width_of_round = done + width_of_round, width_of_round * MORE
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.select("query_id", "vec_id", "score").distinct()
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
