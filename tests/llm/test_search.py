"""Top-k search against brute force."""

import collections

import numpy as np
import pytest

from coldhaul.llm import topk


def brute(vectors, k):
    clean = {}
    for i, v in vectors:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            clean.setdefault(i, set()).add(tuple(np.floor(64 * np.float32(x).astype(np.float64)) for x in v))
    out = {}
    for q in clean:
        if q % 20 == 0:
            pairs = {(-int(sum(a * b for a, b in zip(v, w))), i) for i, ws in clean.items() if i != q for w in ws for v in clean[q]}
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(pairs)[:k])]
    return {q: r for q, r in out.items() if r}


@pytest.mark.parametrize("sizes", [{"block": 4, "size": 3, "n_pivots": 4, "sector": 13}, {}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(size=8) * (0.2 + (i % 7))]) for i in range(400)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(60)]
    vectors += [(2000, None), (2001, []), (2020, [1.0, None] + [0.0] * 6), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8),
                (None, vectors[0][1]), (2080, [0.5, 0.5]), (2100, [0.0] * 8), vectors[20], vectors[20], (7, vectors[20][1]), (40, vectors[3][1])]
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in vectors],
                               "vec_id long, embedding array<float>, label int, pivot string, rank string")
    found = collections.defaultdict(list)
    for r in topk.top_k(df, **sizes).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert dict(found) == brute(vectors, 20)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_k(spark.createDataFrame([(20, [1.0])], schema)).count() == 0
    found = topk.top_k(spark.createDataFrame([(20, [1.0]), (1, [2.0]), (2, [2.0])], schema)).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(1, 1, 8192), (2, 2, 8192)]


def test_annuli_are_expanded_until_the_bound_fails():
    """A query opens the annuli around its distance and stops; equal vectors in a third of the rows make no difference."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    x = np.floor(x / np.linalg.norm(x, axis=1)[:, None] * 640)
    x[:1000] = x[0]
    far = np.linalg.norm(x - x[7], axis=1)
    order = np.argsort(far, kind="stable")
    sector = topk.Sector(np.arange(3000)[order], x[order], far[order], 50)
    opened = []
    score = topk.Sector._score
    sector._score = lambda annulus, some, *rest: (opened.extend([annulus] * len(some)), score(sector, annulus, some, *rest))
    asks = np.array([5, 1500, 2999])
    best = topk.Best(3, 10)
    sector.expand(asks, x[asks], far[asks], best)
    for q, (scores, ids) in zip(asks, best.held):
        want = sorted((-float(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:10]
        assert [(-s, i) for s, i in zip(scores, ids)] == want
    assert len(opened) < 2 * len(sector.starts)
    # with the bar of an earlier round only what beats it comes back
    again = topk.Best(3, 10)
    for q, (scores, ids) in enumerate(best.held):
        again.bar(q, scores[4], ids[4])
    sector.expand(asks, x[asks], far[asks], again)
    assert [len(h[0]) for h in again.held] == [4, 4, 4]
