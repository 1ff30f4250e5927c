"""Hard negatives against brute force, and the parts of the tree."""

import collections

import numpy as np
import pytest

from coldhaul.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, tree string, part string"


def brute(rows):
    clean = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            row = ((label + 1) % 10 if i % 7 == 0 else label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v))
            clean[i] = min(clean.get(i, row), row)
    out = []
    for a, (label, v) in clean.items():
        if a % 100:
            continue
        scores = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in clean.items() if i != a}
        near = sorted((-s, i) for i, s in scores.items() if clean[i][0] == label)[:5]
        for s, p in near:
            fit = sorted((-t, i) for i, t in scores.items() if clean[i][0] != label and -30 * s <= 100 * t <= -90 * s)
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fit[:10])]
    return sorted(out)


def mined(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, label, "a", "b", "c") for i, v, label in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **sizes).collect())


@pytest.mark.parametrize("sizes", [{"tree": 60, "leaf": 4, "group": 3}, {}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(10, 6))
    rows = [(i, [float(x) for x in centres[i % 10] * 0.3 + rng.normal(size=6) * 0.4], i % 10) for i in range(900)]
    rows += [(3000 + i, rows[5][1], i % 2) for i in range(300)]  # a third of all rows are one vector
    rows += [(1000, None, 1), (1100, [], 1), (1200, [1.0, None], 1), (1300, [float("nan")] * 6, 1), (1400, [float("inf")] * 6, 1),
             (1500, [1.0] * 6, None), (None, [1.0] * 6, 1), (1600, [0.5, 0.5], 3), (1700, [0.0] * 6, 4), (-100, rows[0][1], 0),
             rows[100], rows[200], (200, rows[7][1], 9)]
    found = mined(spark, rows, **sizes)
    assert found == brute(rows) and len(found) > 200


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []  # one label
    assert mined(spark, [(100, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []  # a positive below zero has no window
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [0.95], 2)]) == [(100, 1, 1, 2, 65536, 32768)]
    # both ends of the window belong to it
    assert mined(spark, [(100, [10.0], 1), (1, [1.0], 1), (2, [0.9], 2), (3, [0.3], 2)])[:1] == [(100, 1, 1, 2, 655360, 588800)]


def test_leaves_are_tiles_and_boxes_bound_products():
    rng = np.random.default_rng(12)
    x, ids = np.floor(rng.normal(size=(1000, 5)) * 256), np.arange(1000)
    packed = negatives.tiles(x, ids, [1, 3], 16)
    assert sorted(np.concatenate(packed)) == list(range(1000)) and max(map(len, packed)) <= 16
    order = np.concatenate(packed)
    low, high, first, size = negatives._boxes(x[order], [len(p) for p in packed], 4)
    row = collections.namedtuple("Row", "ids labels x low high first size")(
        ids[order].tobytes(), ids.tobytes(), x[order].tobytes(), low.tobytes(), high.tobytes(), first.tobytes(), size.tobytes())
    tree = negatives.Tree(row, 5)
    assert tree.leaves == len(packed) and tree.size[-1] <= 4
    anchors = np.floor(rng.normal(size=(20, 5)) * 256)
    least, most = tree.bounds(anchors)
    for n in range(tree.leaves):
        products = anchors @ tree.x[tree.first[n]:tree.first[n] + tree.size[n]].T
        assert (products.min(axis=1) >= least[:, n]).all() and (products.max(axis=1) <= most[:, n]).all()
    scored = {}
    best = tree.best(anchors[0], np.ones(1000, dtype=bool), least[0], most[0], -np.inf, np.inf, 5, scored)
    assert sorted((-s, i) for s, i in best) == sorted(zip((-(tree.x @ anchors[0])).tolist(), tree.ids.tolist()))[:5]
    assert len(scored) < tree.leaves  # boxes below the fifth score are not opened
