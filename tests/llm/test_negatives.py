import math
import random

import numpy as np
import pytest

from ratingloom.llm import negatives, vectors

LAYOUT = "vec_id long, embedding array<double>, label long, score string, rank string, anchor_id string, _a string"


def weights(v):
    return [math.floor(256 * x) for x in v]


def score(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), vectors.LEAST), vectors.MOST)


def brute_force(rows, every=100, k=5):
    good = [
        (i, weights(v), label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x * 256) for x in v)
    ]
    out = []
    for a, (name, anchor, label) in enumerate(good):
        if name % every:
            continue
        scored = sorted((-score(anchor, v), i, other == label) for b, (i, v, other) in enumerate(good) if a != b)
        for s, positive, _ in [x for x in scored if x[2]][:k]:
            window = [x for x in scored if not x[2] and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(name, positive, rank, i, -s, -n) for rank, (n, i, _) in enumerate(window, 1)]
    return sorted(out)


def check(spark, rows, **sizes):
    table = spark.createDataFrame(
        [(i, v if v is None else [x if x is None else float(x) for x in v], label, "x", "x", "x", "x") for i, v, label in rows], LAYOUT
    ).repartition(3)
    got = sorted(tuple(r) for r in negatives.hard_negatives(table, **sizes).collect())
    assert got == brute_force(rows)
    return got


@pytest.mark.parametrize("sizes", [{}, {"rows_per_block": 70, "anchors_per_block": 2}])
def test_ties_repeated_rows_and_odd_vectors(spark, sizes):
    rng = random.Random(5)
    rows = [(i, [rng.choice([0, 0.1, 0.25, -0.5, 1.0]) for _ in range(5)], rng.randrange(3)) for i in range(450)]
    rows += [(500, None, 1), (600, [None, 1.0], 1), (700, [float("nan")] * 5, 1), (800, [float("inf")] * 5, 1)]
    rows += [(900, [1.0] * 5, None), (None, [1.0] * 5, 1), (1000, [], 1), (1100, [0.5], 1), (1200, [0.5] * 7, 1)]
    rows += [(100, rows[100][1], rows[100][2]), (100, [1.0, 1.0, 0.0, 0.0, 0.0], 2), (7, rows[7][1], rows[7][2])]
    assert len(check(spark, rows, **sizes)) > 50


def test_few_rows_and_large_weights(spark):
    check(spark, [])
    check(spark, [(0, [1.0, 2.0], 1)])
    check(spark, [(0, [1.0, -2.0], 1), (1, [-1.0, 2.0], 1), (2, [0.5, 0.5], 2)])
    big = [(i, [2.0**40 + i, 3.0**20, -1.0], i % 2) for i in range(0, 300, 50)]
    check(spark, big + [(400, [2.0**25, 1.0, 0.0], 0), (3, [2.0**25, 0.5, 0.0], 1), (4, [2.0**25, 1.0, 1.0], 0)])


def test_relabelled(spark):
    rows = spark.createDataFrame([(7, 9), (8, 9), (14, None), (None, 3)], "vec_id long, label int")
    assert [r.label for r in negatives.relabelled(rows).collect()] == [0, 9, None, 3]


def test_tree_prunes_and_holds_every_row():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(size=(5000, 3)) * 256)
    tree = negatives.RTree(points)
    assert sorted(tree.order) == list(range(5000))
    for level, (low, high) in enumerate(tree.boxes):
        for node in range(len(low)):
            first, last = tree.children(level, node)
            below = tree.points[first:last] if level == 0 else None
            if below is not None:
                assert (below >= low[node]).all() and (below <= high[node]).all()
    ids = tree.order
    allowed = np.ones(5000, bool)
    (index, scores), = negatives.search(tree, points[0], [(-np.inf, np.inf)], allowed, ids, 5)
    everything = tree.points @ points[0]
    best = sorted(range(5000), key=lambda i: (-everything[i], ids[i]))[:5]
    assert index.tolist() == best and scores.tolist() == everything[best].tolist()
    assert tree.visited < sum(len(low) for low, _ in tree.boxes) / 4


def test_many_equal_points():
    tree = negatives.RTree(np.ones((1000, 4)))
    (index, scores), = negatives.search(tree, np.ones(4), [(4.0, 4.0)], np.ones(1000, bool), tree.order, 5)
    assert tree.order[index].tolist() == [0, 1, 2, 3, 4] and set(scores) == {4.0}
