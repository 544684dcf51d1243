import math
import random

import numpy as np
import pytest

from ratingloom.llm import topk, vectors

LAYOUT = "vec_id long, embedding array<double>, query_id string, rank string, score string, q string, c string, label int"


def brute_force(rows, k=5):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    weights = [(i, [math.floor(256 * x) for x in v]) for i, v in good]
    out = []
    for a, (i, v) in enumerate(weights):
        if i % 50 == 0:
            scored = sorted((-min(max(sum(x * y for x, y in zip(v, w)), -(2**63)), 2**63 - 1), j) for b, (j, w) in enumerate(weights) if a != b)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [x if x is None else float(x) for x in v], "x", "x", "x", "x", "x", 1) for i, v in rows], LAYOUT).repartition(4)


def check(spark, rows, **sizes):
    got = sorted(tuple(r) for r in topk.top_k(table(spark, rows), **sizes).collect())
    assert got == brute_force(rows)


@pytest.mark.parametrize("sizes", [{}, {"queries_per_block": 2, "candidates_per_block": 30}])
def test_ties_sparse_and_odd_vectors(spark, sizes, monkeypatch):
    monkeypatch.setattr(topk, "SCORE_CELLS", 64)
    rng = random.Random(3)
    rows = [(i, [rng.choice([0, 0, 0, -0.5, 0.25, 1.0]) for _ in range(4)]) for i in range(240)]
    rows += [(300, None), (350, [None, 1.0, 0, 0]), (400, [float("nan"), 0, 0, 0]), (450, [float("inf")] * 4), (None, [1.0] * 4)]
    rows += [(500, []), (501, [0.5]), (502, [0.5] * 7), (50, rows[50][1]), (50, [9.0, 0, 0, 0])]
    check(spark, rows, **sizes)


def test_few_candidates_and_large_weights(spark):
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [(0, [1.0, 2.0]), (1, [3e5, -1.0]), (2, [-2e6, 1e6]), (50, [1e6, 1e6])])
    check(spark, [])


def test_scores_saturate(spark):
    many = [(2.0**26 - 1) / 256] * 4096
    got = [tuple(r) for r in topk.top_k(table(spark, [(0, many), (1, many), (2, [-x for x in many])])).collect()]
    assert sorted(got) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_only_postings_are_added():
    rng = np.random.default_rng(3)
    candidates = np.where(rng.random((50, 20)) < 0.1, rng.integers(-9, 9, (50, 20)), 0).astype(float)
    candidates[:, 4] = 3
    queries = np.where(rng.random((7, 20)) < 0.3, rng.integers(-9, 9, (7, 20)), 0).astype(float)
    postings = topk.postings_of(candidates)
    assert sum(len(rows) for rows, _ in postings) == np.count_nonzero(candidates)
    assert (topk.score_block(50, postings, queries) == queries @ candidates.T).all()
    wide = vectors.comparable(candidates * 2.0**40, queries * 2.0**40)
    assert wide[0].dtype == object
    assert (topk.score_block(50, topk.postings_of(wide[0]), wide[1]) == wide[1] @ wide[0].T).all()
