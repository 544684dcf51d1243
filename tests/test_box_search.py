"""The search by boxes inside a top-N block, against all products."""

import numpy as np
import pyarrow as pa
import pytest

from ratingloom.operators import scoring


def table(ids, matrix, id, vector):
    rank = matrix.shape[1]
    lists = pa.ListArray.from_arrays(np.arange(0, matrix.size + 1, rank, dtype=np.int32), pa.array(matrix.ravel()))
    return pa.table({id: pa.array(ids, pa.int32()), vector: lists})


def rows(users, items, n, depths=None, seen=()):
    left = table(np.arange(len(users)), users, "id", "features")
    left = left.append_column("item", pa.nulls(len(users), pa.int32()))
    left = left.append_column("depth", pa.array(np.full(len(users), n) if depths is None else depths, pa.int32()))
    if len(seen):
        u, i = (pa.array(side, pa.int32()) for side in zip(*seen))
        nothing = pa.nulls(len(seen), left["features"].type)
        pairs = pa.table({"id": u, "features": nothing, "item": i, "depth": pa.nulls(len(seen), pa.int32())})
        left = pa.concat_tables([left, pairs.select(left.column_names)])
    right = table(np.arange(len(items)) * 3, items, "item_id", "vector")
    found = scoring._top_kernel(n)(left, right).to_pylist()
    return sorted((r["user_idx"], r["rank"], r["item_idx"], r["score"]) for r in found)


def everything(users, items, n, depths=None, seen=()):
    out, seen = [], set(seen)
    for u, vector in enumerate(users.astype(np.float64)):
        scores = (vector * items.astype(np.float64)).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(items)), -scores)) if (u, 3 * i) not in seen]
        depth = n if depths is None else min(n, depths[u])
        out += [(u, rank, 3 * i, scores[i]) for rank, i in enumerate(order[:depth], 1)]
    return sorted(out)


@pytest.fixture
def small_trees(monkeypatch):
    for name, value in {"TREE_FROM": 1, "LEAF": 2, "FAN_BITS": 1, "CHUNK_FLOATS": 500}.items():
        monkeypatch.setattr(scoring, name, value)


@pytest.mark.parametrize("share", [0.2, 100])
@pytest.mark.parametrize("rank", [1, 3, 6])
@pytest.mark.parametrize("n", [1, 7, 60])
@pytest.mark.parametrize("size", [1, 2, 5, 64, 157])
def test_equals_all_products(small_trees, monkeypatch, share, rank, n, size):
    monkeypatch.setattr(scoring, "HARD_SHARE", share)
    rng = np.random.default_rng([rank, n, size])
    for whole in (False, True):
        users, items = (rng.normal(size=(m, rank)).astype(np.float32) for m in (50, size))
        if whole:
            # Many ties, zero vectors among them.
            users, items = np.round(users), np.round(items)
        depths = rng.integers(0, n + 3, size=50)
        pairs = [(u, 3 * i) for u in range(50) for i in range(size) if rng.random() < 0.3 or u == 7]
        assert rows(users, items, n) == everything(users, items, n)
        assert rows(users, items, n, depths, pairs) == everything(users, items, n, depths, pairs)


def test_few_items_are_multiplied_at_low_rank():
    rng = np.random.default_rng(2)
    users, items = rng.normal(size=(300, 4)).astype(np.float32), rng.normal(size=(50_000, 4)).astype(np.float32)
    build, search = scoring._box_search(10)
    nobody = np.empty(0, dtype=np.int64)
    error = 1e-5 * np.ones(300)
    user, item, hard = search(build(items), users, error, 4 * error, np.full(300, 10), nobody, nobody)
    assert hard.mean() < 0.1 and len(user) < 300 * 200
    best = np.argsort(-(users @ items.T), axis=1)[:, :10]
    found = set(zip(user.tolist(), item.tolist()))
    assert all((u, i) in found for u in np.flatnonzero(~hard).tolist() for i in best[u].tolist())


def test_shallow_lists_need_fewer_cells(spark):
    from pyspark.sql import functions as F

    users = spark.range(1000).select(F.col("id").cast("int"), F.array(F.lit(1.0).cast("float")).alias("features"))
    deep = users.withColumn("depth", F.when(F.col("id") < 100, 100).otherwise(20))
    grids, checked = [], scoring._checked
    patch = pytest.MonkeyPatch()
    patch.setattr(scoring, "BLOCK_ROWS", 2_000)
    patch.setattr(scoring, "_checked", lambda *args: grids.append(checked(*args)[2]) or checked(*args))
    try:
        top = scoring.top_n_from_factors(deep, users, 100)
        assert top.count() == 100 * 100 + 900 * 20
    finally:
        patch.undo()
    # 28 rows a user on average, so 71 users a cell; at 100 rows there were 20.
    assert grids[0].cells == 15
