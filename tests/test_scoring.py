import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.operators import scoring
from ratingloom.schemas import FACTORS


def factors(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)]
    return spark.createDataFrame(rows, FACTORS)


def brute_force(users, items, n, seen=()):
    out = set()
    for u, vector in enumerate(users.astype(np.float64)):
        scores = [(-(vector * v).sum(), i) for i, v in enumerate(items.astype(np.float64)) if (u, i) not in seen]
        out |= {(u, i, rank) for rank, (_, i) in enumerate(sorted(scores)[:n], 1)}
    return out


def ranks(df):
    return {(r.user_idx, r.item_idx, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(1)
    users, items = rng.normal(size=(60, 5)).astype(np.float32), rng.normal(size=(90, 5)).astype(np.float32)
    items[40:60] = items[0:20]  # ties
    return users, items


@pytest.mark.parametrize("sizes", [{}, {"users_per_cell": 7, "items_per_slice": 11}, {"items_per_slice": 3}])
@pytest.mark.parametrize("n", [1, 10, 200])
def test_equals_brute_force_in_any_blocking(spark, matrices, sizes, n):
    users, items = matrices
    top = scoring.top_n_from_factors(factors(spark, users), factors(spark, items), n, **sizes)
    assert ranks(top) == brute_force(users, items, n)


@pytest.mark.parametrize("sizes", [{}, {"users_per_cell": 7, "items_per_slice": 11}])
def test_seen_pairs_are_left_out_before_ranking(spark, matrices, sizes):
    users, items = matrices
    pairs = {(u, i) for u in range(60) for i in range(90) if (u * 31 + i * 17) % 5 == 0} | {(3, i) for i in range(90)}
    # Copies, an unknown user and an unknown item change nothing.
    rows = sorted(pairs) + [(0, 0), (0, 0), (999, 1), (1, 999)]
    seen = spark.createDataFrame(rows, "user_idx int, item_idx int")
    top = scoring.top_n_from_factors(factors(spark, users), factors(spark, items), 10, seen, **sizes)
    assert ranks(top) == brute_force(users, items, 10, pairs | {(0, 0)})


def test_crowded_cells_are_divided(spark, matrices):
    users, items = matrices
    # One user has seen nearly everything, two others much.
    pairs = {(5, i) for i in range(88)} | {(u, i) for u in (6, 7) for i in range(0, 90, 2)}
    seen = spark.createDataFrame(sorted(pairs), "user_idx int, item_idx int")
    for sizes in ({"users_per_cell": 100}, {"users_per_cell": 20, "items_per_slice": 40}):
        top = scoring.top_n_from_factors(factors(spark, users), factors(spark, items), 10, seen, pairs_per_block=10, **sizes)
        assert ranks(top) == brute_force(users, items, 10, pairs)


def test_depth_per_user(spark, matrices):
    users, items = matrices
    deep = factors(spark, users).withColumn("depth", F.col("id") % 4 + 1)
    for sizes in ({}, {"items_per_slice": 11}):
        top = scoring.top_n_from_factors(deep, factors(spark, items), 4, **sizes)
        assert ranks(top) == {r for r in brute_force(users, items, 4) if r[2] <= r[0] % 4 + 1}


BAD = ([float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0], None, [None] * 5)


@pytest.mark.parametrize("bad", BAD)
@pytest.mark.parametrize("side", ["user", "item"])
def test_bad_vectors_are_reported_and_cost_nobody_else(spark, matrices, bad, side):
    users, items = matrices
    spoiled = spark.createDataFrame([(7, bad)], FACTORS)
    sides = {"user": factors(spark, users), "item": factors(spark, items)}
    sides[side] = sides[side].filter("id <> 7").union(spoiled)
    with pytest.raises(ValueError, match=f"{int(side == 'user')} user and {int(side == 'item')} item"):
        scoring.top_n_from_factors(sides["user"], sides["item"], 5)
    rejected = scoring.rejected_factors(sides["user"], sides["item"]).collect()
    assert [(r.side, r.id) for r in rejected] == [(side, 7)]
    left = {(u, i) for u in range(60) for i in range(90) if (u if side == "user" else i) == 7}
    top = scoring.top_n_from_factors(sides["user"], sides["item"], 5, rejects="skip")
    assert ranks(top) == {r for r in brute_force(users, items, 5, left) if r[0] != 7 or side == "item"}


@pytest.mark.parametrize("blocks", [1, 16, 200, 1000])
def test_every_block_has_its_own_task(spark, blocks):
    keys = scoring._task_keys(spark, blocks)
    numbers = spark.range(blocks).withColumnRenamed("id", "block")
    placed = scoring._keyed(numbers, blocks, keys).repartition(blocks, "key").select(F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert len(sizes) >= 0.99 * blocks and max(sizes) <= 2


def test_requests_beyond_32_bits(spark):
    users, items = factors(spark, [[3.0]]), factors(spark, [[1.0]])
    requests = spark.createDataFrame([(1 << 40, 2), (0, 1 << 40), (0, 1)], "user_id long, num_recommendations long")
    got = sorted((r.user_id, r.status) for r in scoring.recommend(requests, users, items).collect())
    assert got == [(0, "invalid_request"), (0, "success"), (1 << 40, "user_not_found")]


def test_all_scores_equal(spark):
    zero = np.zeros((3, 4))
    top = scoring.top_n_from_factors(factors(spark, zero), factors(spark, zero, [9, 4, 6]), 2)
    assert ranks(top) == {(u, i, r) for u in range(3) for r, i in ((1, 4), (2, 6))}


def test_empty_sides(spark):
    some, none = factors(spark, np.ones((2, 2))), factors(spark, [])
    assert scoring.top_n_from_factors(some, none, 5).count() == 0
    assert scoring.top_n_from_factors(none, some, 5).count() == 0


def test_titles_follow_the_item_or_are_null(spark):
    recs = spark.createDataFrame([(1, 0, 2.0, 1), (1, 1, 1.0, 2), (1, 7, 0.5, 3)], "user_idx int, item_idx int, score double, rank int")
    index = spark.createDataFrame([(100, 0, 2), (101, 1, 1)], "movieId int, item_idx int, n long")
    movies = spark.createDataFrame([(100, "A")], "movieId int, title string")
    got = {(r.item_idx, r.movieId, r.title) for r in scoring.with_titles(recs, scoring.title_map(index, movies)).collect()}
    assert got == {(0, 100, "A"), (1, 101, None), (7, None, None)}


def test_requests(spark):
    users, items = factors(spark, [[3.0], [-1.0]]), factors(spark, [[1.0], [2.0], [0.1]])
    requests = spark.createDataFrame(
        [(0, 2), (0, 1), (0, 1), (1, None), (5, 3), (0, 0), (0, 101), (None, 3), (None, 0)], "user_id int, num_recommendations int"
    )
    got = sorted(
        (-1 if r.user_id is None else r.user_id, r.status, r["rank"] or 0, -1 if r.item_idx is None else r.item_idx, r.predicted_rating or 0)
        for r in scoring.recommend(requests, users, items, n=2).collect()
    )
    assert got == [
        (-1, "invalid_request", 0, -1, 0),
        (-1, "user_not_found", 0, -1, 0),
        (0, "invalid_request", 0, -1, 0),
        (0, "invalid_request", 0, -1, 0),
        (0, "success", 1, 1, 5.0),
        (0, "success", 1, 1, 5.0),
        (0, "success", 1, 1, 5.0),
        (0, "success", 2, 0, 3.0),
        (1, "success", 1, 2, 0.5),
        (1, "success", 2, 0, 0.5),
        (5, "user_not_found", 0, -1, 0),
    ]


@pytest.mark.parametrize("n", [0, 101])
def test_request_size_is_checked(spark, n):
    one = factors(spark, [[1.0]])
    with pytest.raises(ValueError):
        scoring.recommend(spark.createDataFrame([(0,)], "user_id int"), one, one, n=n)


def lists(df):
    return sorted((r.user_idx, r.rank, r.item_idx, round(r.score, 9)) for r in df.collect())


def test_pruned_lists_are_the_same_and_slices_are_skipped(spark):
    rng = np.random.default_rng(8)
    scale = 1.0 / np.arange(1, 801) ** 1.2
    items = spark.createDataFrame([(i, (rng.normal(size=6) * scale[i]).tolist()) for i in range(800)], "id int, features array<float>")
    users = spark.createDataFrame([(u, rng.normal(size=6).tolist()) for u in range(60)], "id int, features array<float>")
    seen = spark.createDataFrame([(u, i) for u in range(60) for i in range(u % 40)], "user_idx int, item_idx int")
    for rated in (None, seen):
        pruned = scoring.top_n_pruned(users, items, 5, rated, items_per_slice=50)
        assert lists(pruned.recommendations) == lists(scoring.top_n_from_factors(users, items, 5, rated))
        visited = [r.slices for r in pruned.visited.collect()]
        assert len(visited) == 60 and sum(visited) < 0.5 * 60 * pruned.slices


def test_pruning_keeps_ties_short_lists_and_single_slices(spark):
    items = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(30)], "id int, features array<float>")
    users = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 0.0])], "id int, features array<float>")
    for size in (4, 1000):
        for n in (3, 50):
            pruned = scoring.top_n_pruned(users, items, n, items_per_slice=size)
            assert lists(pruned.recommendations) == lists(scoring.top_n_from_factors(users, items, n))
    nothing = scoring.top_n_pruned(users, items.limit(0), 3)
    assert nothing.recommendations.count() == 0


def test_crowded_cells_get_blocks_without_gaps(spark, monkeypatch):
    """Parts of one crowded cell are numbered behind all blocks, so the number of tasks follows the pairs."""
    blocks = []
    product = scoring._block_product

    def noted(users, items, count, *rest):
        blocks.append(count)
        return product(users, items, count, *rest)

    monkeypatch.setattr(scoring, "_block_product", noted)
    rng = np.random.default_rng(4)
    factors = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(60)], "id int, features array<float>")
    seen = spark.createDataFrame([(u, i) for u in (7, 8, 9) for i in range(50)] * 2, "user_idx int, item_idx int")
    top = scoring.top_n_from_factors(factors, factors, 5, seen, users_per_cell=6, items_per_slice=30, pairs_per_block=20)
    plain = scoring.top_n_from_factors(factors, factors, 5, seen)
    assert lists(top) == lists(plain)
    assert blocks[0] < blocks[1] + 2 * (20 + 3 * 50 * 2 / 20 + 3)


def test_rows_of_a_block_are_bounded_by_n(spark, matrices, monkeypatch):
    # A cell holds no more users than BLOCK_ROWS // n, so that a block returns at most BLOCK_ROWS rows.
    users, items = matrices
    monkeypatch.setattr(scoring, "BLOCK_ROWS", 200)
    grids = []
    checked = scoring._checked
    monkeypatch.setattr(scoring, "_checked", lambda *a, **k: grids.append(checked(*a, **k)[2]) or checked(*a, **k))
    top = scoring.top_n_from_factors(factors(spark, users), factors(spark, items), 10)
    assert grids[0].cells >= len(users) * 10 // 200
    assert ranks(top) == brute_force(users, items, 10)
