import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.functions import dot
from ratingloom.operators import als, scoring

REG = 0.1


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(50, 3)), rng.normal(size=(40, 3))
    rows = [
        (u, i, float(np.clip(3 + users[u] @ items[i], 0.5, 5)))
        for u in range(50)
        for i in range(40)
        if rng.random() < 0.5
    ]
    return spark.createDataFrame(rows, "user_idx int, item_idx int, rating float").cache()


@pytest.fixture(scope="module")
def model(train):
    return als.fit_als(train, rank=4, maxIter=6, regParam=REG)[0]


def vectors(factors):
    return {r.id: np.array(r.features) for r in factors.collect()}


def test_user_factors_solve_the_weighted_normal_equations(train, model):
    items, users = vectors(model.itemFactors), vectors(model.userFactors)
    by_user = {}
    for r in train.collect():
        by_user.setdefault(r.user_idx, []).append((items[r.item_idx], r.rating))
    for user, rated in by_user.items():
        v, ratings = np.array([x for x, _ in rated]), np.array([x for _, x in rated])
        left = v.T @ v + REG * len(rated) * np.eye(4)
        assert np.abs(left @ users[user] - v.T @ ratings).max() < 1e-3


def test_prediction_is_the_dot_product(train, model):
    scored = als.score(model, train)
    u = model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("u"))
    i = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").alias("i"))
    error = scored.join(u, "user_idx").join(i, "item_idx").agg(F.max(F.abs(F.col("prediction") - dot(F.col("u"), F.col("i")))))
    assert error.first()[0] < 1e-5


def test_learns_low_rank_data(train, model):
    row = als.score(model, train).agg(F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2)), F.stddev("rating")).first()
    assert row[0] < 0.6 * row[1]


def test_cold_rows_are_dropped(spark, model):
    pairs = spark.createDataFrame([(0, 0), (999, 0), (0, 999)], "user_idx int, item_idx int")
    assert [(r.user_idx, r.item_idx) for r in als.score(model, pairs).collect()] == [(0, 0)]


def test_block_product_agrees_with_mllib(spark, model):
    ours = als.top_n_all(model, 5)
    theirs = model.recommendForAllUsers(5).select("user_idx", F.posexplode("recommendations").alias("pos", "rec"))
    theirs = theirs.select("user_idx", (F.col("pos") + 1).alias("rank"), F.col("rec.rating").alias("other"))
    both = ours.join(theirs, ["user_idx", "rank"])
    assert both.count() == ours.count() == theirs.count() == 250
    assert both.agg(F.max(F.abs(F.col("score") - F.col("other")))).first()[0] < 1e-5


def test_subset_collapses_copies_and_skips_unknown_users(spark, model):
    users = spark.createDataFrame([(1,), (1,), (999,)], "user_idx int")
    rows = als.top_n_subset(model, users, 3).collect()
    assert sorted((r.user_idx, r["rank"]) for r in rows) == [(1, 1), (1, 2), (1, 3)]


def test_save_and_load(spark, model, tmp_path):
    path = str(tmp_path / "model")
    als.save_model(model, path, [{"params": {"rank": 4}}])
    loaded, history = als.load_model(spark, path)
    assert history == [{"params": {"rank": 4}}]
    assert loaded.userFactors.exceptAll(model.userFactors).count() == 0
    assert loaded.itemFactors.exceptAll(model.itemFactors).count() == 0
    model.write().overwrite().save(str(tmp_path / "bare"))
    assert als.load_model(spark, str(tmp_path / "bare"))[1] == []


def test_half_written_version_is_never_loaded(spark, model, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    first = als.save_model(model, path, [{"run": 1}])
    write, calls = als.write_json_record, []

    for stop_at in (1, 2):
        def failing(record, target):
            calls.append(target)
            if len(calls) == stop_at:
                raise OSError("lost")
            write(record, target)

        calls.clear()
        monkeypatch.setattr(als, "write_json_record", failing)
        with pytest.raises(OSError):
            als.save_model(model, path, [{"run": 2}])
        monkeypatch.setattr(als, "write_json_record", write)
        assert als.load_model(spark, path)[1] == [{"run": 1}]
    # A manifest folder whose file has not been written yet.
    (tmp_path / "store" / "manifests" / "99999999999999999999-x").mkdir()
    assert als.load_model(spark, path)[1] == [{"run": 1}]
    last = [als.save_model(model, path, [{"run": n}]) for n in range(3, 7)]
    assert als.load_model(spark, path)[1] == [{"run": 6}]
    assert [v for v, _ in als.model_versions(spark, path)] == last[-als.KEEP_VERSIONS :]
    assert als.load_model(spark, path, last[-2])[1] == [{"run": 5}]
    with pytest.raises(ValueError):
        als.load_model(spark, path, first)


def test_factor_info(spark, model):
    row = als.factor_info(model.userFactors, model.itemFactors, model.rank).first()
    assert (row.num_user_factors, row.num_item_factors, row["rank"]) == (50, 40, 4)
    assert row.sample_user_factor_mean == pytest.approx(np.mean([v[0] for v in vectors(model.userFactors).values()]), rel=1e-6)


def test_implicit_feedback_is_accepted(train):
    model, history = als.fit_als(train, rank=2, maxIter=1, implicitPrefs=True, alpha=2.0)
    assert model.rank == 2 and history["params"]["implicitPrefs"] is True


def test_blocks_are_parameters_and_change_the_model(train, model):
    _, history = als.fit_als(train, rank=4, maxIter=1)
    assert (history["params"]["numUserBlocks"], history["params"]["numItemBlocks"]) == (10, 10)
    # Three times the rows give the same model settings; other blocks give another model.
    _, history = als.fit_als(train.union(train).union(train), rank=4, maxIter=1)
    assert (history["params"]["numUserBlocks"], history["params"]["numItemBlocks"]) == (10, 10)
    other, _ = als.fit_als(train, rank=4, maxIter=6, regParam=REG, numUserBlocks=3, numItemBlocks=3)
    same, _ = als.fit_als(train, rank=4, maxIter=6, regParam=REG)
    assert vectors(other.userFactors)[0] == pytest.approx(vectors(other.userFactors)[0])
    assert np.allclose(vectors(same.userFactors)[0], vectors(model.userFactors)[0])
    assert not np.allclose(vectors(other.userFactors)[0], vectors(model.userFactors)[0])


@pytest.mark.parametrize("pairs_per_block", [1, 7, 10**6])
def test_block_scoring_equals_transform(spark, train, model, pairs_per_block):
    unknown = spark.createDataFrame([(999, 0, 1.0), (0, 999, 1.0), (None, 0, 1.0), (0, None, 1.0)], train.schema)
    rows = train.union(train.limit(5)).union(unknown)
    ours = scoring.score_pairs(rows, model.userFactors, model.itemFactors, pairs_per_block)
    expected = {(r.user_idx, r.item_idx): r.prediction for r in model.transform(train).collect()}
    got = ours.collect()
    assert len(got) == train.count() + 5
    assert ours.columns == [*rows.columns, "prediction"]
    assert all(abs(r.prediction - expected[r.user_idx, r.item_idx]) < 1e-5 for r in got)


def test_no_vector_rides_with_a_row(train, model):
    plan = als.score(model, train)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("FlatMapCoGroupsInArrow")[0]
