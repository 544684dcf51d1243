"""Evaluation over all users, not samples of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom import catalog
from ratingloom.operators import als, metrics
from ratingloom.plans.evaluate import evaluate, users_to_score

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def splits(spark):
    rng = np.random.default_rng(5)
    rows = [
        (u, i, float(rng.integers(1, 6)), ("train", "train", "validation", "test")[rng.integers(4)])
        for u in range(40)
        for i in range(150)
        if rng.random() < 0.3
    ]
    ratings = spark.createDataFrame(rows, "user_idx int, item_idx int, rating float, split string").cache()
    return {name: ratings.filter(F.col("split") == name).drop("split") for name in ("train", "validation", "test")}


def test_evaluate_measures_every_user(splits):
    model = als.fit_als(splits["train"], rank=3, maxIter=2)[0]
    got = {(r.metric, r.segment, r["k"]): r.value for r in evaluate(model, splits).collect()}
    recs = als.top_n_all(model, 100).cache()
    for r in metrics.precision_recall_at_k(splits["test"], recs).collect():
        assert got["precision", "test", r["k"]] == pytest.approx(r.precision)
        assert got["recall", "test", r["k"]] == pytest.approx(r.recall)
    coverage = metrics.catalog_coverage(splits["train"], recs).first().coverage
    bias = metrics.popularity_bias(splits["train"], recs.filter("rank <= 20")).first().popularity_bias
    assert got["coverage", "train", 100] == pytest.approx(coverage)
    assert got["popularity_bias", "test", 20] == pytest.approx(bias)


def test_users_to_score_are_all_or_those_of_a_share(splits):
    everyone = users_to_score(splits).collect()
    assert sorted((r.user_idx, r.depth) for r in everyone) == [(u, 100) for u in range(40)]
    some = {r.user_idx for r in users_to_score(splits, 0.5, 0.25).collect()}
    assert 0 < len(some) < 40


def _values(df):
    return {(r.metric, r.segment, r["k"]): r.value for r in df.collect()}


def test_suite_query_covers_every_user(spark):
    got = _values(catalog.evaluation_suite(spark, FOLDER))
    for r in catalog.precision_recall_at_k(spark, FOLDER).collect():
        assert (got["precision", "test", r["k"]], got["recall", "test", r["k"]]) == (r.precision, r.recall)
    part = _values(catalog.metrics_json_roundtrip(spark, FOLDER))
    assert part.keys() == got.keys() and part != got


def test_bars_by_k_cover_every_user(spark):
    bars, plain = catalog.metric_bars_by_k(spark, FOLDER), catalog.precision_recall_at_k(spark, FOLDER)
    assert sorted(map(tuple, bars.collect())) == sorted(map(tuple, plain.collect()))
