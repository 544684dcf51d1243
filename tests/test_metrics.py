import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ratingloom.functions import clamp_rating, relative_gap, star_string
from ratingloom.operators import metrics

TEST = "user_idx int, item_idx int, rating float"
RECS = "user_idx int, item_idx int, score double, rank int"


def test_duplicates_count_as_relevant_but_hit_once(spark):
    test = spark.createDataFrame([(1, 5, 4.0), (1, 5, 5.0), (1, 6, 4.5), (1, 7, 3.9), (2, 5, 5.0)], TEST)
    recs = spark.createDataFrame([(1, 5, 1.0, 1), (1, 8, 1.0, 2), (3, 5, 1.0, 1)], RECS)
    row = metrics.precision_recall_at_k(test, recs, ks=(2,)).first()
    # Users 2 and 3 are on one side only; user 1 has 3 relevant rows and 1 hit.
    assert row.precision == pytest.approx(1 / 2)
    assert row.recall == pytest.approx(1 / 3)


def test_short_lists_divide_by_their_own_length(spark):
    test = spark.createDataFrame([(1, 5, 4.0)], TEST)
    recs = spark.createDataFrame([(1, 5, 1.0, 1), (1, 8, 1.0, 2)], RECS)
    rows = {r.k: (r.precision, r.recall) for r in metrics.precision_recall_at_k(test, recs, ks=(1, 20)).collect()}
    assert rows == {1: (1.0, 1.0), 20: (0.5, 1.0)}


def test_empty_input_gives_null(spark):
    test, recs = spark.createDataFrame([], TEST), spark.createDataFrame([], RECS)
    assert metrics.precision_recall_at_k(test, recs, ks=(5,)).first().asDict() == {"k": 5, "precision": None, "recall": None}
    assert metrics.catalog_coverage(test, recs).first().coverage is None
    assert metrics.popularity_bias(test, recs).first().popularity_bias is None
    predictions = test.withColumn("prediction", F.lit(1.0))
    assert metrics.error_metrics(predictions).first().rmse is None
    assert metrics.cold_warm_rmse(test, predictions).count() == 0


def test_errors_equal_mllib(spark):
    predictions = spark.range(500).select(
        (F.rand(1) * 5).cast("float").alias("rating"), (F.rand(2) * 5).cast("float").alias("prediction")
    ).cache()
    row = metrics.error_metrics(predictions).first()
    for name in ("rmse", "mae"):
        expected = RegressionEvaluator(metricName=name, labelCol="rating").evaluate(predictions)
        assert row[name] == pytest.approx(expected, rel=1e-9)
    assert row.num_predictions == 500


def test_coverage_does_not_fall_with_k(spark):
    train = spark.createDataFrame([(u, i, 3.0) for u in range(4) for i in range(20)], TEST)
    recs = spark.createDataFrame([(u, (u * 3 + r) % 20, 1.0, r) for u in range(4) for r in range(1, 11)], RECS)
    values = [metrics.catalog_coverage(train, recs.filter(F.col("rank") <= k)).first().coverage for k in range(1, 11)]
    assert values == sorted(values) and 0 < values[0] <= values[-1] <= 1


def test_bias_weights_every_slot_and_skips_unrated_items(spark):
    train = spark.createDataFrame([(u, 0, 3.0) for u in range(9)] + [(1, 1, 3.0)], TEST)
    recs = spark.createDataFrame([(1, 0, 1.0, 1), (2, 0, 1.0, 1), (3, 1, 1.0, 1), (4, 99, 1.0, 1)], RECS)
    row = metrics.popularity_bias(train, recs).first()
    assert row.avg_recommended_popularity == pytest.approx((9 + 9 + 1) / 3)
    assert row.popularity_bias == pytest.approx((19 / 3) / 5)


def test_segments(spark):
    train = spark.createDataFrame([(u, i, 3.0) for u, n in ((1, 9), (2, 10), (3, 49), (4, 50)) for i in range(n)], TEST)
    predictions = spark.createDataFrame(
        [(1, 1, 1.0, 2.0), (1, 2, 1.0, 4.0), (2, 1, 1.0, 9.0), (3, 1, 1.0, 9.0), (4, 1, 1.0, 1.5), (9, 1, 1.0, 9.0)],
        TEST + ", prediction double",
    )
    rows = {r.segment: (r.rmse, r.num_predictions) for r in metrics.cold_warm_rmse(train, predictions).collect()}
    assert rows == {"cold": (pytest.approx(math.sqrt(5)), 2), "warm": (0.5, 1)}
    gap = metrics.cold_warm_gap(train, predictions).first()
    assert gap.gap_pct == pytest.approx((math.sqrt(5) / 0.5 - 1) * 100)


def test_gap_to_nothing_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(relative_gap(F.col("a"), F.col("b"))).collect()] == [None, None, 50.0]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (2.5,), (9.0,), (None,)], "s double").select(clamp_rating(F.col("s")))
    assert [r[0] for r in df.collect()] == [0.5, 2.5, 5.0, None]


def test_stars(spark):
    df = spark.createDataFrame([(0.5,), (3.99,), (5.0,)], "r double").select(star_string(F.col("r")))
    assert [r[0] for r in df.collect()] == ["☆☆☆☆☆", "⭐⭐⭐☆☆", "⭐⭐⭐⭐⭐"]


pairs = st.tuples(st.integers(0, 4), st.integers(0, 6))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(pairs, st.sampled_from([3.5, 4.0, 5.0])), max_size=40), st.dictionaries(st.integers(0, 4), st.lists(st.integers(0, 6), unique=True, min_size=1)))
def test_ranking_equals_a_plain_loop(spark, rated, lists):
    test = spark.createDataFrame([(u, i, r) for (u, i), r in rated], TEST)
    recs = spark.createDataFrame([(u, i, 0.0, k) for u, items in lists.items() for k, i in enumerate(items, 1)], RECS)
    got = {r.k: (r.precision, r.recall) for r in metrics.precision_recall_at_k(test, recs, ks=(1, 3)).collect()}
    for k in (1, 3):
        scores = []
        for user, items in lists.items():
            relevant = [i for (u, i), r in rated if u == user and r >= 4]
            if relevant:
                hits = len(set(relevant) & set(items[:k]))
                scores.append((hits / len(items[:k]), hits / len(relevant)))
        if not scores:
            assert got[k] == (None, None)
            continue
        assert got[k] == pytest.approx(tuple(sum(x) / len(scores) for x in zip(*scores)))
        assert all(0 <= v <= 1 for v in got[k])
