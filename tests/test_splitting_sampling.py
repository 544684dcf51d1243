import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.operators import sampling, splitting


def times(spark, values):
    return spark.createDataFrame([(v,) for v in values], "timestamp long")


def test_bucket_limits(spark):
    rows = splitting.with_split(times(spark, [0, 79, 80, 89, 90, 99, 100, -5, None])).collect()
    assert [r.split for r in rows] == [
        "train", "train", "validation", "validation", "test", "test", "train", "train", None,
    ]


def test_ratio_is_rounded_to_whole_buckets(spark):
    row = splitting.with_split(times(spark, [55]), train_ratio=0.55, val_ratio=0.2).first()
    assert row.split == "validation"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-1000, 10**10), min_size=1, max_size=50), st.floats(0, 1), st.floats(0, 1))
def test_splits_are_disjoint_and_complete(spark, values, a, b):
    rows = times(spark, values)
    ratios = {"train_ratio": a, "val_ratio": b * (1 - a)}
    sizes = [splitting.split_of(rows, s, **ratios).count() for s in ("train", "validation", "test")]
    assert sum(sizes) == len(values)


def test_sample_does_not_depend_on_partitioning(spark):
    users = spark.range(20000).select((F.col("id") % 5000).cast("int").alias("user_idx"))
    first = {r[0] for r in sampling.sample_users(users, 0.1).collect()}
    again = {r[0] for r in sampling.sample_users(users.repartition(13), 0.1).collect()}
    other = {r[0] for r in sampling.sample_users(users, 0.1, seed=7).collect()}
    assert first == again != other
    assert 350 < len(first) < 650
    assert {r[0] for r in sampling.sample_users(users, 0.05).collect()} < first


def test_random_users(spark):
    users = spark.range(3).select(F.col("id").cast("int"))
    assert sampling.random_users(users, 20).count() == 3
    for n in (0, 21):
        with pytest.raises(ValueError):
            sampling.random_users(users, n)
