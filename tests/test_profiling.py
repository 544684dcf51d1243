import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratingloom.operators import profiling, sketches

LAYOUT = "userId int, movieId int, rating float"


def table(spark, rows):
    return spark.createDataFrame(rows, LAYOUT)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.sampled_from([0.5, 3.0, 5.0])), min_size=2, max_size=60))
def test_statistics_equal_plain_python(spark, rows):
    got = profiling.dataset_statistics(table(spark, rows)).first()
    values = [r for _, _, r in rows]
    assert (got.total_ratings, got.avg_rating) == (len(rows), pytest.approx(statistics.mean(values)))
    assert got.std_rating == pytest.approx(statistics.stdev(values))
    for name, pos, number in (("user", 0, got.num_users), ("item", 1, got.num_items)):
        keys = [row[pos] for row in rows]
        counts = [keys.count(k) for k in set(keys)]
        assert number == len(counts)
        assert got[f"avg_ratings_per_{name}"] == pytest.approx(statistics.mean(counts))
        assert got[f"median_ratings_per_{name}"] == statistics.median_low(counts)
    assert got.sparsity == pytest.approx(1 - len(rows) / (got.num_users * got.num_items))


def test_statistics_of_nothing(spark):
    got = profiling.dataset_statistics(table(spark, [])).first()
    assert (got.total_ratings, got.num_users, got.num_items) == (0, 0, 0)
    assert got.sparsity is None and got.avg_rating is None and got.median_ratings_per_user is None


def test_a_missing_id_is_one_more_group(spark):
    rows = table(spark, [(1, 1, 3.0), (None, 1, 3.0), (None, None, None)])
    got = profiling.rating_totals(rows).first()
    assert (got.total_ratings, got.num_users, got.num_items) == (3, 2, 2)


def test_median_is_the_lower_of_two(spark):
    per_user = profiling.user_activity(table(spark, [(1, 1, 3.0), (2, 1, 3.0), (2, 2, 3.0)]))
    assert profiling.median_ratings(per_user).first().median_ratings == 1.0


def test_ties_in_the_top_lists_go_by_id(spark):
    per_user = profiling.user_activity(table(spark, [(u, i, 3.0) for u in (3, 1, 2) for i in (1, 2)] + [(9, 1, 1.0)]))
    assert [r.userId for r in profiling.top_active_users(per_user, 3).collect()] == [1, 2, 3]


def test_sketches_of_loads_merge_to_those_of_all(spark):
    rows = [(u % 700, (u * 31) % 90, float(u % 50) / 10) for u in range(4000)] + [(None, None, None)]
    ratings = table(spark, rows).withColumn("load", F.col("movieId") % 3)
    loads = sketches.load_sketches(ratings, F.col("load"))
    assert loads.count() == 4
    got = sketches.estimates(sketches.merged(loads)).first()
    whole = sketches.estimates(sketches.merged(sketches.load_sketches(ratings, F.lit(0)))).first()
    assert (got.n, got.num_users, got.num_items) == (4001, whole.num_users, whole.num_items)
    assert abs(got.num_users - 700) <= 30 and abs(got.num_items - 90) <= 4
    assert abs(got.median - 2.5) <= 0.2 and abs(got.q1 - 1.2) <= 0.2 and abs(got.q3 - 3.7) <= 0.2
    again = sketches.merged(sketches.merged(loads.filter("load = 0")).unionByName(sketches.merged(loads.filter("load is null or load > 0"))))
    assert sketches.estimates(again).first().num_users == got.num_users
