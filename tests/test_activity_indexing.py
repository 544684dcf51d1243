from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ratingloom.operators import activity, indexing
from ratingloom.session import durable

LAYOUT = "userId int, movieId int, rating float, timestamp long"


def table(spark, pairs):
    return spark.createDataFrame([(u, m, 3.0, i) for i, (u, m) in enumerate(pairs)], LAYOUT)


def test_filter_counts_before_filtering(spark):
    # User 1 keeps one of its two ratings, since item 9 is rare.
    pairs = [(1, 5), (1, 9), (2, 5), (2, 6), (3, 6)]
    kept = activity.filter_inactive(table(spark, pairs), 2, 2)
    assert {(r.userId, r.movieId) for r in kept.collect()} == {(1, 5), (2, 5), (2, 6)}
    assert kept.columns == ["userId", "movieId", "rating", "timestamp"]


def test_filter_of_nothing(spark):
    assert activity.filter_inactive(table(spark, []), 1, 1).count() == 0


def test_index_equals_string_indexer(spark):
    rows = spark.range(5000).select(
        (F.pmod(F.xxhash64("id"), F.lit(211))).cast("int").alias("userId"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(173)) * 7).cast("int").alias("movieId"),
    )
    rows = durable(rows, "rows")
    for key, index, name in (
        ("userId", indexing.user_index(rows), "user_idx"),
        ("movieId", indexing.item_index(rows), "item_idx"),
    ):
        expected = StringIndexer(inputCol=key, outputCol="x").fit(rows).transform(rows.select(key).distinct())
        different = index.join(expected, key, "full").filter(~F.col(name).eqNullSafe(F.col("x").cast("int")))
        assert different.count() == 0


def test_both_indices_from_one_pass_equal_the_single_ones(spark):
    rows = durable(table(spark, [(u, m) for u in range(40) for m in range(u % 7)]), "rows")
    users, items, _ = indexing.dense_indices(rows)
    assert users.exceptAll(indexing.user_index(rows)).count() == 0
    assert items.exceptAll(indexing.item_index(rows)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-3, 30), st.integers(0, 12)), min_size=1, max_size=60))
def test_index_is_a_permutation(spark, pairs):
    indexed = indexing.with_indices(durable(table(spark, pairs), "rows"))
    rows = indexed.collect()
    assert len(rows) == len(pairs)
    for raw, dense in (("userId", "user_idx"), ("movieId", "item_idx")):
        mapping = {(r[raw], r[dense]) for r in rows}
        assert sorted(d for _, d in mapping) == list(range(len({r[raw] for r in rows})))


def test_the_side_of_fewer_keys_comes_first(spark):
    for users, items in ((50, 4), (4, 50)):
        rows = [(u, m) for u in range(users) for m in range(items)]
        counts = activity.rating_counts(spark.createDataFrame(rows, "userId int, movieId int"))
        sides = activity.smaller_first(counts, activity.users_of(counts), activity.items_of(counts))
        assert [s[0] for s in sides] == (["item", "user"] if items < users else ["user", "item"])


def test_repeated_filtering_reaches_users_that_fell_below(spark):
    # User 9 has two ratings, one of an item that goes; a second pass takes the user, too.
    rows = [(u, m) for u in range(3) for m in range(3)] + [(9, 0), (9, 7)]
    ratings = spark.createDataFrame(rows, "userId int, movieId int")
    once = activity.filter_inactive(ratings, 2, 2)
    assert {r.userId for r in once.collect()} == {0, 1, 2, 9}
    assert {r.userId for r in activity.filter_inactive(ratings, 2, 2, iterations=2).collect()} == {0, 1, 2}
    report = activity.filter_report(ratings, once).first()
    assert (report.ratings_before, report.ratings_after, report.removed) == (11, 10, 1)
    assert (report.items_before, report.items_after, report.users_after) == (4, 3, 4)
