"""Rating counts per user and item, and the filter built on them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.skew import hot_limits, split_join
from ratingloom.session import durable

USER_SIDE = "user"
ITEM_SIDE = "item"


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Row counts of every user and every item: ``(side, userId, movieId, n)``.

    Grouping sets give both from one scan, with partial counts before the
    shuffle. The id of the other side is null.
    """
    user_rows = F.grouping("userId") == 0
    return ratings.groupingSets([["userId"], ["movieId"]], "userId", "movieId").agg(
        F.when(user_rows, USER_SIDE).otherwise(ITEM_SIDE).alias("side"),
        F.count("*").alias("n"),
    )


def users_of(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("side") == USER_SIDE).select("userId", "n")


def items_of(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("side") == ITEM_SIDE).select("movieId", "n")


def smaller_first(counts: DataFrame, users: DataFrame, items: DataFrame) -> list[tuple[str, DataFrame, str]]:
    """``(side, table, key)`` of both sides, that of fewer keys in ``counts`` first."""
    keys = {row["side"]: row["count"] for row in counts.groupBy("side").count().collect()}
    sides = [(ITEM_SIDE, items, "movieId"), (USER_SIDE, users, "userId")]
    return sorted(sides, key=lambda side: keys.get(side[0], 0))


def active_users(ratings: DataFrame, min_ratings: int = 20) -> DataFrame:
    counts = ratings.groupBy("userId").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_ratings)


def active_items(ratings: DataFrame, min_ratings: int = 5) -> DataFrame:
    counts = ratings.groupBy("movieId").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_ratings)


def filter_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: ratings, users and items before and after the activity filter, and ratings removed."""
    sides = []
    for name, ratings in (("before", before), ("after", after)):
        per_side = rating_counts(ratings).agg(
            F.coalesce(F.sum(F.when(F.col("side") == USER_SIDE, F.col("n"))), F.lit(0)).alias(f"ratings_{name}"),
            F.count_if(F.col("side") == USER_SIDE).alias(f"users_{name}"),
            F.count_if(F.col("side") == ITEM_SIDE).alias(f"items_{name}"),
        )
        sides.append(per_side.withColumn("one", F.lit(1)))
    joined = sides[0].join(sides[1], "one").drop("one")
    return joined.withColumn("removed", F.col("ratings_before") - F.col("ratings_after"))


def filter_report_of_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``filter_report`` out of the stored counts ``(side, n)`` of every user and item, without their ratings."""
    user, item = F.col("side") == USER_SIDE, F.col("side") == ITEM_SIDE
    both = before.select("side", "n", F.lit("before").alias("at")).union(after.select("side", "n", F.lit("after")))
    columns = []
    for name in ("before", "after"):
        here = F.col("at") == name
        columns += [
            F.coalesce(F.sum(F.when(user & here, F.col("n"))), F.lit(0)).alias(f"ratings_{name}"),
            F.count_if(user & here).alias(f"users_{name}"),
            F.count_if(item & here).alias(f"items_{name}"),
        ]
    return both.agg(*columns).withColumn("removed", F.col("ratings_before") - F.col("ratings_after"))


def filter_inactive(
    ratings: DataFrame,
    min_user_ratings: int = 20,
    min_item_ratings: int = 5,
    iterations: int = 1,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Ratings whose user and item both have enough ratings in ``ratings``.

    Both counts are taken before either filter, so a survivor may fall below its
    minimum; each of ``iterations`` filters the result of the one before and
    stores it. The counts are written once: the planner then knows their size and
    broadcasts the small side of each semi-join, or shuffles both beyond that. The
    side of fewer keys comes first, so that fewer rows reach the other. ``counts``
    are the stored ``rating_counts`` where they are at hand.
    """
    if iterations > 1:
        once = filter_inactive(ratings, min_user_ratings, min_item_ratings, counts=counts)
        return filter_inactive(durable(once, "active"), min_user_ratings, min_item_ratings, iterations - 1)
    if counts is None:
        counts = durable(rating_counts(ratings), "rating-counts", partition_by="side")
    users = users_of(counts).filter(F.col("n") >= min_user_ratings)
    items = items_of(counts).filter(F.col("n") >= min_item_ratings)
    limits = hot_limits(counts, "side")
    kept = ratings
    for side, per_key, key in smaller_first(counts, users, items):
        kept = split_join(kept, per_key, key, limits.get(side), "left_semi")
    return kept.select(*ratings.columns)
