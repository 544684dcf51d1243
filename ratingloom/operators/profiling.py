"""Profile of a rating table: totals, distributions, activity and popularity.

``rating_groups`` groups per user, per item, per rating value and over everything
in a single scan; the reports are small aggregates over such groups.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.operators.cleaning import invalid_rating, null_rating

USER, ITEM, VALUE, ALL = "user", "item", "value", "all"
_SETS = {USER: ["userId"], ITEM: ["movieId"], VALUE: ["rating"], ALL: []}
_KEYS = ("userId", "movieId", "rating")


def _set_name() -> Column:
    name = F.lit(ALL)
    for label, keys in _SETS.items():
        if keys:
            name = F.when(F.grouping(keys[0]) == 0, label).otherwise(name)
    return name


def rating_groups(ratings: DataFrame, sets: tuple[str, ...] = (USER, ITEM, VALUE, ALL)) -> DataFrame:
    """One row per user, item, rating value and one for all rows, from one scan."""
    wide = ratings.select(
        *_KEYS,
        F.col("rating").cast("double").alias("r"),
        null_rating().alias("is_null"),
        invalid_rating().alias("is_invalid"),
    )
    return wide.groupingSets([_SETS[s] for s in sets], *_KEYS).agg(
        *([_set_name().alias("grp")] if len(sets) > 1 else [F.lit(sets[0]).alias("grp")]),
        F.count("*").alias("num_rows"),
        F.count("r").alias("num_ratings"),
        F.avg("r").alias("avg_rating"),
        F.stddev_samp("r").alias("std_rating"),
        F.min("r").alias("min_rating"),
        F.max("r").alias("max_rating"),
        F.count_if("is_null").alias("null_ratings"),
        F.count_if("is_invalid").alias("invalid_ratings"),
    )


def in_set(name: str) -> Column:
    return F.col("grp") == name


def _per_key(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(
        F.count("rating").alias("num_ratings"),
        F.avg(F.col("rating").cast("double")).alias("avg_rating"),
    )


def user_activity(ratings: DataFrame) -> DataFrame:
    """Number and average of ratings of every user."""
    return _per_key(ratings, "userId")


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Number and average of ratings of every item."""
    return _per_key(ratings, "movieId")


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating").agg(F.count("*").alias("n")).orderBy("rating")


def rating_stats(ratings: DataFrame) -> DataFrame:
    r = F.col("rating").cast("double")
    return ratings.agg(
        F.avg(r).alias("avg_rating"),
        F.stddev_samp(r).alias("std_rating"),
        F.min(r).alias("min_rating"),
        F.max(r).alias("max_rating"),
    )


def activity_stats(per_key: DataFrame) -> DataFrame:
    """Spread of the rating counts in ``user_activity`` or ``item_popularity``."""
    n = F.col("num_ratings")
    return per_key.agg(
        F.avg(n).alias("avg_ratings"),
        F.stddev_samp(n).alias("std_ratings"),
        F.min(n).alias("min_ratings"),
        F.max(n).alias("max_ratings"),
    )


def _with_median(histogram: DataFrame, *by: str) -> DataFrame:
    """Marks as ``is_median`` the count that half of the ``keys`` do not exceed.

    The histogram has one row per distinct rating count. N ratings allow at most
    sqrt(2N) distinct counts, so its windows stay small, and the median is exact.
    """
    up_to = F.sum("keys").over(Window.partitionBy(*by).orderBy("num_ratings"))
    total = F.sum("keys").over(Window.partitionBy(*by))
    ranked = histogram.withColumn("_up_to", up_to).withColumn("_half", total / 2)
    first = (F.col("_up_to") >= F.col("_half")) & (F.col("_up_to") - F.col("keys") < F.col("_half"))
    return ranked.withColumn("is_median", first).drop("_up_to", "_half")


def median_ratings(per_key: DataFrame) -> DataFrame:
    """Average and median rating count; the median is an actual count."""
    histogram = per_key.groupBy("num_ratings").agg(F.count("*").alias("keys"))
    n, keys = F.col("num_ratings"), F.col("keys")
    return _with_median(histogram).agg(
        (F.sum(n * keys) / F.sum(keys)).alias("avg_ratings"),
        F.max(F.when(F.col("is_median"), n)).cast("double").alias("median_ratings"),
    )


def cold_share(per_key: DataFrame, below: int = 5) -> DataFrame:
    """How many keys have fewer than ``below`` ratings, and their share."""
    cold = F.count_if(F.col("num_ratings") < below)
    return per_key.agg(
        cold.alias("cold"),
        F.count("*").alias("total"),
        (cold / F.when(F.count("*") > 0, F.count("*"))).alias("share"),
    )


def cold_shares(ratings: DataFrame, below: int = 5) -> DataFrame:
    """``cold_share`` of users and of items from one scan."""
    groups = rating_groups(ratings, (USER, ITEM))
    cold = F.count_if(F.col("num_ratings") < below)
    return groups.groupBy(F.col("grp").alias("side")).agg(
        cold.alias("cold"), F.count("*").alias("total"), (cold / F.count("*")).alias("share")
    )


def _sparsity(rows: Column, users: Column, items: Column) -> Column:
    cells = users.cast("double") * items
    return 1 - rows / F.when(cells > 0, cells)


def rating_totals(ratings: DataFrame) -> DataFrame:
    """One row: ratings, distinct users and items, sparsity of their matrix."""
    return totals_from(rating_groups(ratings, (USER, ITEM, ALL)))


def totals_from(groups: DataFrame) -> DataFrame:
    """``rating_totals`` out of ``rating_groups``."""
    # A group without an id counts as one more user or item.
    totals = groups.agg(
        F.coalesce(F.sum(F.when(in_set(ALL), F.col("num_rows"))), F.lit(0)).alias("total_ratings"),
        F.count_if(in_set(USER)).alias("num_users"),
        F.count_if(in_set(ITEM)).alias("num_items"),
    )
    return totals.withColumn(
        "sparsity", _sparsity(F.col("total_ratings"), F.col("num_users"), F.col("num_items"))
    )


def dataset_counts(ratings: DataFrame, movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Long ``(name, n)`` table of the totals of all three inputs."""
    totals = rating_totals(ratings).selectExpr(
        "stack(3, 'ratings', total_ratings, 'users', num_users, 'rated_items', num_items) as (name, n)"
    )
    return totals.union(row_count("movies", movies)).union(row_count("tags", tags))


def row_count(name: str, table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")


def dataset_statistics(ratings: DataFrame) -> DataFrame:
    """One row of nine statistics, from one scan of ``ratings``."""
    return _statistics(rating_groups(ratings, (USER, ITEM, ALL)))


def statistics_of_counts(counts: DataFrame, average: float | None, deviation: float | None) -> DataFrame:
    """``dataset_statistics`` out of the stored counts ``(side, n)`` of every user and item of ratings without nulls.

    ``average`` and ``deviation`` are those of all ratings.
    """
    nothing = F.lit(None).cast("double")
    sides = counts.select(
        F.col("side").alias("grp"), F.col("n").alias("num_ratings"), F.col("n").alias("num_rows"),
        nothing.alias("avg_rating"), nothing.alias("std_rating"),
    )
    whole = counts.agg(F.coalesce(F.sum(F.when(F.col("side") == USER, F.col("n"))), F.lit(0)).alias("n")).select(
        F.lit(ALL), "n", "n", F.lit(average).cast("double"), F.lit(deviation).cast("double")
    )
    return _statistics(sides.union(whole))


def _statistics(groups: DataFrame) -> DataFrame:
    # The row of the whole table passes through the histogram as its only entry.
    whole = ("num_rows", "avg_rating", "std_rating")
    histogram = groups.groupBy("grp", "num_ratings").agg(
        F.count("*").alias("keys"), *[F.max(F.when(in_set(ALL), F.col(c))).alias(c) for c in whole]
    )
    n, keys = F.col("num_ratings"), F.col("keys")

    def per(name: str, side: str) -> list[Column]:
        mine = in_set(side)
        return [
            (F.sum(F.when(mine, n * keys)) / F.sum(F.when(mine, keys))).alias(f"avg_ratings_per_{name}"),
            F.max(F.when(mine & F.col("is_median"), n)).cast("double").alias(f"median_ratings_per_{name}"),
        ]

    stats = _with_median(histogram, "grp").agg(
        F.coalesce(F.max("num_rows"), F.lit(0)).alias("total_ratings"),
        F.coalesce(F.sum(F.when(in_set(USER), keys)), F.lit(0)).alias("num_users"),
        F.coalesce(F.sum(F.when(in_set(ITEM), keys)), F.lit(0)).alias("num_items"),
        F.max("avg_rating").alias("avg_rating"),
        F.max("std_rating").alias("std_rating"),
        *per("user", USER),
        *per("item", ITEM),
    )
    sparsity = _sparsity(F.col("total_ratings"), F.col("num_users"), F.col("num_items"))
    head = ["total_ratings", "num_users", "num_items"]
    rest = [c for c in stats.columns if c not in head]
    return stats.select(*head, sparsity.alias("sparsity"), *rest)


def top_active_users(per_user: DataFrame, n: int = 10) -> DataFrame:
    """Users with the most ratings; equal counts in id order."""
    return per_user.orderBy(F.desc("num_ratings"), "userId").limit(n)


def top_rated_movies(per_item: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """Items with the most ratings among those that have a movie row."""
    return (
        per_item.join(movies.select("movieId", "title"), "movieId")
        .select("movieId", "title", "num_ratings", "avg_rating")
        .orderBy(F.desc("num_ratings"), "movieId")
        .limit(n)
    )
