"""Dense integer ids for users and items.

The order is that of MLlib's default StringIndexer (most frequent first, ties by
the id as text), but labels never reach the driver: ranks come from a range
partitioning, so the tables may hold billions of ids.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.operators.activity import ITEM_SIDE, USER_SIDE, rating_counts
from ratingloom.operators.skew import hot_limits, split_join
from ratingloom.session import durable

# monotonically_increasing_id() keeps the row number of a partition in its lower 33 bits.
_ROW_BITS = 33


def _ordered(counts: DataFrame, order: list, partition_by: str | None = None) -> DataFrame:
    """``counts`` stored in range partitions: ``_chunk`` and ``_row`` give the order."""
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = durable(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered-counts", partition_by)
    chunk = F.shiftright("_id", _ROW_BITS)
    return stored.withColumn("_chunk", chunk).withColumn("_row", F.col("_id") - F.shiftleft(chunk, _ROW_BITS)).drop("_id")


def _with_position(rows: DataFrame, ordered: DataFrame) -> DataFrame:
    """``rows`` of ``ordered`` with their global position ``_pos``."""
    # One row per range partition, so the window and the broadcast stay as small
    # as the number of tasks.
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy("_chunk")
        .agg(F.count("*").alias("_size"))
        .select("_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        rows.join(F.broadcast(starts), "_chunk")
        .withColumn("_pos", F.col("_start") + F.col("_row"))
        .drop("_chunk", "_row", "_start")
    )


def dense_indices(ratings: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int | None]]:
    """Both indices from one pass, with the hot limits of their keys.

    ``(userId, user_idx, n)``, ``(movieId, item_idx, n)``, ``{side: limit}``.
    """
    label = F.coalesce(F.col("userId"), F.col("movieId")).cast("string")
    order = [F.col("side"), F.col("n").desc(), label]
    ordered = _ordered(rating_counts(ratings), order, partition_by="side")
    items = ordered.filter(F.col("side") == ITEM_SIDE)
    users = ordered.filter(F.col("side") == USER_SIDE)
    # Items sort before users, so user positions start after the last item.
    n_items = items.agg(F.count("*")).scalar()
    user_idx = (F.col("_pos") - n_items).cast("int").alias("user_idx")
    item_idx = F.col("_pos").cast("int").alias("item_idx")
    return (
        _with_position(users, ordered).select("userId", user_idx, "n"),
        _with_position(items, ordered).select("movieId", item_idx, "n"),
        hot_limits(ordered, "side"),
    )


def user_index(ratings: DataFrame) -> DataFrame:
    return _single_index(ratings, "userId", "user_idx")


def item_index(ratings: DataFrame) -> DataFrame:
    return _single_index(ratings, "movieId", "item_idx")


def _single_index(ratings: DataFrame, key: str, name: str) -> DataFrame:
    counts = ratings.groupBy(key).agg(F.count("*").alias("n"))
    ordered = _ordered(counts, [F.col("n").desc(), F.col(key).cast("string")])
    return _with_position(ordered, ordered).select(key, F.col("_pos").cast("int").alias(name), "n")


def with_indices(ratings: DataFrame, indices: tuple[DataFrame, DataFrame, dict] | None = None) -> DataFrame:
    """Ratings with ``user_idx`` and ``item_idx`` by their own counts.

    ``ratings`` should be a stored table, since it is read twice. ``indices`` are
    those of ``dense_indices`` where they are at hand. The index of fewer keys is
    joined first: it may fit a broadcast and then moves no rating.
    """
    users, items, limits = indices or dense_indices(ratings)
    sides = [(ITEM_SIDE, items, "movieId"), (USER_SIDE, users, "userId")]
    sizes = {side: table.count() for side, table, _ in sides}
    joined = ratings
    for side, table, key in sorted(sides, key=lambda s: sizes[s[0]]):
        joined = split_join(joined, table, key, limits.get(side))
    return joined.select(*ratings.columns, "user_idx", "item_idx")
