"""Rating tables derived from the driver's star-schema tables.

Every function reads whole tables; `oracle.py` has the matching SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators import indexing
from ratingloom.operators.activity import filter_inactive
from ratingloom.operators.indexing import with_indices
from ratingloom.operators.skew import hot_limit, split_join
from ratingloom.operators.splitting import with_split
from ratingloom.session import durable

# Every item has at least 11 ratings, so higher minimums are needed to remove some.
MIN_USER_RATINGS = 30
MIN_ITEM_RATINGS = 25


def _epoch_seconds(time: str) -> Column:
    """Seconds since 1970 of a time without zone, whatever the session's zone."""
    day = F.unix_date(F.col(time).cast("date")).cast("long")
    return ((day * 24 + F.hour(time)) * 60 + F.minute(time)) * 60 + F.second(time)


_LAYOUTS = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_type string, p_size int",
    "customer": "c_custkey long, c_nationkey int",
    "events": "ts timestamp_ntz, user_id long, event_type string, props string",
    "embeddings": "vec_id long, embedding array<float>",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_LAYOUTS[name]).parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as ratings; quantities 1 to 4 give values below the valid range."""
    lines = _table(spark, folder, "lineitem")
    # The conversion runs per order here; after the join it would run per line.
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", _epoch_seconds("o_orderdate").alias("o_epoch"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.col("l_quantity") / 10).cast("float").alias("rating"),
        (F.col("o_epoch") + F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("timestamp"),
    )


def dirty_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """``ratings`` with some fields missing and some values not a number."""
    t = F.col("timestamp")
    return ratings(spark, folder).select(
        F.when(t % 97 != 0, F.col("userId")).alias("userId"),
        F.when(t % 89 != 0, F.col("movieId")).alias("movieId"),
        F.when(t % 83 == 0, None)
        .when(t % 79 == 0, F.lit(float("nan")).cast("float"))
        .otherwise(F.col("rating"))
        .alias("rating"),
        "timestamp",
    )


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as movies, some without genre."""
    size = F.col("p_size")
    genres = F.when(size < 5, "(no genres listed)").when(size < 10, None).otherwise(F.col("p_type"))
    return (
        _table(spark, folder, "part")
        .select(
            F.col("p_partkey").cast("int").alias("movieId"),
            F.col("p_name").alias("title"),
            genres.alias("genres"),
        )
    )


def titled_movies(spark: SparkSession, folder: str) -> DataFrame:
    """``movies`` without the largest parts, so that some rated items have no title."""
    large = _table(spark, folder, "part").filter(F.col("p_size") >= 50).select(F.col("p_partkey").alias("movieId"))
    return movies(spark, folder).join(large, "movieId", "left_anti")


def tags(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("userId"),
        F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("movieId"),
        F.col("event_type").alias("tag"),
        _epoch_seconds("ts").alias("timestamp"),
    )


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return ratings(spark, folder).filter(F.col("rating").between(0.5, 5.0))


def processed(spark: SparkSession, folder: str) -> DataFrame:
    return filter_inactive(clean(spark, folder), MIN_USER_RATINGS, MIN_ITEM_RATINGS)


_prepared: dict[str, DataFrame] = {}
_item_index: dict[str, DataFrame] = {}


def prepare_once(spark: SparkSession, folder: str) -> None:
    """Let ``indexed`` and ``item_index`` return one stored table for the rest of the session."""
    _prepared[folder] = indexed(spark, folder)
    items = _prepared[folder].groupBy("movieId", "item_idx").agg(F.count("*").alias("n"))
    _item_index[folder] = durable(items, "item-index")


def item_index(spark: SparkSession, folder: str) -> DataFrame:
    """``movieId, item_idx, n`` of the active items."""
    if folder in _item_index:
        return _item_index[folder]
    return indexing.item_index(processed(spark, folder))


def indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Active ratings with dense ids and split, stored once per call."""
    if folder in _prepared:
        return _prepared[folder]
    stored = durable(processed(spark, folder), "processed")
    return durable(with_split(with_indices(stored)), "indexed", partition_by="split")


def predictions(rows: DataFrame, item: str = "item_idx") -> DataFrame:
    """The train mean of the item as a stand-in prediction for all other rows."""
    means = (
        rows.filter("split = 'train'")
        .groupBy(item)
        .agg(F.avg(F.col("rating").cast("double")).alias("prediction"), F.count("*").alias("n"))
    )
    means = durable(means, "means")
    return split_join(rows.filter("split <> 'train'"), means, item, hot_limit(means))


def factors(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding as a factor vector; it serves as user and as item."""
    return _table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
    )


def flawed_factors(spark: SparkSession, folder: str) -> DataFrame:
    """``factors`` with some vectors null, shortened or holding NaN or infinity."""
    id, vector = F.col("id"), F.col("features")
    first = F.when(id % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))).cast("float")
    flawed = (
        F.when(id % 11 == 0, None)
        .when(id % 13 == 0, F.slice(vector, 1, 5))
        .when(id % 7 == 0, F.concat(F.array(first), F.slice(vector, 2, F.size(vector) - 1)))
        .otherwise(vector)
    )
    return factors(spark, folder).select("id", flawed.alias("features"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per customer; most customers have no factor vector."""
    return _table(spark, folder, "customer").select(
        F.col("c_custkey").cast("int").alias("user_id"),
        (F.col("c_nationkey") + 1).cast("int").alias("num_recommendations"),
    )
