"""Table layouts shared by every source, operator and job."""

from pyspark.sql import types as T

# The valid rating range, the relevance threshold, the genre
# placeholder, the score display range and the request size limits.
MIN_RATING = 0.5
MAX_RATING = 5.0
RELEVANT_RATING = 4.0
NO_GENRES = "(no genres listed)"
MIN_REQUEST = 1
MAX_REQUEST = 100
RANKING_KS = (5, 10, 20)

RATINGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

TAGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

INDEXED = T.StructType(
    RATINGS.fields
    + [
        T.StructField("user_idx", T.IntegerType()),
        T.StructField("item_idx", T.IntegerType()),
    ]
)

USER_INDEX = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("user_idx", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)

ITEM_INDEX = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("item_idx", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)

FACTORS = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("features", T.ArrayType(T.FloatType())),
    ]
)

# Canonical long form of a recommendation list: one row per slot, rank from 1.
RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_idx", T.IntegerType()),
        T.StructField("item_idx", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("k", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)
