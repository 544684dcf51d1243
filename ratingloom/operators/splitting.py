"""Train, validation and test split by time bucket."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions import bucket, hash32

TRAIN, VALIDATION, TEST = "train", "validation", "test"


def with_split(df: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1) -> DataFrame:
    """``df`` with a ``split`` column; the bucket of a row is ``timestamp % 100``.

    The bucket depends on the row alone, so the split is the same on every run.
    Limits are rounded to whole buckets, which keeps 0.55 * 100 at 55.
    """
    train_end = round(train_ratio * 100)
    val_end = round((train_ratio + val_ratio) * 100)
    b = bucket(F.col("timestamp"))
    name = F.when(b < train_end, TRAIN).when(b < val_end, VALIDATION).otherwise(TEST)
    return df.withColumn("split", F.when(b.isNotNull(), name))


def with_hash_split(
    df: DataFrame,
    seed: int,
    train_ratio: float = 0.8,
    val_ratio: float = 0.1,
    key: tuple[str, ...] = ("userId", "movieId", "timestamp"),
) -> DataFrame:
    """``df`` with a ``split`` that a seeded hash of ``key`` decides, whatever the time.

    Shares are those of ``with_split``; rows equal in ``key`` stay together, and
    a null in it counts as an empty text.
    """
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    b = hash32(text, seed) % 100
    name = F.when(b < round(train_ratio * 100), TRAIN).when(b < round((train_ratio + val_ratio) * 100), VALIDATION)
    return df.withColumn("split", name.otherwise(TEST))


def split_of(df: DataFrame, name: str, **ratios: float) -> DataFrame:
    return with_split(df, **ratios).filter(F.col("split") == name).drop("split")


def split_shares(with_split_column: DataFrame) -> DataFrame:
    """Rows of each split and their percentage of all rows."""
    counts = with_split_column.groupBy("split").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.select("split", "n", (F.col("n") * 100 / total.scalar()).alias("share_pct"))


def split_observed(with_split_column: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows themselves and the number of rows of each split, known once they have been written."""
    seen = Observation("split_shares")
    counts = [F.count_if(F.col("split") == name).alias(name) for name in (TRAIN, VALIDATION, TEST)]
    return with_split_column.observe(seen, *counts), seen


def shares_of(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``split_shares`` out of the observed number of rows of each split."""
    total = sum(counts.values())
    rows = [(name, n, n * 100 / total) for name, n in counts.items() if n]
    return spark.createDataFrame(rows, "split string, n long, share_pct double")
