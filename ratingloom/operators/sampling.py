"""User samples that do not depend on partitioning."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import hash32, hash_below

SEED = 42


def sample_users(df: DataFrame, fraction: float, seed: int = SEED, key: str = "user_idx") -> DataFrame:
    """About ``fraction`` of the distinct users of ``df``."""
    return df.select(key).filter(hash_below(F.col(key), fraction, seed)).distinct()


def random_users(users: DataFrame, n: int = 5, seed: int = SEED, key: str = "id") -> DataFrame:
    """``n`` users in a seed-dependent order; ``1 <= n <= 20``."""
    if not 1 <= n <= 20:
        raise ValueError("n must be between 1 and 20")
    return users.select(key).distinct().orderBy(hash32(F.col(key), seed), key).limit(n)
