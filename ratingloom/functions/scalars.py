"""Column expressions; all of them stay inside JVM code generation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.schemas import MAX_RATING, MIN_RATING

_HASH_RANGE = 2**32


def clamp_rating(score: Column) -> Column:
    """Score as shown to people; ranking keeps the raw score. Null stays null."""
    # least and greatest skip nulls.
    inside = F.least(F.lit(MAX_RATING), F.greatest(F.lit(MIN_RATING), score))
    return F.when(score.isNotNull(), inside)


def star_string(rating: Column) -> Column:
    """Five stars, the whole part of ``rating`` filled."""
    full = rating.cast("int")
    return F.concat(F.repeat(F.lit("⭐"), full), F.repeat(F.lit("☆"), F.lit(5) - full))


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where ``whole`` is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def relative_gap(value: Column, base: Column) -> Column:
    """By how many percent ``value`` exceeds ``base``; null for a base of 0."""
    return (value / F.when(base != 0, base) - 1) * 100


def dot(left: Column, right: Column) -> Column:
    """Dot product of two float arrays in double precision."""
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def bucket(epoch_seconds: Column) -> Column:
    """Split bucket of a row; keeps the sign of a time before 1970."""
    return epoch_seconds % 100


def hash32(key: Column, seed: int) -> Column:
    """First 32 bits of md5 over seed and key: the same on every partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_below(key: Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the distinct keys."""
    return hash32(key, seed) < int(fraction * _HASH_RANGE)
