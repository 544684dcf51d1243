from ratingloom.functions.scalars import (
    bucket,
    clamp_rating,
    dot,
    hash32,
    hash_below,
    relative_gap,
    safe_ratio,
    star_string,
)

__all__ = [
    "bucket",
    "clamp_rating",
    "dot",
    "hash32",
    "hash_below",
    "relative_gap",
    "safe_ratio",
    "star_string",
]
