"""Joins of a rating table with a per-key table when a few keys hold most rows."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# At most MAX_HOT_KEYS keys can each hold 1/MAX_HOT_KEYS of the rows, so the
# table of hot keys is small whatever the data. Up to MIN_HOT_ROWS rows of a
# key are left to one task.
MAX_HOT_KEYS = 100_000
MIN_HOT_ROWS = 2_000_000


def _limit(total: int | None, largest: int | None) -> int | None:
    if total is None or largest is None:
        return None
    limit = max(MIN_HOT_ROWS, math.ceil(total / MAX_HOT_KEYS))
    return limit if largest > limit else None


def hot_limit(per_key: DataFrame, weight: str = "n") -> int | None:
    """Rows per part when keys must be split, or null when no key is that heavy.

    Fewer than ``MAX_HOT_KEYS`` keys can have more rows than this limit.
    """
    return _limit(*per_key.agg(F.sum(weight), F.max(weight)).first())


def hot_limits(per_key: DataFrame, by: str, weight: str = "n") -> dict[str, int | None]:
    """``hot_limit`` of every kind of key in one table; ``by`` has a few values."""
    rows = per_key.groupBy(by).agg(F.sum(weight), F.max(weight)).collect()
    return {kind: _limit(total, largest) for kind, total, largest in rows}


def split_join(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    limit: int | None,
    how: str = "inner",
    weight: str = "n",
) -> DataFrame:
    """Equi-join of ``rows`` with a stored table of one row per key.

    ``weight`` is the row count of the key; it is dropped. ``limit`` comes from
    ``hot_limit``; without it this is a plain join. Otherwise rows of a hot key
    are spread over parts of ``limit`` rows, and its single row in ``per_key`` is
    repeated per part, in total less than ``2 * MAX_HOT_KEYS`` times.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join type: {how}")
    if limit is None:
        return rows.join(per_key.drop(weight), key, how)

    parts = F.ceil(F.col(weight) / limit).cast("int")
    # Fewer than MAX_HOT_KEYS rows, see hot_limit.
    hot = F.broadcast(per_key.filter(F.col(weight) > limit).select(key, parts.alias("_parts")))
    # Row content and partition number: the same part again when a task is
    # retried, and copies of one row still spread over the map tasks.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.col("_parts"))
    part = F.when(F.col("_parts").isNull(), 0).otherwise(spread.cast("int"))
    left = rows.join(hot, key, "left").withColumn("_part", part).drop("_parts")
    right = per_key.withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1))
    ).drop(weight)
    return left.join(right, [key, "_part"], how).drop("_part")
