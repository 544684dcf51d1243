"""Integer weights of embedding tables, shared by the exact searches."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SCALE = 256
# Sums of products below this bound are exact in double precision.
_EXACT = 2**53
LEAST, MOST = -(2**63), 2**63 - 1


def usable(vectors: DataFrame, *others: Column) -> DataFrame:
    """``vec_id, _row, _vector`` and ``others`` of the rows that have an id and finite weights only.

    A component that is null, not finite, or not finite once scaled leaves its
    row out. ``_row`` numbers the rows of one id in order of their content, so
    that repeated rows stay apart and reruns agree.
    """
    scaled = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
    rows = vectors.filter(kept).select(
        "vec_id", F.transform(scaled, lambda x: x / SCALE).alias("_vector"), *others
    )
    extra = [name for name in rows.columns if name not in ("vec_id", "_vector")]
    same_id = Window.partitionBy("vec_id").orderBy("_vector", *extra)
    return rows.select("vec_id", F.row_number().over(same_id).alias("_row"), "_vector", *extra)


def numbers(n: int) -> Column:
    """The numbers 0 to n - 1 as an array."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def weights(column: pa.ChunkedArray) -> np.ndarray:
    """Weights floor(256 * component), one row per vector; short vectors are padded with zero."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.diff(lists.offsets.to_numpy())
    values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * SCALE)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def comparable(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides with the same width, as doubles where every score is exact, else as Python integers."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = [float(np.abs(x).max(initial=0)) for x in (left, right)]
    if width * most[0] * most[1] < _EXACT:
        return left, right
    whole = np.frompyfunc(int, 1, 1)
    return whole(left), whole(right)


def saturated(scores: np.ndarray) -> np.ndarray:
    """Scores within 64 bits."""
    if scores.dtype == object:
        return np.minimum(np.maximum(scores, LEAST), MOST)
    return scores


def as_long(scores: np.ndarray) -> np.ndarray:
    return saturated(scores).astype(np.int64)


def block_count(rows: int, per_block: int) -> int:
    return max(math.ceil(rows / per_block), 1)
