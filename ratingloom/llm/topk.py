"""Exact top-k search by inner product, term at a time.

A vector is a sparse row of integer weights over terms (its positions). Queries
and candidates are hashed into blocks; one task takes one pair of blocks, keeps
the candidates as one posting list per term (the rows that have the term, and
their weights), and scatters each query's weighted postings into a dense array of
scores. Partition selection keeps the best k per query and block, and a small last
step merges the blocks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import vectors
from ratingloom.session import durable

K = 5
QUERIES_PER_BLOCK = 4096
# Bytes of candidates' weights in a block.
BLOCK_BYTES = 32 << 20
# Blocks are not made smaller than this only to occupy more cores.
LEAST_BLOCK = 2048
# Score cells held at once in a task.
SCORE_CELLS = 1 << 20


def postings_of(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it, in order, and their weights."""
    lists = []
    for column in weights.T:
        rows = np.flatnonzero(column)
        lists.append((rows, column[rows]))
    return lists


def score_block(n: int, postings: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray) -> np.ndarray:
    """Scores of ``n`` candidates, one line per query, added up term by term over the posting lists."""
    scores = np.zeros((len(queries), n), dtype=queries.dtype)
    for (rows, values), weights in zip(postings, queries.T):
        if len(rows) == n:
            # Every candidate has the term: its list is the whole line.
            for q in np.flatnonzero(weights):
                scores[q] += weights[q] * values
        elif len(rows):
            for q in np.flatnonzero(weights):
                scores[q, rows] += weights[q] * values
    return scores


_FOUND = pa.schema([("query_id", pa.int64()), ("_row", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _best(k: int):
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            right = right.sort_by([("vec_id", "ascending"), ("_row", "ascending")])
            ids, rows = right["vec_id"].to_numpy(), right["_row"].to_numpy()
            names, own = left["vec_id"].to_numpy(), left["_row"].to_numpy()
            candidates, queries = vectors.comparable(vectors.weights(right["_vector"]), vectors.weights(left["_vector"]))
            postings = postings_of(candidates)
            step = max(SCORE_CELLS // len(ids), 1)
            for start in range(0, len(names), step):
                scores = vectors.saturated(score_block(len(ids), postings, queries[start : start + step]))
                for line, name, row in zip(scores, names[start : start + step], own[start : start + step]):
                    keep = np.flatnonzero((ids != name) | (rows != row))
                    if len(keep) > k:
                        values = line[keep]
                        if values.dtype == object:
                            floor = sorted(values, reverse=True)[k - 1]
                        else:
                            floor = np.partition(values, len(values) - k)[len(values) - k]
                        above = keep[values > floor]
                        # Ties at the floor go to the smaller ids; candidates are in order of id.
                        keep = np.concatenate([above, keep[values == floor][: k - len(above)]])
                    out.append((np.full(len(keep), name), np.full(len(keep), row), ids[keep], vectors.as_long(line[keep])))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, _FOUND.types)], schema=_FOUND)

    return best


def top_k(
    embeddings: DataFrame,
    k: int = K,
    query_every: int = 50,
    queries_per_block: int = QUERIES_PER_BLOCK,
    candidates_per_block: int | None = None,
) -> DataFrame:
    """The ``k`` best rows for every query of ``embeddings(vec_id, embedding)``: ``query_id, rank, vec_id, score``.

    Queries are the rows whose ``vec_id`` is divisible by ``query_every``;
    candidates are all rows but the query's own, so a repeated row finds its
    twin. Weights are floor(256 * component), the score is the integer inner
    product (saturated to 64 bits), missing terms of a shorter vector weigh
    nothing. Equal scores rank by smaller ``vec_id``. Vectors that are null or
    hold null or non-finite components take no part, nor do rows without id.
    Fewer than ``k`` candidates give fewer rows; an empty table gives none. A
    block of candidates takes ``BLOCK_BYTES`` of weights, unless their number is
    given.
    """
    rows = durable(vectors.usable(embeddings), "vectors")
    is_query = F.col("vec_id") % query_every == 0
    counts = rows.agg(
        F.count("*").alias("n"), F.count_if(is_query).alias("queries"), F.max(F.size("_vector")).alias("width")
    ).first()
    q_blocks = vectors.block_count(counts["queries"], queries_per_block)
    fit = candidates_per_block or max(BLOCK_BYTES // (8 * max(counts["width"] or 1, 1)), 1)
    c_blocks = vectors.block_count(counts["n"], fit)
    if not candidates_per_block:
        cores = embeddings.sparkSession.sparkContext.defaultParallelism
        c_blocks = max(c_blocks, min(2 * cores, vectors.block_count(counts["n"], LEAST_BLOCK)))
    block = F.xxhash64("vec_id", "_row")
    queries = rows.filter(is_query).select(
        "*", F.pmod(block, F.lit(q_blocks)).alias("q"), F.explode(vectors.numbers(c_blocks)).alias("c")
    )
    # Columns of its own, as the queries come from the same table.
    candidates = rows.toDF(*rows.columns).select(
        "*", F.explode(vectors.numbers(q_blocks)).alias("q"), F.pmod(block, F.lit(c_blocks)).alias("c")
    )
    found = (
        queries.groupBy("q", "c")
        .cogroup(candidates.groupBy("q", "c"))
        .applyInArrow(_best(k), "query_id long, _row int, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
