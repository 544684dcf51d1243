"""Hard negatives of anchors, by best-first search of STR-packed R-trees.

Rows are hashed into blocks; one task takes a block of rows with a block of
anchors, packs the rows into an R-tree (sort-tile-recursive) and searches it
once per anchor. The minimum bounding box of a node gives an interval for the
inner product of every row below it, coordinate by coordinate. A queue visits
the nodes with the highest upper end first and skips those whose interval lies
outside every open score window, or strictly below the k-th score found in it.
Small last steps merge the lists of the blocks.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import vectors
from ratingloom.session import durable

K = 5
FANOUT = 16
LEAF = 32
ROWS_PER_BLOCK = 16384
ANCHORS_PER_BLOCK = 1024


class RTree:
    """Rows packed into leaves, leaves into nodes, up to one root; level 0 holds the leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        self.order = _tiles(points, leaf)
        self.points = points[self.order]
        self.leaf, self.fanout = leaf, fanout
        starts = np.arange(0, len(points), leaf)
        boxes = [(np.minimum.reduceat(self.points, starts), np.maximum.reduceat(self.points, starts))]
        while len(boxes[-1][0]) > 1:
            low, high = boxes[-1]
            starts = np.arange(0, len(low), fanout)
            boxes.append((np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
        self.boxes = boxes
        self.visited = 0

    def children(self, level: int, node: int) -> tuple[int, int]:
        """First and last (exclusive) entry below a node: rows for a leaf, else nodes of the level beneath."""
        step, entries = (self.leaf, len(self.points)) if level == 0 else (self.fanout, len(self.boxes[level - 1][0]))
        return node * step, min((node + 1) * step, entries)


def _tiles(points: np.ndarray, leaf: int) -> np.ndarray:
    """Sort-tile-recursive order: slabs along one coordinate, each cut along the next, the widest spread first."""
    spread = points.astype(float).var(axis=0) if len(points) else np.zeros(points.shape[1])
    axes = np.argsort(-spread, kind="stable")
    parts, out = [(np.arange(len(points)), 0)], []
    while parts:
        rows, depth = parts.pop()
        if len(rows) <= leaf or depth == len(axes):
            out.append(rows)
            continue
        pages = -(-len(rows) // leaf)
        slabs = max(int(np.ceil(pages ** (1 / (len(axes) - depth)))), 2)
        rows = rows[np.argsort(points[rows, axes[depth]], kind="stable")]
        # Whole leaves per slab, so that no box spans two slabs.
        size = -(-pages // slabs) * leaf
        parts += [(rows[i : i + size], depth + 1) for i in range(0, len(rows), size)][::-1]
    return np.concatenate(out) if out else np.empty(0, int)


def search(tree: RTree, anchor: np.ndarray, windows: list[tuple[int, int]], allowed: np.ndarray, ids: np.ndarray, k: int):
    """For every window (least, most score) the ``k`` best allowed rows in it: indices and scores.

    Higher scores come first, then smaller ids; ``allowed`` and ``ids`` are in the order of the tree.
    """
    up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
    lows, highs = (np.array(list(ends), dtype=anchor.dtype) for ends in zip(*windows))
    # The least score that a window still takes: its low end, later its k-th score.
    needs = lows.copy()
    found = [(np.empty(0, int), np.empty(0, anchor.dtype))] * len(windows)
    top = len(tree.boxes) - 1
    queue: list[tuple] = [(-float("inf"), top, 0)]
    while queue:
        bound, level, node = heapq.heappop(queue)
        if -bound < needs.min():
            break
        first, last = tree.children(level, node)
        tree.visited += 1
        if level:
            low, high = (ends[first:last] for ends in tree.boxes[level - 1])
            upper = vectors.saturated(high @ up + low @ down)
            lower = vectors.saturated(low @ up + high @ down)
            live = ((lower[:, None] <= highs) & (upper[:, None] >= needs)).any(axis=1)
            for child in np.flatnonzero(live):
                heapq.heappush(queue, (-upper[child], level - 1, first + int(child)))
            continue
        scores = vectors.saturated(tree.points[first:last] @ anchor)
        rows = np.flatnonzero(allowed[first:last] & (scores >= needs.min()).astype(bool))
        if not len(rows):
            continue
        for w in range(len(windows)):
            hits = rows[((scores[rows] >= needs[w]) & (scores[rows] <= highs[w])).astype(bool)]
            if not len(hits):
                continue
            index = np.concatenate([found[w][0], hits + first])
            score = np.concatenate([found[w][1], scores[hits]])
            best = np.lexsort((ids[index], -score))[:k] if score.dtype != object else _sorted(score, ids[index])[:k]
            found[w] = index[best], score[best]
            if len(best) == k:
                needs[w] = score[best[-1]]
    return found


def _sorted(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i])), dtype=int)


def _miner(same_label: bool, k: int, share: tuple[int, int]):
    """Kernel over one block of anchors and one of rows; lists of the block, for a later merge."""

    def mine(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int, int, int]] = []
        if len(anchors) and len(rows):
            rows = rows.sort_by([("vec_id", "ascending"), ("_row", "ascending")])
            points, queries = vectors.comparable(vectors.weights(rows["_vector"]), vectors.weights(anchors["_vector"]))
            tree = RTree(points)
            ids, numbers, labels = (rows[c].to_numpy()[tree.order] for c in ("vec_id", "_row", "_label"))
            everything = (-np.inf, np.inf) if points.dtype != object else (vectors.LEAST, vectors.MOST)
            for i, (name, number, label) in enumerate(zip(*(anchors[c].to_pylist() for c in ("vec_id", "_row", "_label")))):
                if same_label:
                    allowed = (labels == label) & ~((ids == name) & (numbers == number))
                    windows = [everything]
                else:
                    allowed = labels != label
                    positives = anchors["_scores"][i].as_py()
                    # least * score <= 100 * negative, in whole numbers
                    windows = [(-(-share[0] * p // share[1]), p) for p in positives]
                for w, (index, scores) in enumerate(search(tree, queries[i], windows, allowed, ids, k)):
                    out += zip([name] * len(index), [number] * len(index), [w] * len(index),
                               ids[index].tolist(), numbers[index].tolist(), vectors.as_long(scores).tolist())
        columns = list(zip(*out)) or [[]] * 6
        return pa.table(dict(zip(_FOUND.names, columns)), schema=_FOUND)

    return mine


_FOUND = pa.schema(
    [("anchor_id", pa.int64()), ("_row", pa.int32()), ("_window", pa.int32()), ("vec_id", pa.int64()),
     ("_other", pa.int32()), ("score", pa.int64())]
)
_FOUND_DDL = "anchor_id long, _row int, _window int, vec_id long, _other int, score long"


def _best(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], kernel, k: int) -> DataFrame:
    """The ``k`` best rows of every anchor and window with their ``rank``, merged over the blocks."""
    a_blocks, r_blocks = blocks
    block = F.xxhash64("vec_id", "_row")
    left = anchors.select(
        "*", F.pmod(block, F.lit(a_blocks)).alias("_a"), F.explode(vectors.numbers(r_blocks)).alias("_r")
    )
    # Columns of its own, as the anchors come from the same table.
    right = rows.toDF(*rows.columns).select(
        "*", F.explode(vectors.numbers(a_blocks)).alias("_a"), F.pmod(block, F.lit(r_blocks)).alias("_r")
    )
    found = left.groupBy("_a", "_r").cogroup(right.groupBy("_a", "_r")).applyInArrow(kernel, _FOUND_DDL)
    order = Window.partitionBy("anchor_id", "_row", "_window").orderBy(F.desc("score"), "vec_id", "_other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    label: str = "label",
    every: int = 100,
    k: int = K,
    least_percent: int = 80,
    rows_per_block: int = ROWS_PER_BLOCK,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
) -> DataFrame:
    """Negatives of every anchor and positive: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``; positives
    are the ``k`` best other rows of the anchor's label, negatives the ``k`` best
    rows of another label whose score lies between ``least_percent`` of the
    positive's and the positive's. Weights are floor(256 * component), scores
    their integer inner products within 64 bits (saturated beyond); missing
    terms of a shorter vector weigh nothing. Equal scores rank by smaller
    ``vec_id``. Rows take no part that lack an id or a label, or whose vector is
    null or holds null or non-finite components. Repeated rows are rows of their
    own. A negative positive score gives an empty window; an anchor without
    positives, a positive without negatives and an empty table give no row.
    """
    rows = durable(vectors.usable(embeddings.filter(F.col(label).isNotNull()), F.col(label).alias("_label")), "vectors")
    is_anchor = F.col("vec_id") % every == 0
    counts = rows.agg(F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    blocks = (
        vectors.block_count(counts["anchors"], anchors_per_block),
        vectors.block_count(counts["rows"], rows_per_block),
    )
    anchors = rows.filter(is_anchor)
    positives = durable(
        _best(anchors, rows, blocks, _miner(True, k, (least_percent, 100)), k).select(
            "anchor_id", "_row", (F.col("rank") - 1).alias("_window"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # At most k scores each, in order of their rank.
    scores = positives.groupBy(F.col("anchor_id").alias("vec_id"), "_row").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_window", "positive_score"))), lambda x: x["positive_score"]
        ).alias("_scores")
    )
    sought = anchors.join(scores, ["vec_id", "_row"])
    negatives = _best(sought, rows, blocks, _miner(False, k, (least_percent, 100)), k)
    return positives.join(negatives, ["anchor_id", "_row", "_window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def relabelled(embeddings: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose ``vec_id`` is divisible by ``every`` take the next label, as planted errors."""
    following = (F.col("label").cast("long") + 1) % labels
    return embeddings.withColumn(
        "label", F.when(F.col("vec_id") % every == 0, following).otherwise(F.col("label").cast("long"))
    )
