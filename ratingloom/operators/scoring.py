"""Top-N recommendations from factor tables, and the batch request job."""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom import schemas
from ratingloom.functions import clamp_rating
from ratingloom.operators.skew import hot_limit, split_join
from ratingloom.session import durable

# Bytes of vectors (as doubles) on each side of one block, and pairs in it. Every
# vector travels once per block of the other side, so larger blocks mean less shuffle.
BLOCK_BYTES = 64 * 1024 * 1024
BLOCK_PAIRS = 4_000_000
# Rows one block returns at most (users of a cell times n): as many as a full block gives at n = 20.
BLOCK_ROWS = 20 * (BLOCK_BYTES // (8 * 64))
# Cells are not made smaller than this only to occupy more cores.
MIN_CELL = 256
MAX_TASKS = 100_000
# Blocks of so many items are searched by boxes: items in a leaf (up to twice as many), binary levels in one
# step, share of the block at which a user is left to the whole product, numbers in one step of the search.
TREE_FROM = 16_384
LEAF, FAN_BITS, HARD_SHARE, CHUNK_FLOATS = 32, 3, 1 / 16, 4_000_000


def _problem(rank: int) -> Column:
    """Why a vector cannot be scored; null when it can."""
    entries = F.exists("features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        F.when(F.col("features").isNull(), "null")
        .when(F.size("features") != rank, "length")
        .when(entries, "not finite")
    )


def vector_rank(user_factors: DataFrame, item_factors: DataFrame) -> int:
    """The most frequent vector length, of items where there are any; the smallest of equals."""
    return _most_frequent(_lengths([item_factors, user_factors]))


def rejected_factors(user_factors: DataFrame, item_factors: DataFrame, rank: int | None = None) -> DataFrame:
    """Vectors that cannot be scored: ``side, id, problem`` (null, length, not finite)."""
    rank = vector_rank(user_factors, item_factors) if rank is None else rank
    sides = [
        factors.select(F.lit(side).alias("side"), "id", _problem(rank).alias("problem"))
        for side, factors in (("user", user_factors), ("item", item_factors))
    ]
    return sides[0].union(sides[1]).filter(F.col("problem").isNotNull())


@dataclass(frozen=True)
class _Grid:
    """Users hashed into cells, items into slices; a cell of many pairs is divided further."""

    cells: int
    slices: int
    rank: int
    cores: int = 1

    def cell(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.cells)).cast("int").alias("cell")

    def slice(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.slices)).cast("int").alias("slice")


def _numbers(parts: int | Column) -> Column:
    last = F.lit(parts - 1) if isinstance(parts, int) else parts - 1
    return F.explode(F.sequence(F.lit(0), last))


def _lengths(factors: list[DataFrame]) -> list[dict[int, tuple[int, int]]]:
    """For each table, by vector length (null vectors: -1): rows, and rows whose entries are all finite.

    One job for all tables. A length needs a vector that long, so there are no
    more of them than the longest vector has entries.
    """
    usable = F.col("features").isNotNull() & ~F.exists(
        "features", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    parts = [
        f.select(F.lit(i).alias("side"), F.coalesce(F.size("features"), F.lit(-1)).alias("length"), usable.alias("fine"))
        for i, f in enumerate(factors)
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    rows = rows.groupBy("side", "length").agg(F.count("*").alias("n"), F.count_if("fine").alias("fine")).collect()
    return [{max(r["length"], -1): (r["n"], r["fine"]) for r in rows if r["side"] == i} for i in range(len(factors))]


def _most_frequent(sides: list[dict[int, tuple[int, int]]]) -> int:
    """The most frequent length of the first table that has vectors; the smallest of equals."""
    for side in sides:
        lengths = {length: n for length, (n, _) in side.items() if length >= 0}
        if lengths:
            return min(lengths, key=lambda length: (-lengths[length], length))
    return 0


def _checked(
    user_factors: DataFrame,
    item_factors: DataFrame,
    rejects: str,
    users_per_cell: int | None,
    items_per_slice: int | None,
    n: float | None = None,
) -> tuple[DataFrame, DataFrame, _Grid]:
    """Vectors fit for scoring and their grid. ``rejects``: ``fail`` or ``skip`` those that are not.

    ``n`` is the number of rows that a user takes out of a block, on average.
    """
    if rejects not in ("fail", "skip"):
        raise ValueError("rejects must be fail or skip")
    of_users, of_items = _lengths([user_factors, item_factors])
    rank = _most_frequent([of_items, of_users])
    counts = [
        {"n": sum(n for n, _ in side.values()), "good": side.get(rank, (0, 0))[1]} for side in (of_users, of_items)
    ]
    bad = [c["n"] - c["good"] for c in counts]
    if rejects == "fail" and any(bad):
        raise ValueError(
            f"{bad[0]} user and {bad[1]} item vectors are null, not finite or not of length "
            f"{rank}; rejected_factors lists them, rejects='skip' leaves them out"
        )
    if any(bad):
        fit = _problem(rank).isNull()
        user_factors, item_factors = user_factors.filter(fit), item_factors.filter(fit)
    n_users, n_items = (c["good"] for c in counts)
    fit = max(BLOCK_BYTES // (8 * max(rank, 1)), 1)
    cores = user_factors.sparkSession.sparkContext.defaultParallelism
    slices = max(math.ceil(n_items / (items_per_slice or fit)), 1)
    to_fill_cores = min(math.ceil(2 * cores / slices), math.ceil(n_users / MIN_CELL))
    # A cell's users take their rows out of every block: their number is bounded too.
    per_cell = users_per_cell or (fit if n is None else min(fit, max(int(BLOCK_ROWS / n), 1)))
    cells = max(math.ceil(n_users / per_cell), to_fill_cores, 1)
    return user_factors, item_factors, _Grid(cells, slices, rank, cores)


def _task_keys(spark: SparkSession, tasks: int) -> DataFrame:
    """``task, key``: for each of ``tasks`` shuffle partitions a number that is hashed into it.

    Hashing the block numbers themselves would leave a third of the tasks empty
    and give others several blocks.
    """
    numbers = spark.range(math.ceil(tasks * (math.log(tasks + 1) + 12)))
    task = F.pmod(F.hash("id"), F.lit(tasks)).alias("task")
    return numbers.groupBy(task).agg(F.min("id").alias("key"))


def _keyed(df: DataFrame, tasks: int, keys: DataFrame | None) -> DataFrame:
    """``df`` with ``key``, by which block ``block`` gets a task of its own, or shares it evenly."""
    if keys is None:
        return df.withColumn("key", F.col("block"))
    # At most MAX_TASKS rows.
    joined = df.join(F.broadcast(keys), F.pmod("block", F.lit(tasks)) == F.col("task"), "left")
    return joined.withColumn("key", F.coalesce("key", -1 - F.col("block"))).drop("task")


def _block_product(users: DataFrame, items: DataFrame, blocks: int, kernel, schema) -> DataFrame:
    """Cogroup both sides by ``block``, each block in a task of its own as far as there are tasks."""
    tasks = min(max(blocks, 1), MAX_TASKS)
    # With many blocks per task the hash alone spreads them well enough.
    keys = _task_keys(users.sparkSession, tasks) if blocks <= MAX_TASKS else None
    users, items = (_keyed(side, tasks, keys).repartition(tasks, "key") for side in (users, items))
    return users.groupBy("key").cogroup(items.groupBy("key")).applyInArrow(kernel, schema)


def top_n_from_factors(
    user_factors: DataFrame,
    item_factors: DataFrame,
    n: int,
    seen: DataFrame | None = None,
    users_per_cell: int | None = None,
    items_per_slice: int | None = None,
    pairs_per_block: int = BLOCK_PAIRS,
    rejects: str = "fail",
) -> DataFrame:
    """The ``n`` best items of each user by dot product: ``RECOMMENDATIONS`` rows.

    A block matrix product on an equi-join: users are hashed into cells, items
    into slices, and each (cell, slice) block is multiplied with NumPy in one
    task, which returns at most ``n`` rows per user, or as many as the user's
    ``depth`` says where ``user_factors`` has that column. Vectors of a block
    take ``BLOCK_BYTES`` on each side at most, unless the limits are given;
    nothing is broadcast but one row per task, and no pair is ever a row. Equal
    scores rank by item id.

    Pairs in ``seen (user_idx, item_idx)`` are left out before ranking. A cell
    with more than ``pairs_per_block`` of them in one slice is divided by users,
    so a block holds about that many, or one user's pairs with one slice.

    Vectors that are null, not finite or of another length stop the call with
    their count; ``rejects="skip"`` leaves them out, and ``rejected_factors``
    lists them.
    """
    if n < 1:
        raise ValueError("n must be positive")
    depth, rows = F.lit(n), n
    if "depth" in user_factors.columns:
        depth = F.col("depth").cast("int")
        # Cells are hashed, so shallow and deep users mix; every vector goes to all cells of the other side.
        rows = max(user_factors.agg(F.avg(F.least(depth, F.lit(n)))).first()[0] or n, 1)
    user_factors, item_factors, grid = _checked(user_factors, item_factors, rejects, users_per_cell, items_per_slice, rows)
    users = user_factors.select("id", F.lit(None).cast("int").alias("item"), "features", depth.alias("depth"), grid.cell("id"))
    users = users.withColumn("slice", _numbers(grid.slices))
    # Own names on each side: both may come from one table.
    items = item_factors.select(
        F.col("id").alias("item_id"), F.col("features").alias("vector"), grid.slice("id")
    ).withColumn("cell", _numbers(grid.cells))

    blocks = grid.cells * grid.slices
    block = F.col("cell").cast("long") * grid.slices + F.col("slice")
    if seen is not None:
        # A pair may come twice; it counts twice here and is left out once.
        pairs = seen.select(F.col("user_idx").alias("id"), F.col("item_idx").alias("item")).select(
            "id", "item", grid.cell("id"), grid.slice("item")
        )
        no_vector = F.lit(None).cast(user_factors.schema["features"].dataType).alias("features")
        users = users.unionByName(
            pairs.select("id", "item", no_vector, F.lit(None).cast("int").alias("depth"), "cell", "slice")
        )
        per_block = pairs.groupBy("cell", "slice").agg(F.count("*").alias("n"))
        crowded = per_block.groupBy("cell").agg(F.max("n").alias("n")).filter(F.col("n") > pairs_per_block)
        # Fewer cells than there are times pairs_per_block pairs. Their first part keeps its block, the others follow
        # behind the last one, so that no number is without rows.
        parts = F.ceil(F.col("n") / pairs_per_block).cast("int")
        before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        crowded = crowded.select("cell", parts.alias("parts"))
        crowded = durable(
            crowded.withColumn("ahead", F.coalesce(F.sum(F.col("parts") - 1).over(before), F.lit(0))), "crowded-cells"
        )
        more = crowded.agg(F.sum(F.col("parts") - 1)).first()[0] or 0
        if more:
            divided = F.coalesce("parts", F.lit(1))
            users = users.join(crowded, "cell", "left").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), divided))
            items = items.join(crowded, "cell", "left").withColumn("part", _numbers(divided))
            behind = F.lit(blocks) + (F.col("ahead") + F.col("part") - 1) * grid.slices + F.col("slice")
            block = F.when(F.col("part") == 0, block).otherwise(behind)
            blocks += more * grid.slices
    left = users.select("id", "item", "features", "depth", block.alias("block"))
    right = items.select("item_id", "vector", block.alias("block"))
    best = _block_product(left, right, blocks, _top_kernel(n), schemas.RECOMMENDATIONS)
    if grid.slices == 1:
        return best
    ranked = rank_top_n(best.drop("rank"), n)
    if "depth" not in user_factors.columns:
        return ranked
    # Each slice gave a user as many rows as asked for; what the merge adds beyond goes.
    depths = user_factors.select(F.col("id").alias("user_idx"), "depth")
    return ranked.join(depths, "user_idx").filter(F.col("rank") <= F.col("depth")).drop("depth")


def _norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


@dataclass(frozen=True)
class Pruned:
    """Lists of ``top_n_pruned``, and per user how many of the slices were multiplied."""

    recommendations: DataFrame
    visited: DataFrame
    slices: int


def top_n_pruned(
    user_factors: DataFrame,
    item_factors: DataFrame,
    n: int,
    seen: DataFrame | None = None,
    items_per_slice: int | None = None,
    rejects: str = "fail",
) -> Pruned:
    """The rows of ``top_n_from_factors``, without the products that cannot reach a list.

    Items lie in slices in descending order of their norm. Every user meets the
    first slice. No score in a later one exceeds the user's norm times the largest
    norm there (Cauchy and Schwarz), so a slice whose bound is below the user's
    n-th score so far is skipped, and all behind it. With one slice nothing can be
    skipped; where norms differ much, as those of items of very different
    popularity do, most slices are. ``visited (user_idx, slices)`` tells for every
    user how many were not. Null and bad vectors, ties, ``seen`` and empty tables
    are treated as in ``top_n_from_factors``.
    """
    user_factors, item_factors, grid = _checked(user_factors, item_factors, rejects, None, items_per_slice)
    users = durable(user_factors.select("id", "features", _norm("features").alias("norm")), "user-norms")
    order = [F.col("norm").desc(), F.col("id")]
    items = item_factors.select("id", "features", _norm("features").alias("norm"))
    if grid.slices > 1:
        items = items.repartitionByRange(grid.slices, *order).withColumn("slice", F.spark_partition_id())
    else:
        items = items.withColumn("slice", F.lit(0))
    items = durable(items, "item-slices", partition_by="slice")

    def best(some_users: DataFrame, slices: Column) -> DataFrame:
        chosen = items.filter(slices).select("id", "features")
        return top_n_from_factors(some_users.select("id", "features"), chosen, n, seen, items_per_slice=items_per_slice)

    # The first slice of a range partitioning may be empty of a small table; the first filled one counts.
    tops = {r["slice"]: r["norm"] for r in items.groupBy("slice").agg(F.max("norm").alias("norm")).collect()}
    filled = sorted(tops)
    if len(filled) < 2:
        return Pruned(best(users, F.lit(True)), users.select(F.col("id").alias("user_idx"), F.lit(len(filled)).alias("slices")), len(filled))
    found = durable(best(users, F.col("slice") == filled[0]), "first-slice")
    floors = found.filter(F.col("rank") == n).select(F.col("user_idx").alias("floor_id"), F.col("score").alias("floor"))
    # One number per slice of 64 MB of vectors; a margin covers the rounding of norms and products.
    bounds = F.array(*[F.lit(tops[s] * (1 + 1e-9)) for s in filled[1:]])
    reached = F.size(F.filter(bounds, lambda top: F.col("floor").isNull() | (top * F.col("norm") >= F.col("floor"))))
    users = durable(
        users.join(floors, F.col("id") == F.col("floor_id"), "left").select("id", "features", reached.alias("reached")),
        "reached-slices",
    )
    rest = _sliced_product(users, items, filled, n, seen, grid)
    lists = found.select("user_idx", "item_idx", "score").union(rest.select("user_idx", "item_idx", "score"))
    visited = users.select(F.col("id").alias("user_idx"), (F.col("reached") + 1).alias("slices"))
    return Pruned(rank_top_n(lists, n).select("user_idx", "item_idx", "score", "rank"), visited, len(filled))


def _sliced_product(
    users: DataFrame, items: DataFrame, filled: list[int], n: int, seen: DataFrame | None, grid: _Grid
) -> DataFrame:
    """Best items of each user in the ``reached`` slices behind the first, slice by slice."""
    place = F.array_position(F.array(*map(F.lit, filled)), F.col("slice")).cast("int") - 1
    cells = max(grid.cells, math.ceil(2 * grid.cores / len(filled)))
    cell = F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int")
    block = F.col("cell").cast("long") * len(filled) + F.col("slice")
    left = users.filter("reached > 0").select(
        "id", F.lit(None).cast("int").alias("item"), "features", F.lit(n).alias("depth"), cell.alias("cell"),
        F.explode(F.sequence(F.lit(1), "reached")).alias("slice"),
    )
    items = items.select("id", "features", place.alias("slice")).filter("slice > 0")
    if seen is not None:
        where = items.select(F.col("id").alias("item"), "slice")
        pairs = seen.select(F.col("user_idx").alias("id"), F.col("item_idx").alias("item")).join(where, "item")
        nothing = F.lit(None).cast(users.schema["features"].dataType).alias("features")
        left = left.unionByName(
            pairs.select("id", "item", nothing, F.lit(None).cast("int").alias("depth"), cell.alias("cell"), "slice")
        )
    left = left.select("id", "item", "features", "depth", block.alias("block"))
    right = items.select(
        F.col("id").alias("item_id"), F.col("features").alias("vector"), "slice", _numbers(cells).alias("cell")
    ).select("item_id", "vector", block.alias("block"))
    return _block_product(left, right, cells * len(filled), _top_kernel(n), schemas.RECOMMENDATIONS)


def score_pairs(
    rows: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    pairs_per_block: int = BLOCK_PAIRS,
    rejects: str = "fail",
) -> DataFrame:
    """``rows (user_idx, item_idx, ...)`` with ``prediction``, the dot product of their vectors.

    The block product again, with rows instead of all pairs: a row moves once and
    without vectors, a vector once per block of the other side. A block with more
    than ``pairs_per_block`` rows is divided by a hash of the row, whatever user
    or item is behind it. Rows of unknown users or items are dropped.
    """
    user_factors, item_factors, grid = _checked(user_factors, item_factors, rejects, None, None)
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    placed = rows.filter(F.col("user_idx").isNotNull() & F.col("item_idx").isNotNull()).select(
        F.col("user_idx").alias("id"),
        F.col("item_idx").alias("item"),
        row.alias("row"),
        F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("spread"),
        grid.cell("user_idx"),
        grid.slice("item_idx"),
    )
    crowded = placed.groupBy("cell", "slice").agg(F.count("*").alias("n"))
    parts = crowded.select("cell", "slice", F.ceil(F.col("n") / pairs_per_block).cast("int").alias("parts"))
    plain = F.col("cell").cast("long") * grid.slices + F.col("slice")
    # Further parts of a crowded block are numbered behind all blocks. There are fewer than the rows
    # make times pairs_per_block, so rows meet a small table and move only once.
    before = Window.orderBy("cell", "slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum(F.col("parts") - 1).over(before), F.lit(0)).alias("ahead")
    parts = durable(parts, "row-blocks")
    split = durable(parts.filter("parts > 1").select("cell", "slice", "parts", ahead), "row-blocks")
    more = split.agg(F.sum(F.col("parts") - 1)).first()[0] or 0
    blocks = grid.cells * grid.slices + more
    behind = F.lit(grid.cells * grid.slices) + F.col("ahead") + F.col("part") - 1
    block = F.when(F.col("part") == 0, plain).otherwise(behind)
    # Blocks without rows are absent here, so no vector is sent to them.
    parts = parts.join(split.drop("parts"), ["cell", "slice"], "left")
    users = user_factors.select("id", "features", grid.cell("id")).join(parts, "cell")
    users = users.withColumn("part", _numbers(F.col("parts")))
    items = item_factors.select(F.col("id").alias("item_id"), F.col("features").alias("vector"), grid.slice("id"))
    items = items.join(parts, "slice").withColumn("part", _numbers(F.col("parts")))
    if more:
        placed = placed.join(split, ["cell", "slice"], "left")
        placed = placed.withColumn("part", F.pmod("spread", F.coalesce("parts", F.lit(1))))
    else:
        placed = placed.withColumn("part", F.lit(0)).withColumn("ahead", F.lit(0))
    left = placed.select(
        "id", "item", "row", F.lit(None).cast(user_factors.schema["features"].dataType).alias("features"),
        block.alias("block"),
    ).unionByName(
        users.select(
            "id", F.lit(None).cast("int").alias("item"), F.lit(None).cast(placed.schema["row"].dataType).alias("row"),
            "features", block.alias("block"),
        )
    )
    right = items.select("item_id", "vector", block.alias("block"))
    schema = T.StructType(rows.schema.fields + [T.StructField("prediction", T.FloatType())])
    return _block_product(left, right, blocks, _score_kernel(rows.columns), schema)


def rank_top_n(scores: DataFrame, n: int) -> DataFrame:
    """Rank scored ``(user_idx, item_idx, score)`` rows and keep ``n`` per user."""
    order = Window.partitionBy("user_idx").orderBy(F.desc("score"), "item_idx")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _box_search(n: int):
    """Candidates of the best lists from a tree of boxes over a block's items, in place of all products.

    Items lie in k-d order in leaves of equal size, and every node has the least
    box around its items. No score inside exceeds that of the box's best corner. A
    user's floor is the last score of a list from some promising leaves; nodes
    below it are left out with all their items. A user to whom boxes say little
    is given back, for the whole product.
    """
    # A closure, so tasks get it by value and need no copy of this package.
    leaf_size, fan_bits, hard_share, floats = LEAF, FAN_BITS, HARD_SHARE, CHUNK_FLOATS

    def build(items):
        import numpy as np

        size, rank = items.shape
        height = max(size // leaf_size, 1).bit_length() - 1
        width = -(-size // (1 << height))
        # The last item fills up the leaves; its copies are known by their position.
        slot = np.arange(width << height, dtype=np.int32)
        columns = items[np.minimum(slot, size - 1)].T.copy()
        for level in range(height):
            slot, columns = slot.reshape(1 << level, -1), columns.reshape(rank, 1 << level, -1)
            widest = np.argmax(columns.max(axis=2) - columns.min(axis=2), axis=0)
            values = columns[widest, np.arange(1 << level)]
            halves = np.argpartition(values, slot.shape[1] // 2, axis=1)
            slot = np.take_along_axis(slot, halves, axis=1)
            for column in columns:
                column[:] = np.take_along_axis(column, halves, axis=1)
        slot = slot.reshape(1 << height, width)
        order, real = np.minimum(slot, size - 1), slot < size
        leaves = np.ascontiguousarray(columns.reshape(rank, 1 << height, width).transpose(1, 2, 0))
        columns = columns.reshape(rank, 1 << height, width)
        boxes = np.concatenate([columns.max(axis=2).T, columns.min(axis=2).T], axis=1)
        # From the leaves up; each level holds a node's children in one row.
        fan = 1 << min(fan_bits, height)
        levels = []
        while len(boxes) > 8 * fan:
            grouped = boxes.reshape(-1, fan, 2 * rank)
            levels.append(grouped)
            boxes = np.concatenate([grouped[:, :, :rank].max(axis=1), grouped[:, :, rank:].min(axis=1)], axis=1)
        place = np.empty(size, dtype=np.int64)
        place[order[real]] = np.flatnonzero(real)
        return boxes, levels[::-1], leaves, order, real, place

    def search(tree, users, error, margin, depths, pair_user, pair_item):
        """``user, item`` candidates and the users given back, of some users; pairs are sorted by user."""
        import numpy as np

        top, levels, leaves, order, real, place = tree
        width, size = order.shape[1], len(place)
        corners = np.concatenate([np.maximum(users, 0), np.minimum(users, 0)], axis=1)
        beam = -(-2 * min(n, size) // width) + 3

        def best(bounds):
            return np.argpartition(bounds, bounds.shape[1] - beam, axis=1)[:, -beam:] if bounds.shape[1] > beam else None

        bounds = corners @ top.T
        chosen = best(bounds)
        nodes = np.broadcast_to(np.arange(len(top)), bounds.shape) if chosen is None else chosen
        for boxes in levels:
            fan = boxes.shape[1]
            inner = np.einsum("ud,ukfd->ukf", corners, boxes[nodes], optimize=False).reshape(len(users), -1)
            nodes = (nodes[:, :, None] * fan + np.arange(fan)).reshape(len(users), -1)
            chosen = best(inner)
            nodes = nodes if chosen is None else np.take_along_axis(nodes, chosen, axis=1)
        scores = np.einsum("ud,ukwd->ukw", users, leaves[nodes], optimize=False)
        scores[~real[nodes]] = -np.inf
        for start in range(0, len(pair_user), 100_000):
            rows = pair_user[start : start + 100_000]
            leaf, inner = np.divmod(place[pair_item[start : start + 100_000]], width)
            at, column = np.nonzero(nodes[rows] == leaf[:, None])
            scores[rows[at], column, inner[at]] = -np.inf
        scores = np.sort(scores.reshape(len(users), -1), axis=1)
        wanted = np.clip(np.nan_to_num(np.minimum(depths, n)), 1, size).astype(np.int64)
        # A list that the chosen leaves do not fill has no floor.
        floor = np.where(wanted <= scores.shape[1], scores[np.arange(len(users)), -np.minimum(wanted, scores.shape[1])], -np.inf)
        hard = ~np.isfinite(floor)
        floor = np.where(hard, np.inf, floor).astype(np.float64)
        inside, limit = floor - error - margin, floor - 2 * error
        seen = pair_user * order.size + place[pair_item]
        seen.sort()

        found_user, found_item = [], []
        user, node = np.nonzero(bounds >= inside[:, None])
        waiting = [(0, user, node)]
        while waiting:
            level, user, node = waiting.pop()
            last = level == len(levels)
            fan = width if last else levels[level].shape[1]
            # A user that reaches much of the block costs less in the whole product.
            crowd = np.bincount(user, minlength=len(users)) * fan > hard_share * size
            if crowd.any():
                hard |= crowd
            left = ~hard[user]
            user, node = user[left], node[left]
            if len(user) == 0:
                continue
            if len(user) * fan * corners.shape[1] > floats and user[0] != user[-1]:
                middle = np.searchsorted(user, user[len(user) // 2])
                middle = middle or np.searchsorted(user, user[0], "right")
                waiting += [(level, user[middle:], node[middle:]), (level, user[:middle], node[:middle])]
            elif last:
                inner = np.einsum("pd,pwd->pw", users[user], leaves[node], optimize=False)
                at, column = np.nonzero((inner >= limit[user][:, None]) & real[node])
                found_user.append(user[at])
                found_item.append(node[at] * width + column)
            else:
                inner = np.einsum("pd,pfd->pf", corners[user], levels[level][node], optimize=False)
                at, column = np.nonzero(inner >= inside[user][:, None])
                waiting.append((level + 1, user[at], node[at] * fan + column))
        user = np.concatenate(found_user or [np.empty(0, dtype=np.int64)])
        item = np.concatenate(found_item or [np.empty(0, dtype=np.int64)])
        keep = ~hard[user]
        if len(seen):
            keys = user * order.size + item
            keep &= seen[np.minimum(np.searchsorted(seen, keys), len(seen) - 1)] != keys
        return user[keep], order.reshape(-1)[item[keep]], hard

    return build, search


def _top_kernel(n: int):
    # A closure, so tasks get it by value and need no copy of this package.
    build, search = _box_search(n)
    tree_from, floats = TREE_FROM, CHUNK_FLOATS

    def kernel(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def vectors(table, key, vector):
            table = table.sort_by(key)
            flat = table[vector].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ids = table[key].to_numpy()
            # No copy where the values are already doubles: the sorted table is the only one.
            return ids, flat.astype(np.float64, copy=False).reshape(len(ids), -1)

        def positions(ids, wanted):
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            return at, ids[at] == wanted

        def emit(parts):
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.array([])] * 4
            types = (pa.int32(), pa.int32(), pa.float64(), pa.int32())
            names = ("user_idx", "item_idx", "score", "rank")
            return pa.table({m: pa.array(c.astype(t.to_pandas_dtype()), t) for m, c, t in zip(names, columns, types)})

        wanted = left.filter(pc.is_null(left["item"]))
        if wanted.num_rows == 0 or right.num_rows == 0:
            return emit([])
        user_ids, users = vectors(wanted, "id", "features")
        item_ids, items = vectors(right, "item_id", "vector")
        depths = wanted.sort_by("id")["depth"].to_numpy()

        pairs = left.filter(pc.is_valid(left["item"]))
        pair_user, known_user = positions(user_ids, pairs["id"].to_numpy())
        pair_item, known_item = positions(item_ids, pairs["item"].to_numpy())
        del pairs, wanted
        known = known_user & known_item
        del known_user, known_item
        pair_user, pair_item = pair_user[known], pair_item[known]
        by_user = np.argsort(pair_user, kind="stable")
        pair_user, pair_item = pair_user[by_user], pair_item[by_user]

        size, rank = items.shape
        keep = min(n, size)
        lengths, longest = np.linalg.norm(users, axis=1), np.linalg.norm(items, axis=1).max()
        # Single precision finds the candidates unless products could overflow.
        kind = np.float32 if lengths.max() * longest < 1e30 else np.float64
        rough_users, rough_items = users.astype(kind), items.astype(kind).T
        # No rough score is further than this from the true one, no bound of a box further than the margin.
        error = (rank + 4) * np.finfo(kind).eps * lengths * longest + np.finfo(kind).tiny
        margin = 2 * np.sqrt(rank) * error

        def product(chosen):
            """Candidates of the users at ``chosen`` (ascending) from all products."""
            step = max(1, 4_000_000 // size)
            for start in range(0, len(chosen), step):
                rows = chosen[start : start + step]
                rough = rough_users[rows] @ rough_items
                first, end = np.searchsorted(pair_user, rows), np.searchsorted(pair_user, rows, "right")
                counts = end - first
                at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                rough[np.repeat(np.arange(len(rows)), counts), pair_item[at]] = -np.inf
                # Each of the best n is at most two errors below the n-th rough score.
                last = np.partition(rough, size - keep, axis=1)[:, size - keep]
                limit = np.nextafter((last - 2 * error[rows]).astype(kind), -np.inf, dtype=kind)
                limit = np.maximum(limit, np.finfo(kind).min)
                u, i = np.divmod(np.flatnonzero(rough >= limit[:, None]), size)
                yield rows[u], i

        def ranked(u, i):
            # True scores, summed alike for equal vectors, give the order.
            score = np.empty(len(u))
            for a in range(0, len(u), 100_000):
                b = slice(a, a + 100_000)
                score[b] = (users[u[b]] * items[i[b]]).sum(axis=1)
            order = np.lexsort((i, -score, u))
            u, i, score = u[order], i[order], score[order]
            rank = np.arange(len(u)) - np.searchsorted(u, u) + 1
            top = rank <= np.minimum(n, depths[u])
            return user_ids[u[top]], item_ids[i[top]], score[top], rank[top]

        out, given_back = [], []
        begin = 0
        if size >= tree_from and kind is np.float32 and max(longest, lengths.max()) < 1e30:
            tree = build(rough_items.T)
            some = max(1, min(2048, floats // (rank * (2 * keep + 6 * tree[3].shape[1]))))
            while begin < len(user_ids):
                part = slice(begin, begin + some)
                a, b = np.searchsorted(pair_user, (begin, begin + some))
                u, i, hard = search(
                    tree, rough_users[part], error[part], margin[part], depths[part], pair_user[a:b] - begin, pair_item[a:b]
                )
                out.append(ranked(u + begin, i))
                given_back.append(np.flatnonzero(hard) + begin)
                begin += len(hard)
                if sum(map(len, given_back)) > begin // 2:
                    # Boxes do not help with these vectors.
                    break
        given_back.append(np.arange(begin, len(user_ids)))
        out += [ranked(u, i) for u, i in product(np.concatenate(given_back))]
        return emit(out)

    return kernel


def _score_kernel(columns: list[str]):
    # A closure, as above.
    def kernel(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def vectors(table, key, vector):
            table = table.sort_by(key)
            flat = table[vector].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ids = table[key].to_numpy()
            return ids, flat.astype(np.float64).reshape(len(ids), -1)

        def positions(ids, wanted):
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            return at, ids[at] == wanted

        has_row = pc.is_valid(left["item"])
        rows, known_users = left.filter(has_row), left.filter(pc.invert(has_row))
        if rows.num_rows == 0 or known_users.num_rows == 0 or right.num_rows == 0:
            rows, prediction = rows.slice(0, 0), np.empty(0, dtype=np.float32)
        else:
            user_ids, users = vectors(known_users, "id", "features")
            item_ids, items = vectors(right, "item_id", "vector")
            user, known_user = positions(user_ids, rows["id"].to_numpy())
            item, known_item = positions(item_ids, rows["item"].to_numpy())
            known = known_user & known_item
            rows, user, item = rows.filter(pa.array(known)), user[known], item[known]
            prediction = np.empty(len(user), dtype=np.float32)
            for start in range(0, len(user), 100_000):
                part = slice(start, start + 100_000)
                prediction[part] = (users[user[part]] * items[item[part]]).sum(axis=1)
        fields = rows["row"].combine_chunks().flatten()
        return pa.table(dict(zip(columns, fields)) | {"prediction": pa.array(prediction, pa.float32())})

    return kernel


def title_map(item_index: DataFrame, movies: DataFrame) -> DataFrame:
    """``(item_idx, movieId, title)`` from ``item_index (movieId, item_idx)``; the title is null without a movie row."""
    return item_index.join(movies.select("movieId", "title"), "movieId", "left").select(
        "item_idx", "movieId", "title"
    )


def with_titles(recs: DataFrame, titles: DataFrame) -> DataFrame:
    """Recommendations with ``movieId`` and ``title``, null where unknown.

    A popular item may fill a large share of all slots, so titles are first
    matched to the distinct items and then joined with hot items split.
    """
    recs = durable(recs, "recs")
    slots = recs.groupBy("item_idx").agg(F.count("*").alias("n"))
    per_item = durable(slots.join(titles, "item_idx", "left"), "titles")
    return split_join(recs, per_item, "item_idx", hot_limit(per_item))


def recommend(
    requests: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    titles: DataFrame | None = None,
    n: int = 10,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Answer every request ``(user_id[, num_recommendations])`` in one job.

    Long output: ``user_id, status, rank, item_idx, predicted_rating[, movieId,
    title]``. An unknown user gives one row with status ``user_not_found`` and a
    request outside 1..100 one row with ``invalid_request``; all else is
    ``success``. Without its own number a request gets ``n`` items.
    """
    low, high = schemas.MIN_REQUEST, schemas.MAX_REQUEST
    if not low <= n <= high:
        raise ValueError(f"n must be between {low} and {high}")
    per_request = "num_recommendations" in requests.columns
    asked = F.col("num_recommendations") if per_request else F.lit(n)
    # Kept as wide as they come: a number or an id beyond 32 bits is a wrong request, not an error.
    requests = requests.withColumn("num_recommendations", F.coalesce(asked, F.lit(n)).cast("long"))

    # Each user is scored once, however often it is asked for, and only as deep
    # as the longest list asked for.
    valid = F.col("num_recommendations").between(low, high)
    wanted = durable(
        requests.groupBy(F.col("user_id").alias("id")).agg(
            F.count("*").alias("n"), F.max(F.when(valid, F.col("num_recommendations"))).alias("most")
        ),
        "wanted",
    )
    depth = wanted.agg(F.max("most")).first()[0] or low
    # In a join the factors' 32-bit id widens to that of the requests.
    deepest = wanted.filter("most is not null").select("id", F.col("most").cast("int").alias("depth"))
    known = durable(user_factors.join(deepest, "id").select(*user_factors.columns, "depth"), "wanted-factors")
    known = known.withColumn("id", F.col("id").cast("int"))
    top = top_n_from_factors(known, item_factors, depth, seen)
    if titles is not None:
        top = with_titles(top, titles)
    top = top.withColumn("predicted_rating", clamp_rating(F.col("score")))
    slot = ["rank", "item_idx", "predicted_rating"] + ([] if titles is None else ["movieId", "title"])
    # At most 100 slots per user.
    lists = top.groupBy(F.col("user_idx").alias("id")).agg(F.collect_list(F.struct(*slot)).alias("slots"))
    answers = durable(
        wanted.join(user_factors.select("id", F.lit(True).alias("known")), "id", "left")
        .join(lists, "id", "left")
        .select(F.col("id").alias("user_id"), "n", "known", "slots"),
        "answers",
    )
    status = (
        F.when(~valid, "invalid_request").when(F.col("known").isNull(), "user_not_found").otherwise("success")
    )
    mine = F.when(valid, F.filter("slots", lambda s: s["rank"] <= F.col("num_recommendations")))
    answered = (
        split_join(requests, answers, "user_id", hot_limit(answers))
        .select("user_id", status.alias("status"), F.explode_outer(mine).alias("slot"))
        .select("user_id", "status", "slot.*")
    )
    # A request without a user meets no row in the join.
    nobody = requests.filter(F.col("user_id").isNull()).withColumn("known", F.lit(None))
    return answered.unionByName(nobody.select("user_id", status.alias("status")), allowMissingColumns=True)


def batch_status(requests: DataFrame, user_factors: DataFrame) -> DataFrame:
    """Status of every distinct requested user without scoring anything."""
    users = requests.select("user_id").distinct()
    known = user_factors.select(F.col("id").alias("user_id"), F.lit(True).alias("known"))
    status = F.when(F.col("known").isNull(), "user_not_found").otherwise("success")
    return users.join(known, "user_id", "left").select("user_id", status.alias("status"))
