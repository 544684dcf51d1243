"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is dealt into about sqrt(n) / 4 blocks of about 4 sqrt(n) documents by a
hash of the id. What a source must give is a whole number of block copies and a
part of one boundary block. A tree over the output shards splits these exact
quotas: each node deals its blocks to two children by a multivariate
hypergeometric draw, so every shard ends with an exact number of blocks per
source. The blocks of a source, in permuted order, then fill the slots of the
shards one after the other, and rows are shuffled inside their shard.

Only the size of a document and its place take part, all in DataFrame functions;
random numbers are hashes of (seed, what is drawn), so reruns agree.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.words import word_array
from ratingloom.session import durable

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
# Words of one output shard.
SHARD_WORDS = 4_000_000
SEED = 7
# Rounds in which a boundary block fills what a source still lacks.
FILL_TURNS = 4


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Words that each source of ``sizes(source, size)`` shall give: ``source, n, source_size, target``.

    Sources in order of code points, null last, take ``weights`` in turn and share
    ``share`` times all words; a target stops at ``MOST_REPEATS`` times the source
    and the excess is shared again. That is a level: target = min(cap, level *
    weight), found from running sums over the sources in order of cap / weight.
    The windows run over one row per source.
    """
    total = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    table = total.withColumn("weight", weight).withColumn(
        "cap", (MOST_REPEATS * F.col("source_size")).cast("double")
    )
    order = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    table = table.withColumn("level", left / F.sum("weight").over(after)).withColumn(
        "nth", F.row_number().over(order)
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))
    level = F.min(fits).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return table.select("source", "n", "source_size", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of ``parts``."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


@dataclass(frozen=True)
class Mixture:
    """Decisions of a mix: sources with targets, block copies with shards, documents of boundary blocks."""

    sources: DataFrame
    copies: DataFrame
    boundary: DataFrame
    seed: int

    def of(self, docs: DataFrame, source: Column, doc_id: Column) -> DataFrame:
        """``docs`` with ``_source_size, _target`` and ``_places``, an array of (shard, order), one per copy taken."""
        s = self.sources.select(
            F.col("source").alias("_s"),
            F.col("n_blocks").alias("_n_blocks"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
        )
        c = self.copies.select(
            F.col("source").alias("_cs"), F.col("block").alias("_cb"), F.col("copies").alias("_copies")
        )
        b = self.boundary.select(
            F.col("source").alias("_bs"), F.col("doc_id").alias("_bd"), F.lit(True).alias("_inside")
        )
        placed = (
            docs.join(s, source.eqNullSafe(F.col("_s")), "left")
            .withColumn("_block", _block(doc_id, F.col("_n_blocks"), self.seed))
            .join(c, source.eqNullSafe(F.col("_cs")) & (F.col("_block") == F.col("_cb")), "left")
            .join(b, source.eqNullSafe(F.col("_bs")) & doc_id.eqNullSafe(F.col("_bd")), "left")
        )
        whole = F.filter(F.coalesce("_copies", F.array()), lambda x: x["whole"] | F.coalesce(F.col("_inside"), F.lit(False)))
        order = F.transform(
            whole,
            lambda x: F.struct(
                x["shard"].alias("shard"), F.xxhash64(doc_id, x["copy"], x["shard"], F.lit(self.seed)).alias("order")
            ),
        )
        return placed.withColumn("_places", order).drop(
            "_s", "_n_blocks", "_block", "_cs", "_cb", "_copies", "_bs", "_bd", "_inside"
        )


def _block(doc_id: Column, n_blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), n_blocks)


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """Exact quotas ``(source, quota)`` dealt to shards: ``shard, source, quota``.

    One row per tree node with the quotas of all sources. A node of m shards
    gives the left child floor(m/2) of them and that share of its blocks. Item j
    of a source with k of the N blocks left goes left with probability
    (draws left) / (blocks left): the sequential form of the hypergeometric draw.
    """
    entry = F.struct(F.col("source"), F.col("quota"))
    nodes = quotas.agg(F.sort_array(F.collect_list(entry)).alias("q")).select(
        F.lit(0).alias("first"), F.lit(n_shards).alias("width"), "q"
    )

    def number(text: str) -> Column:
        return F.lit(0).cast("long").alias(text)

    for _ in range(max(n_shards - 1, 0).bit_length()):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda acc, x: acc + x["quota"])
        half = F.floor(F.col("width") / 2)
        draws = F.when(F.col("width") > 1, F.floor(total * half / F.col("width"))).otherwise(total)

        def deal(acc: Column, x: Column) -> Column:
            def one(got: Column, j: Column) -> Column:
                u = _uniform(F.lit(seed), F.col("first"), F.col("width"), x["source"], j)
                return got + (u * (acc["blocks"] - j + 1) < acc["draws"] - got).cast("long")

            got = F.aggregate(
                F.when(x["quota"] > 0, F.sequence(F.lit(1).cast("long"), x["quota"])).otherwise(
                    F.array().cast("array<bigint>")
                ),
                F.lit(0).cast("long"),
                one,
            )
            return F.struct(
                (acc["draws"] - got).alias("draws"),
                (acc["blocks"] - x["quota"]).alias("blocks"),
                F.concat(acc["left"], F.array(got)).alias("left"),
            )

        start = F.struct(
            draws.cast("long").alias("draws"),
            total.alias("blocks"),
            F.array().cast("array<bigint>").alias("left"),
        )
        dealt = nodes.withColumn("left", F.aggregate("q", start, deal, lambda acc: acc["left"]))
        left = F.transform("q", lambda x, i: F.struct(x["source"].alias("source"), F.get("left", i).alias("quota")))
        right = F.transform(
            "q", lambda x, i: F.struct(x["source"].alias("source"), (x["quota"] - F.get("left", i)).alias("quota"))
        )
        children = F.when(
            F.col("width") > 1,
            F.array(
                F.struct(F.col("first").alias("first"), half.cast("int").alias("width"), left.alias("q")),
                F.struct(
                    (F.col("first") + half).cast("int").alias("first"),
                    (F.col("width") - half).cast("int").alias("width"),
                    right.alias("q"),
                ),
            ),
        ).otherwise(F.array(F.struct("first", "width", "q")))
        nodes = dealt.select(F.explode(children).alias("child")).select("child.*")
    leaves = nodes.select(F.col("first").alias("shard"), F.explode("q").alias("x"))
    return leaves.select("shard", "x.source", "x.quota")


def _fill(rows: DataFrame, seed: int) -> DataFrame:
    """The rows of each source's boundary block that come near its ``left`` words.

    First the rows in permuted order up to the first that does not fit, then,
    largest first, rows that fit into what is still left; at the end one more
    row if that comes nearer.
    """
    group = Window.partitionBy("source")
    rows = rows.withColumn("taken", F.lit(False))
    for turn in range(FILL_TURNS):
        fits = ~F.col("taken") & (F.col("size") <= F.col("left"))
        order = [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")]
        if turn:
            order.insert(0, F.col("size").desc())
        else:
            fits = ~F.col("taken")
        running = F.sum(F.when(fits, F.col("size")).otherwise(0)).over(group.orderBy(*order))
        rows = rows.withColumn("now", fits & (running <= F.col("left"))).withColumn("taken", F.col("taken") | F.col("now"))
        rows = rows.withColumn(
            "left", F.col("left") - F.sum(F.when(F.col("now"), F.col("size")).otherwise(0)).over(group)
        )
    # One more row where it brings the total nearer than it is.
    nearer = ~F.col("taken") & (F.abs(F.col("size") - F.col("left")) < F.col("left"))
    nearest = F.min(F.when(nearer, F.struct(F.abs(F.col("size") - F.col("left")), F.col("doc_id")))).over(group)
    last = F.when(nearer, F.col("doc_id").eqNullSafe(nearest["doc_id"]))
    rows = rows.withColumn("last", F.coalesce(last, F.lit(False)))
    return rows.filter(F.col("taken") | F.col("last"))


def plan_mixture(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> tuple[Mixture, DataFrame]:
    """Decide the mix of ``documents(doc_id, text, source)``; also returns the stored ``doc_id, source, size``.

    Whole documents are taken, up to ``MOST_REPEATS`` times. The boundary block
    gives documents until what is left of the target is smaller than any that
    could follow in four rounds. Rows that repeat an id share its fate. Documents of a null
    source form a source of their own; a null or empty text has size 0.
    """
    size = F.size(word_array(F.col("text"))).cast("long")
    sizes = durable(docs.select(F.col("doc_id"), F.col("source"), size.alias("size")), "mix-sizes")
    sources = source_targets(sizes, weights, share)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    sources = durable(
        sources.withColumn("n_blocks", F.ceil(F.sqrt("n") / 4).cast("long"))
        .withColumn("full", full.cast("long"))
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")),
        "mix-sources",
    )
    keyed = sources.withColumnRenamed("source", "key")
    dealt = sizes.join(keyed.select("key", "n_blocks"), F.col("source").eqNullSafe(F.col("key")))
    dealt = dealt.withColumn("block", _block(F.col("doc_id"), F.col("n_blocks"), seed)).drop("key", "n_blocks")

    # About sqrt(n) rows per source from here on.
    blocks = dealt.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    permuted = Window.partitionBy("source").orderBy(F.xxhash64("source", "block", F.lit(seed + 1)), "block")
    running = F.sum("block_size").over(permuted)
    blocks = blocks.withColumn("before", running - F.col("block_size")).join(
        keyed.select("key", "full", "rest"), F.col("source").eqNullSafe(F.col("key"))
    )
    left = F.col("rest") - F.col("before")
    blocks = durable(
        blocks.withColumn("whole", F.col("block_size") <= left)
        .withColumn("partly", (left > 0) & (F.col("block_size") > left))
        .withColumn("left", left)
        .drop("key"),
        "mix-blocks",
    )

    copies = blocks.select(
        "source",
        "block",
        F.explode(
            F.concat(
                F.when(
                    F.col("full") > 0,
                    F.transform(
                        F.sequence(F.lit(1).cast("long"), F.col("full")),
                        lambda i: F.struct(i.alias("copy"), F.lit(True).alias("whole")),
                    ),
                ).otherwise(F.array().cast("array<struct<copy:bigint,whole:boolean>>")),
                F.when(
                    F.col("whole") | F.col("partly"),
                    F.array(F.struct((F.col("full") + 1).alias("copy"), F.col("whole").alias("whole"))),
                ).otherwise(F.array().cast("array<struct<copy:bigint,whole:boolean>>")),
            )
        ).alias("c"),
    ).select("source", "block", "c.copy", "c.whole")
    slot = Window.partitionBy("source").orderBy(
        "copy", F.xxhash64("source", "block", "copy", F.lit(seed + 2)), "block"
    )
    copies = durable(copies.withColumn("slot", F.row_number().over(slot)), "mix-copies")
    words = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    n_shards = max(round(words / shard_words), 1)
    quotas = split_quotas(copies.groupBy("source").agg(F.count("*").alias("quota")), n_shards, seed + 3)
    one_each = quotas.filter("quota > 0").select(
        "shard", F.col("source").alias("key"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("nth")
    )
    filled = one_each.select(
        "shard", "key", F.row_number().over(Window.partitionBy("key").orderBy("shard", "nth")).alias("key_slot")
    )
    placed = copies.join(
        filled, F.col("source").eqNullSafe(F.col("key")) & (F.col("slot") == F.col("key_slot"))
    )
    placed = placed.groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "whole", "shard"))).alias("copies")
    )

    cut = blocks.filter("partly").select(F.col("source").alias("key"), F.col("block").alias("key_block"), "left")
    inside = dealt.join(cut, F.col("source").eqNullSafe(F.col("key")) & (F.col("block") == F.col("key_block")))
    inside = inside.groupBy("source", "doc_id").agg(F.sum("size").alias("size"), F.first("left").alias("left"))
    inside = _fill(inside, seed + 4).select("source", "doc_id")
    return Mixture(sources, durable(placed, "mix-placed"), durable(inside, "mix-boundary"), seed), sizes


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: rows of ``docs`` once per copy taken, in shards, shuffled inside each.

    The result has one partition per shard or fewer; ``docs`` keeps its columns. A
    null source is a source of its own, a null text has size 0 and is never
    needed for a target; every repeated row is taken as often as its document; an
    empty table gives none.
    """
    mixture, _ = plan_mixture(docs.select("doc_id", "source", "text"), **options)
    # Rows ride as one column, so their names cannot meet those of the mix.
    rows = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = mixture.of(rows, rows["source"], rows["doc_id"]).select("row", F.explode("_places").alias("_place"))
    return taken.repartition(F.col("_place")["shard"]).sortWithinPartitions("_place").select("row.*")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of every document: ``doc_id, size, source_size, target, taken, shards``."""
    mixture, sizes = plan_mixture(docs.select("doc_id", "source", "text"), **options)
    taken = mixture.of(sizes, sizes["source"], sizes["doc_id"])
    return taken.select(
        "doc_id",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("size") * F.size("_places")).alias("taken"),
        F.transform("_places", lambda x: x["shard"]).alias("shards"),
    )
