"""Quality metrics on tables of predictions and recommendations.

Each metric stacks its two inputs and aggregates them by their common key, so
rows of one key are combined before the shuffle, no list per user is built and
no join meets a hot user or item. Empty input gives null metrics.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import hash_below, relative_gap, safe_ratio
from ratingloom.operators.sampling import SEED
from ratingloom.operators.skew import hot_limit, split_join
from ratingloom.schemas import RANKING_KS, RELEVANT_RATING
from ratingloom.session import durable

COLD_BELOW, WARM_FROM = 10, 50


def _error() -> Column:
    return F.col("prediction").cast("double") - F.col("rating").cast("double")


def error_metrics(predictions: DataFrame, by: str | None = None) -> DataFrame:
    """RMSE, MAE, mean and number of predictions, optionally per value of ``by``."""
    aggregates = [
        F.sqrt(F.avg(_error() * _error())).alias("rmse"),
        F.avg(F.abs(_error())).alias("mae"),
        F.avg(F.col("prediction").cast("double")).alias("avg_prediction"),
        F.count("prediction").alias("num_predictions"),
    ]
    return predictions.groupBy(by).agg(*aggregates) if by else predictions.agg(*aggregates)


def ranking_hits(
    test: DataFrame, recs: DataFrame, ks: Sequence[int] = RANKING_KS, threshold: float = RELEVANT_RATING
) -> DataFrame:
    """Per user with relevant items and recommendations: their numbers and hits.

    Columns ``n_relevant`` and, for each k, ``n_predicted_k`` and ``hits_k``. A
    pair rated twice counts twice as relevant but is one hit.
    """
    none = F.lit(None).cast("int")
    relevant = test.filter(F.col("rating") >= threshold).select(
        "user_idx", "item_idx", F.lit(1).alias("relevant"), none.alias("rank")
    )
    predicted = recs.filter(F.col("rank") <= max(ks)).select(
        "user_idx", "item_idx", F.lit(0).alias("relevant"), F.col("rank").cast("int").alias("rank")
    )
    pairs = (
        relevant.union(predicted)
        .groupBy("user_idx", "item_idx")
        .agg(F.sum("relevant").alias("relevant"), F.min("rank").alias("rank"))
    )
    per_k = []
    for k in ks:
        inside = F.col("rank") <= k
        per_k.append(F.count_if(inside).alias(f"n_predicted_{k}"))
        per_k.append(F.count_if(inside & (F.col("relevant") > 0)).alias(f"hits_{k}"))
    return (
        pairs.groupBy("user_idx")
        .agg(F.sum("relevant").alias("n_relevant"), F.count("rank").alias("n_predicted"), *per_k)
        .filter("n_relevant > 0 and n_predicted > 0")
        .drop("n_predicted")
    )


def precision_recall_at_k(
    test: DataFrame,
    recs: DataFrame,
    ks: Sequence[int] = RANKING_KS,
    threshold: float = RELEVANT_RATING,
    sample: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``(k, precision, recall)`` averaged over users, all k from one pass.

    With ``sample`` only that share of the users is measured.
    """
    if sample is not None:
        chosen = hash_below(F.col("user_idx"), sample, seed)
        test, recs = test.filter(chosen), recs.filter(chosen)
    users = ranking_hits(test, recs, ks, threshold)
    means, stacked = [], []
    for k in ks:
        hits = F.col(f"hits_{k}")
        means.append(F.avg(safe_ratio(hits, F.col(f"n_predicted_{k}"))).alias(f"p_{k}"))
        means.append(F.avg(safe_ratio(hits, F.col("n_relevant"))).alias(f"r_{k}"))
        stacked.append(f"{k}, p_{k}, r_{k}")
    return users.agg(*means).selectExpr(f"stack({len(ks)}, {', '.join(stacked)}) as (k, precision, recall)")


def nested_lists(recs: DataFrame) -> DataFrame:
    """``user_idx, recommendations``: one list per user, in order of rank, of ``item_idx``, ``score`` and what else ``recs`` has.

    Lists are as long as the ranks reach, some dozen entries, whatever the data.
    """
    slots = ["rank"] + [c for c in recs.columns if c not in ("user_idx", "rank")]
    return recs.groupBy("user_idx").agg(F.array_sort(F.collect_list(F.struct(*slots))).alias("recommendations"))


def precision_recall_nested(
    test: DataFrame, lists: DataFrame, ks: Sequence[int] = RANKING_KS, threshold: float = RELEVANT_RATING
) -> DataFrame:
    """``precision_recall_at_k`` of stored ``nested_lists``.

    Only the item ids of the lists are read. Relevant items of a user are counted,
    not collected; collected are those that are in the user's list, so no array is
    longer than a list. Users with very many ratings are dealt to several tasks.
    """
    relevant = test.filter(F.col("rating") >= threshold).select("user_idx", "item_idx")
    counts = relevant.groupBy("user_idx").agg(F.count("*").alias("n"))
    items = F.slice(F.col("recommendations")["item_idx"], 1, max(ks)).alias("items")
    users = lists.select("user_idx", items).join(counts, "user_idx").withColumn("n_relevant", F.col("n"))
    users = durable(users, "nested-users")
    found = (
        split_join(relevant, users, "user_idx", hot_limit(users))
        .filter(F.array_contains("items", F.col("item_idx")))
        .groupBy("user_idx")
        .agg(F.collect_set("item_idx").alias("found"))
    )
    users = users.join(found, "user_idx", "left")
    means, stacked = [], []
    for k in ks:
        first = F.slice("items", 1, k)
        hits = F.coalesce(F.size(F.array_intersect(first, F.col("found"))), F.lit(0))
        means.append(F.avg(safe_ratio(hits, F.size(first))).alias(f"p_{k}"))
        means.append(F.avg(safe_ratio(hits, F.col("n_relevant"))).alias(f"r_{k}"))
        stacked.append(f"{k}, p_{k}, r_{k}")
    return users.agg(*means).selectExpr(f"stack({len(ks)}, {', '.join(stacked)}) as (k, precision, recall)")


def item_exposure(train: DataFrame, recs: DataFrame, **slots: Column) -> DataFrame:
    """Per item: ``popularity`` in train and the number of recommended slots.

    Each keyword names a slot count and gives the condition on ``recs`` for it.
    """
    names = list(slots)
    zeros = [F.lit(0).cast("long").alias(name) for name in names]
    counts = [F.coalesce(cond, F.lit(False)).cast("long").alias(name) for name, cond in slots.items()]
    rated = train.select("item_idx", F.lit(1).cast("long").alias("popularity"), *zeros)
    shown = recs.select("item_idx", F.lit(0).cast("long").alias("popularity"), *counts)
    return (
        rated.union(shown)
        .groupBy("item_idx")
        .agg(F.sum("popularity").alias("popularity"), *[F.sum(name).alias(name) for name in names])
    )


def _ratio(part: Column, whole: Column) -> Column:
    return part / F.when(whole != 0, whole)


def _coverage(slots: str) -> list[Column]:
    recommended = F.count_if(F.col(slots) > 0)
    items = F.count_if(F.col("popularity") > 0)
    return [
        recommended.alias("recommended_items"),
        items.alias("total_items"),
        _ratio(recommended, items).alias("coverage"),
    ]


def _bias(slots: str) -> list[Column]:
    rated = F.col("popularity") > 0
    filled = F.when(rated, F.col(slots))
    shown = _ratio(F.sum(filled * F.col("popularity")), F.sum(filled))
    overall = F.avg(F.when(rated, F.col("popularity")))
    return [
        shown.alias("avg_recommended_popularity"),
        overall.alias("avg_popularity"),
        _ratio(shown, overall).alias("popularity_bias"),
    ]


def catalog_coverage(train: DataFrame, recs: DataFrame) -> DataFrame:
    """Share of the train items that occur in any recommendation list."""
    return item_exposure(train, recs, slots=F.lit(True)).agg(*_coverage("slots"))


def popularity_bias(train: DataFrame, recs: DataFrame) -> DataFrame:
    """Mean train popularity over recommended slots, relative to all train items."""
    return item_exposure(train, recs, slots=F.lit(True)).agg(*_bias("slots"))


def segment_of(n_train: Column) -> Column:
    """``cold``, ``warm`` or null in between."""
    return F.when(n_train < COLD_BELOW, "cold").when(n_train >= WARM_FROM, "warm")


def user_segments(train: DataFrame, key: str = "user_idx", mid: bool = False) -> DataFrame:
    """Cold and warm users by their number of train rows, with ``mid`` those between, too."""
    counts = train.groupBy(key).agg(F.count("*").alias("n_train"))
    segment = segment_of(F.col("n_train"))
    if mid:
        segment = F.coalesce(segment, F.lit("mid"))
    return counts.withColumn("segment", segment).filter("segment is not null")


def cold_warm_rmse(train: DataFrame, predictions: DataFrame, key: str = "user_idx") -> DataFrame:
    """``(segment, rmse, num_predictions)``; a segment without rows is absent."""
    zero = F.lit(0).cast("long")
    counts = train.select(key, F.lit(1).cast("long").alias("n_train"), F.lit(0.0).alias("sse"), zero.alias("n"))
    errors = predictions.select(key, zero.alias("n_train"), (_error() * _error()).alias("sse"), F.lit(1).cast("long").alias("n"))
    users = (
        counts.union(errors)
        .groupBy(key)
        .agg(F.sum("n_train").alias("n_train"), F.sum("sse").alias("sse"), F.sum("n").alias("n"))
    )
    return (
        users.filter("n_train > 0 and n > 0")
        .withColumn("segment", segment_of(F.col("n_train")))
        .filter("segment is not null")
        .groupBy("segment")
        .agg(F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse"), F.sum("n").alias("num_predictions"))
    )


def cold_warm_gap(train: DataFrame, predictions: DataFrame, key: str = "user_idx") -> DataFrame:
    """One row: both RMSE and by how many percent the cold one is higher."""
    by_segment = cold_warm_rmse(train, predictions, key)
    both = by_segment.agg(
        F.max(F.when(F.col("segment") == "cold", F.col("rmse"))).alias("cold_rmse"),
        F.max(F.when(F.col("segment") == "warm", F.col("rmse"))).alias("warm_rmse"),
    )
    return both.withColumn("gap_pct", relative_gap(F.col("cold_rmse"), F.col("warm_rmse")))


def evaluation_suite(
    predictions: DataFrame,
    recs: DataFrame,
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int] = RANKING_KS,
    ranking_sample: float | None = None,
    catalog_sample: float | None = None,
    coverage_k: int = 100,
    bias_k: int = 20,
    seed: int = SEED,
) -> DataFrame:
    """All metrics as long ``(metric, segment, k, value)`` rows.

    ``predictions`` carries ``split`` (validation or test); ``recs`` must reach
    rank ``coverage_k``. Ranking and bias are over all test users, coverage over
    all train users; with a share, over hash samples of them.
    """
    errors = error_metrics(predictions, "split").selectExpr(
        "stack(2, 'rmse', rmse, 'mae', mae) as (metric, value)", "split as segment"
    )
    errors = errors.select("metric", "segment", F.lit(None).cast("int").alias("k"), "value")

    ranking = precision_recall_at_k(test, recs, ks, sample=ranking_sample, seed=seed).selectExpr(
        "stack(2, 'precision', precision, 'recall', recall) as (metric, value)", "k"
    )
    ranking = ranking.select("metric", F.lit("test").alias("segment"), "k", "value")

    chosen = F.lit(True) if catalog_sample is None else hash_below(F.col("user_idx"), catalog_sample, seed)
    flags = (
        train.filter(chosen)
        .select("user_idx", F.lit(True).alias("in_train"), F.lit(False).alias("in_test"))
        .union(test.filter(chosen).select("user_idx", F.lit(False), F.lit(True)))
        .groupBy("user_idx")
        .agg(F.max("in_train").alias("in_train"), F.max("in_test").alias("in_test"))
    )
    exposure = item_exposure(
        train,
        recs.filter(chosen).join(flags, "user_idx"),
        covered=F.col("in_train") & (F.col("rank") <= coverage_k),
        shown=F.col("in_test") & (F.col("rank") <= bias_k),
    )
    catalog = exposure.agg(_coverage("covered")[-1], _bias("shown")[-1]).selectExpr(
        f"stack(2, 'coverage', 'train', {coverage_k}, coverage, "
        f"'popularity_bias', 'test', {bias_k}, popularity_bias) as (metric, segment, k, value)"
    )

    segments = cold_warm_rmse(train, predictions.filter("split = 'test'")).select(
        F.lit("rmse").alias("metric"), "segment", F.lit(None).cast("int").alias("k"), F.col("rmse").alias("value")
    )
    return errors.union(ranking).union(catalog).union(segments)


def bars_by_segment(suite: DataFrame) -> DataFrame:
    """``(segment, rmse)`` of validation, test, cold and warm rows of the suite."""
    return suite.filter("metric = 'rmse'").select("segment", F.col("value").alias("rmse"))


def bars_by_k(suite: DataFrame) -> DataFrame:
    """``(k, precision, recall)`` of the suite."""
    at_k = suite.filter(F.col("metric").isin("precision", "recall"))
    return at_k.groupBy("k").agg(
        F.max(F.when(F.col("metric") == "precision", F.col("value"))).alias("precision"),
        F.max(F.when(F.col("metric") == "recall", F.col("value"))).alias("recall"),
    )
