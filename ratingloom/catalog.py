"""One named query per operator, over the driver tables."""

from collections.abc import Callable

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import fixtures as fx
from ratingloom.functions import clamp_rating, star_string
from ratingloom.operators import (
    activity,
    als,
    cleaning,
    indexing,
    metrics,
    profiling,
    sampling,
    scoring,
    sketches,
    splitting,
)
from ratingloom.plans.evaluate import evaluate
from ratingloom.plans.explore import explore
from ratingloom.plans.prepare import PrepareConfig, prepare
from ratingloom.plans.recommend import answer
from ratingloom.plans.train import train
from ratingloom.session import durable, scratch_path
from ratingloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]

# Small enough to fit within a query; the jobs default to the full parameters.
ALS_PARAMS = {"rank": 4, "maxIter": 3}
TOP_N = 20
# The suite by samples, beside that over all users.
SUITE_SAMPLES = {"ranking_sample": 0.5, "catalog_sample": 0.25}


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def _split(indexed: DataFrame, name: str) -> DataFrame:
    return indexed.filter(F.col("split") == name).drop("split")


def _model(indexed: DataFrame):
    return als.fit_als(_split(indexed, "train"), **ALS_PARAMS)[0]


def _top(spark: SparkSession, folder: str, n: int = TOP_N, seen: DataFrame | None = None) -> DataFrame:
    factors = fx.factors(spark, folder)
    return scoring.top_n_from_factors(factors, factors, n, seen)


# Sources and sinks


def csv_ratings_roundtrip(spark, folder):
    path = scratch_path(spark, "ratings-csv")
    files.write_csv(fx.ratings(spark, folder), path)
    return files.read_ratings_csv(spark, path)


def csv_rejects(spark, folder):
    """Lines of a file that do not fit, with the reason, and the number of those that do."""
    path, t = scratch_path(spark, "flawed-csv"), F.col("timestamp")
    fields = [F.col(c).cast("string") for c in ("userId", "movieId", "rating", "timestamp")]
    line = (
        F.when(t % 97 == 0, F.concat(F.lit("x"), F.concat_ws(",", *fields)))
        .when(t % 89 == 0, F.concat_ws(",", *fields, F.lit("1")))
        .when(t % 83 == 0, F.concat_ws(",", *fields[:3]))
        .when(t % 79 == 0, F.concat_ws(",", *fields[:2], F.lit("good"), fields[3]))
        .otherwise(F.concat_ws(",", *fields))
    )
    lines = fx.ratings(spark, folder).select(line.alias("userId,movieId,rating,timestamp"))
    # Whole lines as they are: no separator and no quotes.
    lines.write.csv(path, header=True, sep="\x01", quote="", escape="")
    good, rejects = files.read_ratings_checked(spark, path)
    rejects = rejects.filter(F.col("file").contains(path.rsplit("/", 1)[-1])).select("line", "reason")
    return rejects.union(good.agg(F.count("timestamp").cast("string"), F.lit("good")))


def csv_movies_roundtrip(spark, folder):
    """Titles get a comma and quotes, which the reader must undo."""
    path = scratch_path(spark, "movies-csv")
    title = F.concat(F.lit('Say "'), "title", F.lit('", twice'))
    files.write_csv(fx.movies(spark, folder).withColumn("title", title), path)
    return files.read_movies_csv(spark, path)


def tags_count(spark, folder):
    path = scratch_path(spark, "tags-csv")
    files.write_csv(fx.tags(spark, folder), path)
    return profiling.row_count("tags", files.read_tags_csv(spark, path))


def split_roundtrip_counts(spark, folder):
    path = scratch_path(spark, "prepared")
    indexed = fx.indexed(spark, folder)
    files.write_processed(indexed, path)
    files.write_movies(fx.movies(spark, folder), path)
    tables = {
        "ratings_processed": files.read_processed(spark, path),
        "movies": files.read_movies_parquet(spark, path),
        **files.read_splits(spark, path),
    }
    counts = [profiling.row_count(name, table) for name, table in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.union(other)
    return result


def clustered_roundtrip(spark, folder):
    """Processed ratings stored side by side per user, read again by split."""
    path = scratch_path(spark, "clustered")
    files.write_clustered(fx.indexed(spark, folder), path, 6)
    parts = [df.withColumn("split", F.lit(name)) for name, df in files.read_splits(spark, path).items()]
    return parts[0].union(parts[1]).union(parts[2])


def stats_json_roundtrip(spark, folder):
    path = scratch_path(spark, "stats-json")
    stats = profiling.dataset_statistics(fx.processed(spark, folder))
    files.write_json_record(stats, path)
    return _rounded(spark.read.schema(stats.schema).json(path))


def metrics_json_roundtrip(spark, folder):
    path = scratch_path(spark, "metrics-json")
    suite = _suite(spark, folder, **SUITE_SAMPLES)
    files.write_json_record(suite, path)
    return _rounded(spark.read.schema(suite.schema).json(path))


def model_roundtrip(spark, folder):
    """Factor vectors before and after storing the model, and how many differ."""
    model = _model(fx.indexed(spark, folder))
    path = scratch_path(spark, "model")
    als.save_model(model, path, [])
    loaded, _ = als.load_model(spark, path)
    sides = []
    for side, before, after in (
        ("user", model.userFactors, loaded.userFactors),
        ("item", model.itemFactors, loaded.itemFactors),
    ):
        both = before.join(after.withColumnRenamed("features", "stored"), "id", "full")
        same = F.col("features").eqNullSafe(F.col("stored"))
        sides.append(both.agg(F.lit(side).alias("side"), F.count("*").alias("n"), F.count_if(~same).alias("differing")))
    return sides[0].union(sides[1])


# Cleaning and quality


def clean_ratings(spark, folder):
    return cleaning.clean_ratings(fx.dirty_ratings(spark, folder))


def clean_report(spark, folder):
    return cleaning.clean_report(fx.dirty_ratings(spark, folder))


def dq_null_ratings(spark, folder):
    return cleaning.null_ratings(fx.dirty_ratings(spark, folder))


def dq_invalid_ratings(spark, folder):
    return cleaning.invalid_ratings(fx.dirty_ratings(spark, folder))


def dq_missing_genres(spark, folder):
    return cleaning.missing_genres(fx.movies(spark, folder))


# Activity filter, index, split


def active_users(spark, folder):
    return activity.active_users(fx.clean(spark, folder), fx.MIN_USER_RATINGS)


def active_items(spark, folder):
    return activity.active_items(fx.clean(spark, folder), fx.MIN_ITEM_RATINGS)


def filter_inactive(spark, folder):
    return fx.processed(spark, folder)


def user_index(spark, folder):
    return indexing.user_index(fx.processed(spark, folder))


def item_index(spark, folder):
    return indexing.item_index(fx.processed(spark, folder))


def indexed_ratings(spark, folder):
    return fx.indexed(spark, folder).drop("split")


def split_train(spark, folder):
    return splitting.split_of(fx.processed(spark, folder), splitting.TRAIN)


def split_val(spark, folder):
    return splitting.split_of(fx.processed(spark, folder), splitting.VALIDATION)


def split_test(spark, folder):
    return splitting.split_of(fx.processed(spark, folder), splitting.TEST)


def split_by_hash(spark, folder):
    """Valid ratings split by a seeded hash instead of time."""
    rows = splitting.with_hash_split(fx.clean(spark, folder), seed=42)
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.sum("timestamp").alias("sum_timestamp"))


def filter_inactive_twice(spark, folder):
    return activity.filter_inactive(fx.clean(spark, folder), fx.MIN_USER_RATINGS, fx.MIN_ITEM_RATINGS, iterations=2)


def split_shares(spark, folder):
    stored = durable(splitting.with_split(fx.processed(spark, folder)).select("split"), "split")
    return _rounded(splitting.split_shares(stored))


# Profile


def profile_sketches(spark, folder):
    """Whether sketches of four loads, merged, are within their stated error, and equal to those of one load."""
    rows = fx.ratings(spark, folder)
    loads = durable(sketches.load_sketches(rows, F.pmod("timestamp", F.lit(4))), "load-sketches")
    whole = durable(sketches.load_sketches(rows, F.lit(0)), "load-sketches")
    parts, single = (durable(sketches.estimates(sketches.merged(t)), "estimates") for t in (loads, whole))
    exact = durable(profiling.rating_totals(rows), "totals")
    r, median = F.col("rating").cast("double"), parts.select("median").scalar()
    ranks = durable(rows.agg(F.avg((r < median).cast("int")).alias("below"), F.avg((r <= median).cast("int")).alias("up_to")), "ranks")

    def near(name: str) -> Column:
        truth = exact.select(name).scalar()
        return F.abs(F.col(name) - truth) <= 4 * sketches.DISTINCT_ERROR * truth

    below, up_to = (ranks.select(name).scalar() for name in ("below", "up_to"))
    same = [F.col(name) == single.select(name).scalar() for name in ("num_users", "num_items")]
    return parts.select(
        F.col("n").alias("n_ratings"),
        near("num_users").alias("users_near"),
        near("num_items").alias("items_near"),
        ((below <= 0.5 + sketches.RANK_ERROR) & (up_to >= 0.5 - sketches.RANK_ERROR)).alias("median_near"),
        (same[0] & same[1]).alias("same_as_one_load"),
    )


def dataset_counts(spark, folder):
    return profiling.dataset_counts(fx.ratings(spark, folder), fx.movies(spark, folder), fx.tags(spark, folder))


def rating_distribution(spark, folder):
    return profiling.rating_distribution(fx.ratings(spark, folder))


def rating_stats(spark, folder):
    return _rounded(profiling.rating_stats(fx.ratings(spark, folder)))


def matrix_sparsity(spark, folder):
    return _rounded(profiling.rating_totals(fx.ratings(spark, folder)))


def user_activity(spark, folder):
    return _rounded(profiling.user_activity(fx.ratings(spark, folder)))


def item_popularity(spark, folder):
    return _rounded(profiling.item_popularity(fx.ratings(spark, folder)))


def user_activity_stats(spark, folder):
    return _rounded(profiling.activity_stats(profiling.user_activity(fx.ratings(spark, folder))))


def item_popularity_stats(spark, folder):
    return _rounded(profiling.activity_stats(profiling.item_popularity(fx.ratings(spark, folder))))


def ratings_per_user_median(spark, folder):
    return _rounded(profiling.median_ratings(profiling.user_activity(fx.processed(spark, folder))))


def ratings_per_item_median(spark, folder):
    return _rounded(profiling.median_ratings(profiling.item_popularity(fx.processed(spark, folder))))


def dataset_statistics(spark, folder):
    return _rounded(profiling.dataset_statistics(fx.processed(spark, folder)))


def cold_share(spark, folder):
    return _rounded(profiling.cold_shares(fx.ratings(spark, folder), below=25))


def top_active_users(spark, folder):
    return _rounded(profiling.top_active_users(profiling.user_activity(fx.ratings(spark, folder))))


def top_rated_movies(spark, folder):
    popular = profiling.item_popularity(fx.ratings(spark, folder))
    return _rounded(profiling.top_rated_movies(popular, fx.titled_movies(spark, folder)))


def _explore_long(ratings, spark, folder):
    """All one-row tables of the exploration report as ``(report, name, value)``."""
    report = explore(ratings, fx.movies(spark, folder), fx.tags(spark, folder))
    single = (
        "totals",
        "rating_stats",
        "missing_ratings",
        "user_activity_stats",
        "item_popularity_stats",
        "cold_users",
        "cold_items",
        "missing_genres",
    )
    result = report["table_counts"].select(
        F.lit("table_counts").alias("report"), "name", F.col("n").cast("double").alias("value")
    )
    for name in single:
        table = report[name]
        pairs = ", ".join(f"'{c}', double({c})" for c in table.columns)
        long = table.selectExpr(f"'{name}' as report", f"stack({len(table.columns)}, {pairs}) as (name, value)")
        result = result.union(long)
    return _rounded(result)


def explore_summary(spark, folder):
    return _explore_long(fx.dirty_ratings(spark, folder), spark, folder)


def explore_summary_without_nan(spark, folder):
    return _explore_long(fx.ratings(spark, folder), spark, folder)


def explore_tables(spark, folder):
    """The tables of several rows in the exploration report."""
    report = explore(fx.ratings(spark, folder), fx.movies(spark, folder), fx.tags(spark, folder))

    def long(name: str, id, rating: str, n: str):
        return report[name].select(
            F.lit(name).alias("report"), id.alias("id"), F.col(rating).cast("double").alias("rating"), F.col(n).alias("n")
        )

    values = long("rating_distribution", F.lit(None).cast("int"), "rating", "n")
    users = long("top_active_users", F.col("userId"), "avg_rating", "num_ratings")
    items = long("top_rated_movies", F.col("movieId"), "avg_rating", "num_ratings")
    return values.union(_rounded(users.union(items)))


# Sampling


def user_sample(spark, folder):
    return sampling.sample_users(_split(fx.indexed(spark, folder), "test"), 0.1)


def random_users(spark, folder):
    return sampling.random_users(fx.factors(spark, folder), 5)


# Recommendations


def topn_from_factors(spark, folder):
    return _rounded(_top(spark, folder))


def topn_exclude_seen(spark, folder):
    seen = _split(fx.indexed(spark, folder), "train")
    return _rounded(_top(spark, folder, seen=seen))


def topn_pruned(spark, folder):
    """The lists of ``topn_from_factors`` by slices in order of their norm, which later ones are skipped."""
    factors = fx.factors(spark, folder)
    return _rounded(scoring.top_n_pruned(factors, factors, TOP_N, items_per_slice=5000).recommendations)


def topn_bad_vectors(spark, folder):
    """Lists of the vectors that can be scored, beside the number of those that cannot."""
    factors = fx.flawed_factors(spark, folder)
    top = scoring.top_n_from_factors(factors, factors, TOP_N, rejects="skip")
    rejected = scoring.rejected_factors(factors, factors).agg(F.count("*").alias("n"))
    return _rounded(top.withColumn("n_rejected", rejected.scalar()))


def _rating_like(spark, folder):
    return _top(spark, folder).withColumn("predicted_rating", clamp_rating(1 + 4 * F.col("score")))


def topn_clamped(spark, folder):
    return _rounded(_rating_like(spark, folder).select("user_idx", "item_idx", "rank", "predicted_rating"))


def topn_stars(spark, folder):
    stars = star_string(F.col("predicted_rating")).alias("stars")
    return _rating_like(spark, folder).select("user_idx", "item_idx", "rank", stars)


def topn_with_titles(spark, folder):
    titles = scoring.title_map(fx.item_index(spark, folder), fx.titled_movies(spark, folder))
    return scoring.with_titles(_top(spark, folder), titles).select(
        "user_idx", "item_idx", "rank", "movieId", "title"
    )


def batch_status(spark, folder):
    return scoring.batch_status(fx.requests(spark, folder), fx.factors(spark, folder))


def batch_recommend(spark, folder):
    titles = scoring.title_map(fx.item_index(spark, folder), fx.titled_movies(spark, folder))
    factors = fx.factors(spark, folder)
    return _rounded(scoring.recommend(fx.requests(spark, folder), factors, factors, titles))


# Metrics


def error_metrics(spark, folder):
    return _rounded(metrics.error_metrics(fx.predictions(fx.indexed(spark, folder)), "split"))


def precision_recall_at_k(spark, folder):
    test = _split(fx.indexed(spark, folder), "test")
    return _rounded(metrics.precision_recall_at_k(test, _top(spark, folder)))


def precision_recall_nested(spark, folder):
    """The same from stored lists of structs, one row per user."""
    path = scratch_path(spark, "nested-lists")
    metrics.nested_lists(_top(spark, folder)).write.parquet(path)
    test = _split(fx.indexed(spark, folder), "test")
    return _rounded(metrics.precision_recall_nested(test, spark.read.parquet(path)))


def precision_recall_sampled(spark, folder):
    test = _split(fx.indexed(spark, folder), "test")
    return _rounded(metrics.precision_recall_at_k(test, _top(spark, folder), sample=0.5))


def catalog_coverage(spark, folder):
    train_rows = _split(fx.indexed(spark, folder), "train")
    return _rounded(metrics.catalog_coverage(train_rows, _top(spark, folder)))


def popularity_bias(spark, folder):
    train_rows = _split(fx.indexed(spark, folder), "train")
    return _rounded(metrics.popularity_bias(train_rows, _top(spark, folder)))


def _unfiltered(spark, folder):
    """Train rows and predictions of all valid ratings, where cold users exist."""
    rows = durable(splitting.with_split(fx.clean(spark, folder)), "clean", partition_by="split")
    return _split(rows, "train"), fx.predictions(rows, "movieId").filter("split = 'test'")


def cold_warm_segments(spark, folder):
    """Test rows per segment of their user."""
    rows = splitting.with_split(fx.clean(spark, folder))
    segments = metrics.user_segments(_split(rows, "train"), "userId")
    per_user = _split(rows, "test").groupBy("userId").agg(F.count("*").alias("n_test"))
    return per_user.join(segments, "userId").select("userId", "segment", "n_train", "n_test")


def user_segments_with_mid(spark, folder):
    rows = _split(splitting.with_split(fx.clean(spark, folder)), "train")
    return metrics.user_segments(rows, "userId", mid=True).groupBy("segment").agg(F.count("*").alias("n"))


def cold_warm_rmse(spark, folder):
    return _rounded(metrics.cold_warm_rmse(*_unfiltered(spark, folder), "userId"))


def cold_warm_gap(spark, folder):
    return _rounded(metrics.cold_warm_gap(*_unfiltered(spark, folder), "userId"))


def _suite(spark, folder, **samples: float):
    indexed = fx.indexed(spark, folder)
    recs = durable(_top(spark, folder, 100), "recs")
    return metrics.evaluation_suite(
        fx.predictions(indexed), recs, _split(indexed, "train"), _split(indexed, "test"), **samples
    )


def evaluation_suite(spark, folder):
    return _rounded(_suite(spark, folder))


def metric_bars_by_segment(spark, folder):
    return _rounded(metrics.bars_by_segment(_suite(spark, folder)))


def metric_bars_by_k(spark, folder):
    return _rounded(metrics.bars_by_k(_suite(spark, folder)))


# Model


def factor_first_mean(spark, folder):
    return _rounded(als.first_factor_mean(fx.factors(spark, folder)))


def als_factor_info(spark, folder):
    model = _model(fx.indexed(spark, folder))
    info = als.factor_info(model.userFactors, model.itemFactors, model.rank)
    return info.select("num_user_factors", "num_item_factors", "rank")


def als_prediction_keys(spark, folder):
    """Held-out rows that get a prediction."""
    indexed = fx.indexed(spark, folder)
    scored = als.score(_model(indexed), indexed.filter("split <> 'train'"))
    return scored.select("user_idx", "item_idx", "timestamp", "split")


def als_score_check(spark, folder):
    """Block scoring against MLlib: predictions as ``transform``, errors as ``RegressionEvaluator``."""
    indexed = fx.indexed(spark, folder)
    model = _model(indexed)
    rows = indexed.filter("split <> 'train'").withColumn("row", F.xxhash64("user_idx", "item_idx", "timestamp", "rating"))
    ours, theirs = durable(als.score(model, rows), "ours"), durable(model.transform(rows), "theirs")
    pairs = ours.select("user_idx", "item_idx", F.col("prediction").alias("p")).distinct()
    other = theirs.select("user_idx", "item_idx", F.col("prediction").alias("q")).distinct()
    both = pairs.join(other, ["user_idx", "item_idx"], "full")
    same = F.coalesce(F.bool_and(F.coalesce(F.abs(F.col("p") - F.col("q")) < 1e-5, F.lit(False))), F.lit(True))
    errors = metrics.error_metrics(ours).first()
    equal = {}
    for name in ("rmse", "mae"):
        expected = RegressionEvaluator(metricName=name, labelCol="rating", predictionCol="prediction").evaluate(theirs)
        equal[name] = abs(errors[name] - expected) < 1e-6
    n = ours.agg(F.count("*")).scalar()
    return both.agg(same.alias("as_transform")).select(
        n.alias("n"), "as_transform", *[F.lit(ok).alias(f"{name}_equal") for name, ok in equal.items()]
    )


def als_topn_counts(spark, folder):
    recs = als.top_n_all(_model(fx.indexed(spark, folder)), 10)
    return recs.groupBy("user_idx").agg(
        F.count("*").alias("n"), F.count_distinct("item_idx").alias("n_items"), F.max("rank").alias("last_rank")
    )


# Jobs


def prepare_job(spark, folder):
    """Dirty CSV text through the whole preparation, as stored with its split."""
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "prepared")
    files.write_csv(fx.dirty_ratings(spark, folder), f"{source}/ratings")
    files.write_csv(fx.movies(spark, folder), f"{source}/movies")
    prepare(
        files.read_ratings_csv(spark, f"{source}/ratings"),
        files.read_movies_csv(spark, f"{source}/movies"),
        target,
        PrepareConfig(fx.MIN_USER_RATINGS, fx.MIN_ITEM_RATINGS),
    )
    parts = [df.withColumn("split", F.lit(name)) for name, df in files.read_splits(spark, target).items()]
    return parts[0].union(parts[1]).union(parts[2])


def prepare_reports(spark, folder):
    """Reports and indices of the preparation as ``(report, name, value)``."""
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "prepared")
    files.write_csv(fx.dirty_ratings(spark, folder), source)
    prepare(
        files.read_ratings_csv(spark, source),
        fx.movies(spark, folder),
        target,
        PrepareConfig(fx.MIN_USER_RATINGS, fx.MIN_ITEM_RATINGS),
    )
    names = {
        "clean_report": ("total", "missing", "out_of_range", "kept", "removed"),
        "filter_report": (
            "ratings_before", "users_before", "items_before", "ratings_after", "users_after", "items_after", "removed"
        ),
    }
    parts = []
    for report, fields in names.items():
        table = spark.read.schema(", ".join(f"{f} long" for f in fields)).json(f"{target}/{report}")
        pairs = ", ".join(f"'{f}', double({f})" for f in fields)
        parts.append(table.selectExpr(f"'{report}' as report", f"stack({len(fields)}, {pairs}) as (name, value)"))
    shares = spark.read.schema("split string, share_pct double").json(f"{target}/split_shares")
    parts.append(shares.selectExpr("'split_shares' as report", "split as name", "share_pct as value"))
    for side, key, index in (("user", "userId", "user_idx"), ("item", "movieId", "item_idx")):
        table = files.read_index(spark, target, side)
        parts.append(table.selectExpr(f"'{side}_index' as report", f"string({key}) as name", f"double({index}) as value"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return _rounded(result)


def _stored_splits(spark, indexed):
    path = scratch_path(spark, "prepared")
    files.write_processed(indexed, path)
    return path


def train_job(spark, folder):
    """Metrics the training job reports; model-dependent values only as present."""
    path = _stored_splits(spark, fx.indexed(spark, folder))
    _, report = train(spark, path, path, **ALS_PARAMS)
    exact = F.when(F.col("metric") == "num_predictions", F.col("value"))
    return report.select(
        "metric", "segment", F.col("k").cast("int").alias("k"), F.col("value").isNotNull().alias("present"), exact.alias("value")
    )


def evaluate_job(spark, folder):
    """Metrics the evaluation job reports for a trained model."""
    path = _stored_splits(spark, fx.indexed(spark, folder))
    splits = files.read_splits(spark, path)
    suite = evaluate(als.fit_als(splits["train"], **ALS_PARAMS)[0], splits)
    return suite.select("metric", "segment", "k", F.col("value").isNotNull().alias("present"))


def recommend_job(spark, folder):
    """The batch job on a stored model without seen items: what each request gets.

    Two requests name an id and a number beyond 32 bits.
    """
    indexed = fx.indexed(spark, folder)
    path, model_path = _stored_splits(spark, indexed), scratch_path(spark, "model")
    files.write_movies(fx.movies(spark, folder), path)
    files.write_index(fx.item_index(spark, folder), path, "item")
    als.save_model(_model(indexed), model_path, [])
    large = spark.createDataFrame([(1 << 40, 5), (0, 1 << 40)], "user_id long, num_recommendations long")
    wanted = fx.requests(spark, folder).select(F.col("user_id").cast("long"), F.col("num_recommendations").cast("long"))
    answers = durable(answer(spark, model_path, path, wanted.union(large), exclude_seen=True), "answers")
    seen = files.read_splits(spark, path)["train"].select(
        F.col("user_idx").alias("user_id"), "item_idx", F.lit(True).alias("seen")
    ).distinct()
    return answers.join(seen, ["user_id", "item_idx"], "left").groupBy("user_id", "status").agg(
        F.count("item_idx").alias("n_items"), (F.count("seen") == 0).alias("none_seen")
    )


QUERIES: dict[str, Query] = {
    fn.__name__: fn
    for fn in (
        csv_ratings_roundtrip,
        csv_rejects,
        csv_movies_roundtrip,
        tags_count,
        split_roundtrip_counts,
        clustered_roundtrip,
        stats_json_roundtrip,
        metrics_json_roundtrip,
        model_roundtrip,
        clean_ratings,
        clean_report,
        dq_null_ratings,
        dq_invalid_ratings,
        dq_missing_genres,
        active_users,
        active_items,
        filter_inactive,
        user_index,
        item_index,
        indexed_ratings,
        split_train,
        split_val,
        split_test,
        split_by_hash,
        filter_inactive_twice,
        split_shares,
        profile_sketches,
        dataset_counts,
        rating_distribution,
        rating_stats,
        matrix_sparsity,
        user_activity,
        item_popularity,
        user_activity_stats,
        item_popularity_stats,
        ratings_per_user_median,
        ratings_per_item_median,
        dataset_statistics,
        cold_share,
        top_active_users,
        top_rated_movies,
        explore_summary,
        explore_summary_without_nan,
        explore_tables,
        user_sample,
        random_users,
        topn_from_factors,
        topn_exclude_seen,
        topn_pruned,
        topn_bad_vectors,
        topn_clamped,
        topn_stars,
        topn_with_titles,
        batch_status,
        batch_recommend,
        error_metrics,
        precision_recall_at_k,
        precision_recall_nested,
        precision_recall_sampled,
        catalog_coverage,
        popularity_bias,
        cold_warm_segments,
        user_segments_with_mid,
        cold_warm_rmse,
        cold_warm_gap,
        evaluation_suite,
        metric_bars_by_segment,
        metric_bars_by_k,
        factor_first_mean,
        als_factor_info,
        als_prediction_keys,
        als_score_check,
        als_topn_counts,
        prepare_job,
        prepare_reports,
        recommend_job,
        train_job,
        evaluate_job,
    )
}
