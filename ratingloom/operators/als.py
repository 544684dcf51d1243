"""ALS training, scoring and storage on MLlib."""

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.scoring import score_pairs, top_n_from_factors
from ratingloom.session import durable, remove, shared_folder
from ratingloom.sources.files import write_json_record

# The default training parameters.
DEFAULTS = {
    "rank": 100,
    "maxIter": 10,
    "regParam": 0.1,
    "alpha": 1.0,
    "userCol": "user_idx",
    "itemCol": "item_idx",
    "ratingCol": "rating",
    "coldStartStrategy": "drop",
    "implicitPrefs": False,
    "seed": 42,
    "checkpointInterval": 10,
    # MLlib draws the first factors block by block, so these change the model.
    "numUserBlocks": 10,
    "numItemBlocks": 10,
    "intermediateStorageLevel": "MEMORY_AND_DISK",
    "finalStorageLevel": "MEMORY_AND_DISK",
}

def fit_als(train: DataFrame, **params) -> tuple[ALSModel, dict]:
    """Train on ``train`` and return the model with its history entry.

    ``params`` are MLlib ALS parameters and override ``DEFAULTS``. Nothing follows
    from the data: large inputs need more blocks, about one per two million
    ratings, and as they change the model they are given, not guessed.
    """
    params = {**DEFAULTS, **params}
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(train.sparkSession))
    columns = [params["userCol"], params["itemCol"], params["ratingCol"]]
    started = time.time()
    model = ALS(**params).fit(train.select(*columns))
    return model, {"started": started, "params": params, "training_time": time.time() - started}


def score(model: ALSModel, df: DataFrame) -> DataFrame:
    """``df (user_idx, item_idx, ...)`` with ``prediction``; rows of unknown users or items are dropped."""
    return score_pairs(df, model.userFactors, model.itemFactors)


def top_n_all(model: ALSModel, n: int) -> DataFrame:
    """Best ``n`` items of every user; rated items are not left out."""
    return top_n_from_factors(model.userFactors, model.itemFactors, n)


def top_n_subset(model: ALSModel, users: DataFrame, n: int) -> DataFrame:
    """Best ``n`` items of the given users; unknown users give no row.

    With a column ``depth`` in ``users`` a user gets that many items, ``n`` at
    most; the deepest of several counts.
    """
    if "depth" in users.columns:
        wanted = users.groupBy(F.col("user_idx").alias("id")).agg(F.max("depth").alias("depth"))
        known = model.userFactors.join(wanted, "id")
    else:
        known = model.userFactors.join(users.select(F.col("user_idx").alias("id")), "id", "left_semi")
    return top_n_from_factors(durable(known, "wanted-factors"), model.itemFactors, n)


def first_factor_mean(factors: DataFrame) -> DataFrame:
    return factors.agg(F.avg(F.get("features", F.lit(0)).cast("double")).alias("first_factor_mean"))


def factor_info(user_factors: DataFrame, item_factors: DataFrame, rank: int) -> DataFrame:
    """One row: number of user and item vectors, rank, mean of the first user factor."""
    users = user_factors.agg(
        F.count("*").alias("num_user_factors"),
        F.avg(F.get("features", F.lit(0)).cast("double")).alias("sample_user_factor_mean"),
    )
    n_items = item_factors.agg(F.count("*")).scalar()
    return users.select(
        "num_user_factors",
        n_items.alias("num_item_factors"),
        F.lit(rank).alias("rank"),
        "sample_user_factor_mean",
    )


# Versions of a stored model that are kept.
KEEP_VERSIONS = 3
_MANIFEST = "version string, training_history string"


def save_model(model: ALSModel, path: str, history: list[dict]) -> str:
    """A new version of the model below ``path``, with training history and factor info; returns its name.

    The manifest is written last and holds the history: a version exists once its
    manifest does, so a save that stops half way leaves the one before in force.
    Of older versions the last ``KEEP_VERSIONS`` stay.
    """
    spark = model.userFactors.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    model.write().save(f"{path}/versions/{version}/model")
    info = factor_info(model.userFactors, model.itemFactors, model.rank)
    metadata = info.withColumn("training_history", F.lit(json.dumps(history))).withColumn(
        "saved_at", F.current_timestamp()
    )
    write_json_record(metadata, f"{path}/versions/{version}/metadata")
    manifest = spark.createDataFrame([(version, json.dumps(history))], _MANIFEST)
    write_json_record(manifest, f"{path}/manifests/{version}")
    for old, _ in model_versions(spark, path)[:-KEEP_VERSIONS]:
        # The manifest goes first, so that no version is in force without its model.
        remove(spark, f"{path}/manifests/{old}")
        remove(spark, f"{path}/versions/{old}")
    return version


def model_versions(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Names and histories of all complete versions below ``path``, the oldest first."""
    try:
        rows = spark.read.schema(_MANIFEST).json(f"{path}/manifests/*").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((row["version"], row["training_history"]) for row in rows)


def load_model(spark: SparkSession, path: str, version: str | None = None) -> tuple[ALSModel, list[dict]]:
    """The last complete version, or the one named, and its training history.

    A plain MLlib model at ``path`` is read as well; its history is empty.
    """
    versions = dict(model_versions(spark, path))
    if version is None and not versions:
        return ALSModel.load(path), []
    if version is not None and version not in versions:
        raise ValueError(f"{path} holds no complete version {version}")
    version = version or max(versions)
    return ALSModel.load(f"{path}/versions/{version}/model"), json.loads(versions[version])
