"""Full evaluation of a stored model on the stored splits."""

import argparse

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import hash_below
from ratingloom.operators import als, metrics
from ratingloom.operators.sampling import SEED
from ratingloom.schemas import RANKING_KS
from ratingloom.session import build_session, durable, temporary_tables, wide_shuffles
from ratingloom.sources import files

COVERAGE_K = 100


def users_to_score(
    splits: dict[str, DataFrame], ranking_sample: float | None = None, catalog_sample: float | None = None
) -> DataFrame:
    """``user_idx, depth``: how many items each user needs for all metrics.

    Train users need ``COVERAGE_K`` for the coverage, test users the largest k of
    the ranking metrics. With a share only a hash sample of them is scored.
    """

    def chosen(split: str, share: float | None, depth: int) -> DataFrame:
        users = splits[split].select("user_idx")
        if share is not None:
            users = users.filter(hash_below(F.col("user_idx"), share, SEED))
        return users.select("user_idx", F.lit(depth).alias("depth"))

    whole = ranking_sample is None or catalog_sample is None
    ranked = chosen("test", None if whole else max(ranking_sample, catalog_sample), max(RANKING_KS))
    covered = chosen("train", catalog_sample, COVERAGE_K)
    return ranked.union(covered).groupBy("user_idx").agg(F.max("depth").alias("depth"))


def evaluate(
    model: ALSModel,
    splits: dict[str, DataFrame],
    ranking_sample: float | None = None,
    catalog_sample: float | None = None,
    recs: DataFrame | None = None,
) -> DataFrame:
    """Long metrics table over all users, or samples on request; a user is scored once for all metrics.

    ``recs`` are lists that hold at least those of ``users_to_score``.
    """
    train, validation, test = (splits[name] for name in files.SPLITS)
    held_out = validation.withColumn("split", F.lit("validation")).union(
        test.withColumn("split", F.lit("test"))
    )
    predictions = durable(als.score(model, held_out), "predictions")

    if recs is None:
        users = users_to_score(splits, ranking_sample, catalog_sample)
        recs = durable(als.top_n_subset(model, users, COVERAGE_K), "recs")
    return metrics.evaluation_suite(
        predictions,
        recs,
        train,
        test,
        ranking_sample=ranking_sample,
        catalog_sample=catalog_sample,
        coverage_k=COVERAGE_K,
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Evaluate a stored model")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--model-path", required=True)
    parser.add_argument("--output", required=True)
    args = parser.parse_args(argv)

    spark = build_session("evaluate")
    model, _ = als.load_model(spark, args.model_path)
    splits = files.read_splits(spark, args.data_dir)
    with wide_shuffles(files.read_processed(spark, args.data_dir)), temporary_tables(spark):
        files.write_json_record(evaluate(model, splits), args.output)


if __name__ == "__main__":
    main()
