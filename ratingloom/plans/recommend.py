"""Batch top-N: a table of requests answered from a stored model."""

import argparse

from pyspark.sql import DataFrame

from ratingloom.operators import als
from ratingloom.operators.scoring import recommend, title_map
from ratingloom.session import build_session, temporary_tables, wide_shuffles
from ratingloom.sources import files


def answer(spark, model_path: str, data_dir: str, requests: DataFrame, n: int = 10, exclude_seen: bool = False) -> DataFrame:
    """Ranked, clamped and titled answers to ``requests``; ids are dense user ids."""
    model, _ = als.load_model(spark, model_path)
    titles = title_map(files.read_index(spark, data_dir, "item"), files.read_movies_parquet(spark, data_dir))
    seen = files.read_splits(spark, data_dir)["train"] if exclude_seen else None
    return recommend(requests, model.userFactors, model.itemFactors, titles, n, seen)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Answer recommendation requests in one batch")
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--model-path", required=True)
    parser.add_argument("--requests", required=True, help="Parquet with user_id and optionally num_recommendations")
    parser.add_argument("--output", required=True)
    parser.add_argument("-n", type=int, default=10)
    parser.add_argument("--exclude-seen", action="store_true")
    args = parser.parse_args(argv)

    spark = build_session("recommend")
    requests = spark.read.parquet(args.requests)
    inputs = [requests] + ([files.read_processed(spark, args.data_dir)] if args.exclude_seen else [])
    with wide_shuffles(*inputs), temporary_tables(spark):
        answers = answer(spark, args.model_path, args.data_dir, requests, args.n, args.exclude_seen)
        answers.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
