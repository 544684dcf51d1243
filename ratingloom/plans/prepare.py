"""Raw files to indexed ratings, splits and dataset statistics."""

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratingloom.operators.activity import (
    ITEM_SIDE,
    USER_SIDE,
    filter_inactive,
    filter_report_of_counts,
    rating_counts,
)
from ratingloom.operators.cleaning import clean_observed
from ratingloom.operators.indexing import dense_indices, with_indices
from ratingloom.operators.profiling import statistics_of_counts
from ratingloom.operators.splitting import shares_of, split_observed, with_split
from ratingloom.session import build_session, durable, temporary_tables, wide_shuffles
from ratingloom.sources import files


@dataclass(frozen=True)
class PrepareConfig:
    min_user_ratings: int = 20
    min_item_ratings: int = 5
    train_ratio: float = 0.8
    val_ratio: float = 0.1


def prepare(ratings: DataFrame, movies: DataFrame, folder: str, config: PrepareConfig = PrepareConfig()) -> None:
    """Write ``ratings_processed`` (by split), both indices, ``movies`` and the reports.

    Reports: ``dataset_stats``, ``clean_report``, ``filter_report`` and
    ``split_shares``. They come from the writes themselves: what a write lets
    through is counted on its way, and all else follows from the counts per user
    and item, so that no table is read for a report. A task that is run again
    counts once, as each of these writes is the last stage of its job.
    """
    spark = ratings.sparkSession
    with wide_shuffles(ratings), temporary_tables(spark):
        observed, cleaning = clean_observed(ratings)
        cleaned = durable(observed, "cleaned")
        removed = {"removed": cleaning.get["total"] - cleaning.get["kept"]}
        files.write_json_record(files.record(spark, cleaning.get | removed), f"{folder}/clean_report")

        counts = durable(rating_counts(cleaned), "rating-counts", partition_by="side")
        rating, spread = F.col("rating").cast("double"), Observation("ratings")
        active = durable(
            filter_inactive(cleaned, config.min_user_ratings, config.min_item_ratings, counts=counts).observe(
                spread, F.avg(rating).alias("average"), F.stddev_samp(rating).alias("deviation")
            ),
            "active",
        )
        users, items, limits = dense_indices(active)
        files.write_index(users, folder, "user")
        files.write_index(items, folder, "item")
        users, items = files.read_index(spark, folder, "user"), files.read_index(spark, folder, "item")
        left = users.select(F.lit(USER_SIDE).alias("side"), "n").union(items.select(F.lit(ITEM_SIDE), "n"))
        files.write_json_record(filter_report_of_counts(counts, left), f"{folder}/filter_report")
        stats = statistics_of_counts(left, spread.get["average"], spread.get["deviation"])
        files.write_json_record(stats, f"{folder}/dataset_stats")

        indexed = with_split(with_indices(active, (users, items, limits)), config.train_ratio, config.val_ratio)
        indexed, shares = split_observed(indexed)
        files.write_processed(indexed, folder)
        files.write_json_record(shares_of(spark, shares.get), f"{folder}/split_shares")
        files.write_movies(movies, folder)


def main(argv: list[str] | None = None) -> None:
    defaults = PrepareConfig()
    parser = argparse.ArgumentParser(description="Clean, filter, index and split rating files")
    parser.add_argument("--ratings", required=True)
    parser.add_argument("--movies", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--rejects", help="folder for lines that do not fit the layout; without it their fields are null")
    parser.add_argument("--min-user-ratings", type=int, default=defaults.min_user_ratings)
    parser.add_argument("--min-item-ratings", type=int, default=defaults.min_item_ratings)
    parser.add_argument("--train-ratio", type=float, default=defaults.train_ratio)
    parser.add_argument("--val-ratio", type=float, default=defaults.val_ratio)
    args = parser.parse_args(argv)

    spark = build_session("prepare")
    ratings = files.read_ratings_csv(spark, args.ratings)
    if args.rejects:
        ratings, rejects = files.read_ratings_checked(spark, args.ratings)
        rejects.write.mode("overwrite").parquet(args.rejects)
    prepare(
        ratings,
        files.read_movies_csv(spark, args.movies),
        args.output,
        PrepareConfig(args.min_user_ratings, args.min_item_ratings, args.train_ratio, args.val_ratio),
    )


if __name__ == "__main__":
    main()
