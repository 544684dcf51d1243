"""Exploration report over ratings, movies and tags."""

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.operators import profiling as p
from ratingloom.operators.cleaning import missing_genres
from ratingloom.session import build_session, durable, temporary_tables, wide_shuffles
from ratingloom.sources import files


def explore(ratings: DataFrame, movies: DataFrame, tags: DataFrame) -> dict[str, DataFrame]:
    """All tables of the report; ``ratings`` is scanned once and its groups stored.

    The groups are aggregated and sorted by ``grp`` for the write in tasks of a
    bounded share of ``ratings``, whatever the session's shuffle width.
    """
    with wide_shuffles(ratings):
        groups = durable(p.rating_groups(ratings), "rating-groups", partition_by="grp")
    users = groups.filter(p.in_set(p.USER)).select("userId", "num_ratings", "avg_rating")
    items = groups.filter(p.in_set(p.ITEM)).select("movieId", "num_ratings", "avg_rating")
    values = groups.filter(p.in_set(p.VALUE))
    whole = groups.filter(p.in_set(p.ALL))
    return {
        "totals": p.totals_from(groups),
        "table_counts": p.row_count("movies", movies).union(p.row_count("tags", tags)),
        "rating_distribution": values.select("rating", F.col("num_rows").alias("n")).orderBy("rating"),
        "rating_stats": whole.select("avg_rating", "std_rating", "min_rating", "max_rating"),
        "missing_ratings": whole.select("null_ratings", "invalid_ratings"),
        "user_activity_stats": p.activity_stats(users),
        "item_popularity_stats": p.activity_stats(items),
        "top_active_users": p.top_active_users(users),
        "top_rated_movies": p.top_rated_movies(items, movies),
        "cold_users": p.cold_share(users),
        "cold_items": p.cold_share(items),
        "missing_genres": missing_genres(movies),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Profile rating, movie and tag files")
    parser.add_argument("--ratings", required=True)
    parser.add_argument("--movies", required=True)
    parser.add_argument("--tags", required=True)
    parser.add_argument("--output", required=True, help="folder for one JSON report per table")
    args = parser.parse_args(argv)

    spark = build_session("explore")
    ratings = files.read_ratings_csv(spark, args.ratings)
    with wide_shuffles(ratings), temporary_tables(spark):
        report = explore(
            ratings,
            files.read_movies_csv(spark, args.movies),
            files.read_tags_csv(spark, args.tags),
        )
        for name, table in report.items():
            files.write_json_record(table, f"{args.output}/{name}")


if __name__ == "__main__":
    main()
