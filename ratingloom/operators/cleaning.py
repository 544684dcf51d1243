"""Cleaning of raw rating triples and the quality counts around it."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ratingloom.schemas import MAX_RATING, MIN_RATING, NO_GENRES, RATINGS


def _typed(ratings: DataFrame) -> DataFrame:
    # try_cast turns an unreadable field into null, so the null test sees it.
    return ratings.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RATINGS.fields])


def _has_gap() -> Column:
    gap = F.isnan("rating")
    for field in RATINGS.fields:
        gap = F.col(field.name).isNull() | gap
    return gap


def _in_range() -> Column:
    return F.col("rating").between(MIN_RATING, MAX_RATING)


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """Typed ratings without nulls, NaN and values outside the valid range."""
    return _typed(ratings).dropna("any").filter(_in_range())


def _report_counts() -> list[Column]:
    missing = _has_gap()
    return [
        F.count("*").alias("total"),
        F.count_if(missing).alias("missing"),
        F.count_if(~missing & ~_in_range()).alias("out_of_range"),
        F.count_if(~missing & _in_range()).alias("kept"),
    ]


def clean_report(ratings: DataFrame) -> DataFrame:
    """One row: total, missing, out-of-range, kept and removed counts, in one pass."""
    return _typed(ratings).agg(*_report_counts()).withColumn("removed", F.col("total") - F.col("kept"))


def clean_observed(ratings: DataFrame) -> tuple[DataFrame, Observation]:
    """``clean_ratings`` and the counts of ``clean_report`` but ``removed``, known once the result has been written."""
    seen = Observation("clean_report")
    return _typed(ratings).observe(seen, *_report_counts()).dropna("any").filter(_in_range()), seen


def null_rating() -> Column:
    """True where user, item or rating is missing; the time does not count."""
    return F.col("userId").isNull() | F.col("movieId").isNull() | F.col("rating").isNull()


def invalid_rating() -> Column:
    """True outside the valid range, null for a null rating."""
    return (F.col("rating") < MIN_RATING) | (F.col("rating") > MAX_RATING)


def missing_genre() -> Column:
    return F.col("genres").isNull() | (F.col("genres") == NO_GENRES)


def null_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.count_if(null_rating()).alias("null_ratings"))


def invalid_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.count_if(invalid_rating()).alias("invalid_ratings"))


def missing_genres(movies: DataFrame) -> DataFrame:
    return movies.agg(F.count_if(missing_genre()).alias("missing_genres"))
