from ratingloom.sources.files import (
    read_factors,
    read_movies_csv,
    read_movies_parquet,
    read_processed,
    read_ratings_csv,
    read_splits,
    read_tags_csv,
    write_csv,
    write_json_record,
    write_movies,
    write_processed,
)

__all__ = [
    "read_factors",
    "read_movies_csv",
    "read_movies_parquet",
    "read_processed",
    "read_ratings_csv",
    "read_splits",
    "read_tags_csv",
    "write_csv",
    "write_json_record",
    "write_movies",
    "write_processed",
]
