from ratingloom.operators import cleaning

LAYOUT = "userId string, movieId string, rating string, timestamp string"
ROWS = [
    ("1", "10", "0.5", "5"),
    ("1", "11", "5.0", "5"),
    ("1", "12", "5.5", "5"),
    ("1", "13", "0.4", "5"),
    (None, "10", "3.0", "5"),
    ("2", None, "3.0", "5"),
    ("2", "10", None, "5"),
    ("2", "10", "3.0", None),
    ("2", "10", "NaN", "5"),
    ("x", "10", "3.0", "5"),
    ("2", "10", "3.0", "-5"),
]


def test_clean_keeps_the_range_ends_and_drops_bad_rows(spark):
    cleaned = cleaning.clean_ratings(spark.createDataFrame(ROWS, LAYOUT))
    assert cleaned.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "float"), ("timestamp", "bigint")]
    rows = {tuple(r) for r in cleaned.collect()}
    assert rows == {(1, 10, 0.5, 5), (1, 11, 5.0, 5), (2, 10, 3.0, -5)}


def test_report_counts_each_row_once(spark):
    row = cleaning.clean_report(spark.createDataFrame(ROWS, LAYOUT)).first()
    assert row.asDict() == {"total": 11, "missing": 6, "out_of_range": 2, "kept": 3, "removed": 8}


def test_empty_input(spark):
    empty = spark.createDataFrame([], LAYOUT)
    assert cleaning.clean_ratings(empty).count() == 0
    assert cleaning.clean_report(empty).first()["total"] == 0


def test_audits(spark):
    ratings = spark.createDataFrame(
        [(1, 1, 0.4), (1, 2, 5.5), (None, 2, 3.0), (1, None, 3.0), (1, 1, None)], "userId int, movieId int, rating double"
    )
    assert cleaning.null_ratings(ratings).first()[0] == 3
    assert cleaning.invalid_ratings(ratings).first()[0] == 2
    movies = spark.createDataFrame([(1, None), (2, "(no genres listed)"), (3, "Drama")], "movieId int, genres string")
    assert cleaning.missing_genres(movies).first()[0] == 2
