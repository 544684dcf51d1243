"""CSV, Parquet and JSON sources and sinks.

Schemas are always declared, so no read spends a pass on inference.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom import schemas

# Column that holds the text of a line that does not fit its layout.
_LINE = "_corrupt_record"
SPLITS = ("train", "validation", "test")


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # escape='"' reads a doubled quote inside a quoted field as one quote.
    return spark.read.schema(schema).csv(path, header=True, escape='"', mode="PERMISSIVE")


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rating triples with time; a field that is not a number becomes null."""
    return _read_csv(spark, path, schemas.RATINGS)


def read_ratings_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The ratings of well-formed lines, and the rejected lines."""
    return _read_checked(spark, path, schemas.RATINGS)


def _read_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of the lines that fit ``schema``, and ``file, line, reason`` of those that do not.

    A line fits if it has one field per column and every field is empty or of the
    column's type. ``line`` is its text; ``reason`` names the first field that is
    wrong, or tells that there are too few or too many. Either result reads the
    files on its own and parses whole lines, whatever columns are asked for.
    Empty lines are none.
    """
    # No separator and no quotes: a line is one field, and each file's header is left out.
    raw = spark.read.schema("line string").csv(path, header=True, sep="\x01", quote="", escape="")
    raw = raw.select("line", F.col("_metadata.file_path").alias("file")).filter(F.trim("line") != "")
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}

    def layout(fields: list[T.StructField]) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    mark = T.StructField(_LINE, T.StringType())
    lines = raw.withColumn("row", F.from_csv("line", layout([*schema.fields, mark]), options))
    wrong = F.col("row")[_LINE].isNotNull()

    # The same line as text, with room for one field more.
    texts = [T.StructField(f"_{i}", T.StringType()) for i in range(len(schema.fields) + 1)]
    reason = F.lit("malformed")
    for i, field in reversed(list(enumerate(schema.fields))):
        text = F.col("texts")[f"_{i}"]
        unreadable = text.isNotNull() & text.try_cast(field.dataType).isNull()
        reason = F.when(unreadable, f"{field.name} is no {field.dataType.simpleString()}").otherwise(reason)
    count = len(schema.fields)
    full = F.col("texts")[_LINE].isNull()
    reason = F.when(full | F.col("texts")[f"_{count}"].isNotNull(), f"more than {count} fields").otherwise(reason)
    short = F.from_csv("line", layout([*texts[:count], mark]), options)[_LINE].isNotNull() & ~full
    rejects = (
        lines.filter(wrong)
        .withColumn("texts", F.from_csv("line", layout([*texts, mark]), options))
        .withColumn("short", short & F.col("texts")[f"_{count}"].isNull())
        .select("file", "line", F.when(F.col("short"), f"fewer than {count} fields").otherwise(reason).alias("reason"))
    )
    return lines.filter(~wrong).select("row.*").drop(_LINE), rejects


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.MOVIES)


def read_tags_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schemas.TAGS)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header and doubled quotes, as the readers above expect."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_processed(with_split: DataFrame, folder: str) -> None:
    """Indexed ratings in one pass; ``split`` is a partition column, so reads prune.

    The table serves both as the processed ratings and as the three splits.
    """
    with_split.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/ratings_processed")


def write_clustered(stored: DataFrame, folder: str, files: int) -> None:
    """``ratings_processed`` with the ratings of a user side by side, in about ``files`` files.

    ``stored`` is a written table of indexed ratings with ``split``, as range
    partitioning looks at it twice. Rows are in ranges of split and user and
    sorted by user, item and time, so that each file and row group holds few users and a
    filter by user reads little. A user with very many ratings is spread over
    several files by item.
    """
    order = ["split", "user_idx", "item_idx", "timestamp"]
    ranged = stored.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/ratings_processed")


def _processed_with_split(spark: SparkSession, folder: str) -> DataFrame:
    layout = T.StructType(schemas.INDEXED.fields + [T.StructField("split", T.StringType())])
    return spark.read.schema(layout).parquet(f"{folder}/ratings_processed")


def read_processed(spark: SparkSession, folder: str, with_split: bool = False) -> DataFrame:
    table = _processed_with_split(spark, folder)
    return table if with_split else table.drop("split")


def read_splits(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One DataFrame per split, each reading only its own part of the table."""
    table = _processed_with_split(spark, folder)
    return {name: table.filter(F.col("split") == name).drop("split") for name in SPLITS}


def write_index(index: DataFrame, folder: str, side: str) -> None:
    """``user`` or ``item`` index: source id, dense id and number of ratings."""
    index.write.mode("overwrite").parquet(f"{folder}/{side}_index")


def read_index(spark: SparkSession, folder: str, side: str) -> DataFrame:
    return spark.read.schema(schemas.USER_INDEX if side == "user" else schemas.ITEM_INDEX).parquet(f"{folder}/{side}_index")


def write_movies(movies: DataFrame, folder: str) -> None:
    movies.write.mode("overwrite").parquet(f"{folder}/movies")


def read_movies_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(schemas.MOVIES).parquet(f"{folder}/movies")


def read_factors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FACTORS).parquet(path)


def record(spark: SparkSession, values: dict[str, int]) -> DataFrame:
    """One row of whole numbers."""
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{name} long" for name in values))


def write_json_record(record: DataFrame, path: str) -> None:
    """JSON lines for a report of a few rows (statistics, metrics, metadata)."""
    record.coalesce(1).write.mode("overwrite").json(path)
