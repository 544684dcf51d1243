"""Column expressions that several operators share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
BREAK = r"[\x20\x09-\x0D]+"
NO_BREAK = r"[^\x20\x09-\x0D]"


def word_array(text: Column) -> Column:
    """The words of ``text`` in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def documents(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns of a table cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{name}`") for name in names])
