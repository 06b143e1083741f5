"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.session import scratch_folder

# ASCII blanks: everything else belongs to a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


class Scratch:
    """A folder for what one call has to write, where every executor reaches it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root = spark, scratch_folder(spark)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written as Parquet and read again: computed once, lineage cut."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_count(text: Column) -> Column:
    """Words of a text, null having none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns that an operator is about to add under the same name."""
    return df.drop(*names)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not use yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def power_of_two(number: float, least: int) -> int:
    """The smallest power of two that reaches a number and a lower bound."""
    size = least
    while size < number:
        size *= 2
    return size
