"""Small helpers the operators share: stored intermediates, words of a text, bound values in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, stored

#: Fixed values of the contract: the white space between words.
SPACE = r"[\x20\x09-\x0D]+"

__all__ = ["SPACE", "bind", "discard", "free_name", "native_words", "partitions", "stored"]


def native_words(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, also where ``use`` repeats it in a lambda."""
    return F.transform(F.array(value), use)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
