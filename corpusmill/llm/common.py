"""Helpers shared by the training-data operators: written intermediates, text access."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.plans.runtime import discard, ship_code, written  # noqa: F401 (the operators take them from here)

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and leaves every other byte as it is.
LOWER_TABLE = bytes.maketrans(ASCII_UPPER.encode(), ASCII_LOWER.encode())


def text_or_empty(col: str | Column = "text") -> Column:
    """The whole text; null counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluates value once and hands it to body as a lambda variable, so that no later rule can inline and repeat it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """mapInArrow, with this package on the executors. A worker that waits for its next task gives back what it does not hold."""
    ship_code(df.sparkSession)

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def values_of(column: pa.Array, some: int = 500) -> Iterator:
    """The values of a column, made a few at a time: texts of a whole batch would be held twice."""
    for lo in range(0, len(column), some):
        yield from column.slice(lo, some).to_pylist()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
