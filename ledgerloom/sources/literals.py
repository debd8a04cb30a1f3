"""Literal rows and series."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import TableSpec


def literal_rows(
    spark: SparkSession,
    rows: Iterable[tuple],
    spec: TableSpec | T.StructType,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Rows written in the job itself, for the named columns in that order."""
    schema = spec.schema if isinstance(spec, TableSpec) else spec
    if columns is not None:
        schema = T.StructType([schema[name] for name in columns])
    return spark.createDataFrame(list(rows), schema)


def days_between(first: Column, last: Column) -> Column:
    """One row per day, both ends included."""
    return F.explode(F.sequence(first, last, F.expr("interval 1 day")))


def numbers(first: int, last: int) -> Column:
    """One row per integer, both ends included."""
    return F.explode(F.sequence(F.lit(first), F.lit(last)))
