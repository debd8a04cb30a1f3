"""Checks for the constraints Spark records but does not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often. Null key parts count too."""
    return df.groupBy(*key).agg(F.count("*").alias("cnt")).filter("cnt > 1")


def _tall(row: DataFrame, names: list[str], value: str) -> DataFrame:
    """One wide row of per-column results as one row per column."""
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias(value)) for n in names]
    return row.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _tall(counts, columns, "null_cnt")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Longest text per column, its limit, and the rows above it, in one pass."""
    names = list(limits)
    row = df.agg(
        *[
            F.struct(
                F.coalesce(F.max(F.char_length(n)), F.lit(0)).cast("bigint").alias("max_length"),
                F.lit(limit).cast("bigint").alias("length_limit"),
                F.count_if(F.char_length(n) > limit).alias("violations"),
            ).alias(n)
            for n, limit in limits.items()
        ]
    )
    return _tall(row, names, "r").select("column_name", "r.*")


def window_check(df: DataFrame, day: str, low, high) -> DataFrame:
    """First day, last day and rows of a half-open day range."""
    inside = (F.col(day) >= F.lit(low)) & (F.col(day) < F.lit(high))
    return df.filter(inside).agg(
        F.min(day).alias("mindt"), F.max(day).alias("maxdt"), F.count("*").alias("cnt")
    )


def conservation(parts: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Rows per group in each named dataset, side by side. The datasets are put one
    after the other and counted in one pass, so no counts have to be joined."""
    tagged = [df.select(*by, F.lit(name).alias("_name")) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy(*by).agg(
        *[F.count_if(F.col("_name") == name).alias(f"{name}_rows") for name in parts]
    )
