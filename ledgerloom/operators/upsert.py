"""Keyed tables keep one row per key: the one loaded last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: list[str], loaded: list[str]) -> DataFrame:
    """One row per key, the one with the largest load order. It is an aggregate,
    not a window: each task keeps one candidate per key before the shuffle, so a
    key that holds a third of the rows costs no more than any other."""
    rest = [c for c in df.columns if c not in key]
    # a struct is never null, so rows without a load order count, as the earliest;
    # a hash of the row decides ties
    order = F.struct(*loaded, F.xxhash64(*rest))
    last = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select(*key, "_last.*").select(*df.columns)


def upsert(table: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the table after the batch replaced or added its keys."""
    both = table.withColumn("_load", F.lit(0)).unionByName(batch.withColumn("_load", F.lit(1)))
    return keep_last(both, key, ["_load"]).drop("_load")
