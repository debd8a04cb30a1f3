"""Dense surrogate keys 1 … N without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.shared import scratch_path

# Files whose counts are added up in one group before the groups are.
GROUP = 1024
# Rows of a slice that is sorted by one task, and the most slices.
SLICE_ROWS = 1 << 20
MOST_SLICES = 100_000
# Files up to which their offsets are replicated: 1 << 20 rows of a name and a number.
MOST_REPLICATED = 1 << 20


def file_offsets(stored: DataFrame) -> DataFrame:
    """Per written file the number of rows in the files before it, in the order of the
    tasks that wrote them. Two levels: prefix sums within groups of files, and over the
    groups, so no window holds more than a group's files or the groups."""
    name = F.col("_metadata.file_name").alias("_file")
    counts = stored.groupBy(name).agg(F.count("*").alias("_rows"))
    number = lambda pattern: F.regexp_extract("_file", pattern, 1).cast("bigint")
    # part-<task>-<job>-c<file of the task>
    files = counts.withColumns({"_task": number(r"^part-(\d+)"), "_nth": number(r"-c(\d+)\.")})
    files = files.withColumn("_group", F.floor(F.col("_task") / GROUP))
    earlier = lambda *by: Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    inside = files.withColumn("_inside", F.sum("_rows").over(earlier("_task", "_nth").partitionBy("_group")))
    groups = files.groupBy("_group").agg(F.sum("_rows").alias("_all"))
    before = groups.select("_group", F.sum("_all").over(earlier("_group")).alias("_before"))
    zero = F.lit(0)
    return inside.join(before, "_group").select("_file", (F.coalesce("_inside", zero) + F.coalesce("_before", zero)).alias("_offset"))


def dense_key(
    df: DataFrame,
    name: str,
    order_by: list[str] | None = None,
    start: int | Column = 0,
    stage: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Number the rows ``start + 1 … start + N`` without gaps.

    With ``order_by`` the numbers follow that order. The rows are range-partitioned by
    these columns and, where their values are equal, by a hash of the row, so a value that
    all rows share is spread as well. There is a slice for every ``slice_rows`` rows, by
    count, whatever the session's number of partitions. Without ``order_by`` no row is
    shuffled. The rows are written once, and a row's number is its
    place in its file plus the rows of the files before it: as they lie in storage, they
    keep their numbers however often a task runs again.
    """
    spark = df.sparkSession
    if order_by:
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        slices = max(1, min(MOST_SLICES, -(-df.count() // slice_rows)))
        df = df.repartitionByRange(slices, *order_by, tie).sortWithinPartitions(*order_by, tie)
    place = stage or scratch_path(spark, "dense-key")
    df.write.mode("overwrite").parquet(place)
    stored = spark.read.schema(df.schema).parquet(place)
    offsets = file_offsets(stored)
    if len(stored.inputFiles()) <= MOST_REPLICATED:
        offsets = F.broadcast(offsets)
    placed = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    base = start if isinstance(start, Column) else F.lit(start)
    number = (base + F.col("_offset") + F.col("_row") + 1).cast("bigint").alias(name)
    return placed.join(offsets, "_file").select(number, *[F.col(f"`{c}`") for c in df.columns])


def continued_key(df: DataFrame, name: str, existing: DataFrame, **options) -> DataFrame:
    """Dense key that goes on after the largest key already given out."""
    last = existing.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    return dense_key(df, name, start=last, **options)
