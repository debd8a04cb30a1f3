"""Dictionary joins: replicate a side only when its size is known to be small."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stored bytes; rows in memory may take a few times as much.
REPLICATE_LIMIT = 32 * 1024 * 1024


def size_estimate(df: DataFrame) -> int:
    """Bytes the optimizer expects a plan to give: the (compressed) file sizes for a
    scan, an upper bound for filters and aggregates. Joins multiply both sides, and a
    catalog table without statistics counts as endless: neither passes as small."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def replicate_if_small(df: DataFrame, limit: int = REPLICATE_LIMIT) -> DataFrame:
    """Mark a table for replication to every executor if the optimizer's size
    estimate is within ``limit`` bytes. A larger table is returned unmarked: the
    join then shuffles by key, and AQE splits its skewed partitions."""
    return F.broadcast(df) if size_estimate(df) <= limit else df


# Rows of a product that one task should make, and the fewest worth a task of their own.
TASK_ROWS = 1 << 21
LEAST_ROWS = 1 << 16
MOST_BLOCKS = 1 << 20


def fragments(left: int, right: int, rows: int, task_rows: int = TASK_ROWS, least_tasks: int = 1) -> tuple[int, int]:
    """Into how many parts each side of a product is cut, so that a block of one part each
    makes about ``task_rows`` of all ``rows``. The parts are made of near equal size: then
    the copies of both sides together are fewest. A side is cut at most into its rows."""
    wanted = max(-(-rows // task_rows), min(least_tasks, rows // LEAST_ROWS), 1)
    wanted = min(wanted, MOST_BLOCKS, max(1, left * right))
    own = min(left, max(1, math.isqrt(wanted * left // max(1, right))))
    other = min(right, -(-wanted // max(1, own)))
    return max(1, min(left, -(-wanted // max(1, other)))), max(1, other)


def grid(left: DataFrame, right: DataFrame, weight: int = 1, sizes: tuple[int, int] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Every row of ``left`` with every row of ``right`` (their columns differ).

    Fragment and replicate: both sides are counted, cut into parts, and every pair of parts
    meets in a block, so a pair of rows meets exactly once. A left row is copied once per
    part of the right side and the other way round. The number of blocks, and with it that
    of the tasks, follows the size of the product; ``weight`` is the number of rows that
    later steps make of a pair. ``sizes`` are the counts, where they are known.
    """
    count, other = sizes or (left.count(), right.count())
    least = left.sparkSession.sparkContext.defaultParallelism
    rows, columns = fragments(count, other, count * other * weight, task_rows, least)
    # A part has to be the same if a task runs again, so it goes by the hash of the row.
    part = lambda df, n: F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = (F.col("_row_part") * columns + F.col("_column_part")).cast("int")
    cut = left.withColumn("_row_part", part(left, rows)).withColumn("_column_part", each(columns))
    other_cut = right.withColumn("_column_part", part(right, columns)).withColumn("_row_part", each(rows))
    blocks = [df.withColumn("_block", block).drop("_row_part", "_column_part") for df in (cut, other_cut)]
    dealt = [df.repartitionById(rows * columns, F.col("_block")) for df in blocks]
    return dealt[0].join(dealt[1], "_block").drop("_block")
