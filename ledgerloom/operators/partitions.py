"""Monthly partitions: assignment, layout, backfill, listing and retention.

A partitioned table has a text column ``part``: ``pYYYYMMDD`` for a month, or
``default`` for the rows whose month had no partition when they came in.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.periods import cutoff, label_month, label_of, month_start, partition_label
from ledgerloom.sinks.tables import append_rows, set_property, table_property

PART = "part"
DEFAULT = "default"
TENANT = "company_id"


def premade_window(as_of: dt.date, premake: int = 4) -> tuple[dt.date, dt.date]:
    """First and last month that have a partition before any data comes."""
    return cutoff(as_of, premake), cutoff(as_of, -premake)


def assigned_label(day: Column, as_of: dt.date, premake: int = 4) -> Column:
    """Label of the partition a row falls into."""
    first, last = premade_window(as_of, premake)
    inside = month_start(day).between(F.lit(first), F.lit(last))
    return F.when(inside, partition_label(day)).otherwise(F.lit(DEFAULT))


def laid_out(df: DataFrame) -> DataFrame:
    """Bring the rows of a partition together for few, full-sized files. REBALANCE
    splits a month that is too large for one task and merges small ones. Inside a file
    the rows are sorted by tenant, so that a filter on it skips row groups."""
    order = [c for c in (PART, TENANT) if c in df.columns]
    return df.hint("rebalance", F.col(PART)).sortWithinPartitions(*order)


def _dated(label: Column, day: str) -> Column:
    """A label, or an error for a row without a day: it belongs to no month, and no
    retention or backfill could ever place it."""
    missing = F.raise_error(F.lit(f"a row has no {day}")).cast("string")
    return F.when(F.col(day).isNull(), missing).otherwise(label)


def write_assigned(df: DataFrame, table: str, day: str, as_of: dt.date, premake: int = 4) -> None:
    """Insert rows as the database would: premade months, the rest to default."""
    append_rows(laid_out(df.withColumn(PART, _dated(assigned_label(F.col(day), as_of, premake), day))), table)


def write_monthly(df: DataFrame, table: str, day: str) -> None:
    """Insert rows straight into their monthly partitions."""
    append_rows(laid_out(df.withColumn(PART, _dated(partition_label(F.col(day)), day))), table)


def list_partitions(spark: SparkSession, table: str) -> list[str]:
    """Labels of a table's partitions, from the catalog (no data is read)."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(r["partition"].split("=", 1)[1] for r in rows)


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Enter partition folders the catalog does not know: a job that died after it
    had moved its files but before it had entered them leaves such folders."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def drop_partitions(spark: SparkSession, table: str, labels: list[str]) -> None:
    """Drop partitions in one catalog statement."""
    if labels:
        named = ", ".join(f"PARTITION ({PART}='{label}')" for label in labels)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named}")


def read_days(table: DataFrame, day: str, low: dt.date, high: dt.date) -> DataFrame:
    """Rows of a closed day range. The range on the day says nothing about the
    label, so the matching labels are added and other partitions are not read."""
    labels = F.col(PART).between(label_of(low), label_of(high)) | (F.col(PART) == DEFAULT)
    return table.filter(labels & F.col(day).between(F.lit(low), F.lit(high)))


def backfill_report(df: DataFrame, day: str, as_of: dt.date, premake: int = 4) -> DataFrame:
    """Rows that lie in default, per month they would be moved to, and in total."""
    waiting = df.filter(assigned_label(F.col(day), as_of, premake) == DEFAULT)
    counts = waiting.groupBy(partition_label(F.col(day)).alias("target")).agg(F.count("*").alias("n"))
    return (
        counts.rollup("target")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_moved"))
        .select(F.coalesce("target", F.lit("total")).alias("target"), "rows_moved")
    )


def digest(df: DataFrame, columns: list[str], day: str, by: str = PART) -> DataFrame:
    """Per partition: rows, first and last day, and two checksums of the contents that
    do not depend on the order of the rows. Each hash takes in, beside every value,
    whether it is null: a null alone leaves a hash unchanged, and a value that moved
    to another column would not be seen. All 64 bits count; decimals hold the sum of
    any number of rows a table can have."""
    marked = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    terms = [F.xxhash64(F.lit(seed), *marked).cast("decimal(28,0)") for seed in (1, 2)]
    return df.groupBy(by).agg(
        F.count("*").alias("row_cnt"),
        F.min(day).alias("min_dt"),
        F.max(day).alias("max_dt"),
        F.sum(terms[0]).alias("checksum"),
        F.sum(terms[1]).alias("checksum_2"),
    )


class MonthCheck(NamedTuple):
    """What was to be copied into a partition and what lies there now."""

    part: str
    source_rows: int
    target_rows: int
    min_dt: dt.date | None
    max_dt: dt.date | None
    same: bool
    mark: tuple = ()  # the digest of what was copied


def _digests(df: DataFrame, columns: list[str], day: str) -> dict[str, tuple]:
    """Digests by label: one row per month, which bounds what the driver holds."""
    return {r[PART]: tuple(r)[1:] for r in digest(df, columns, day).collect()}


def _sum(one: tuple | None, other: tuple) -> tuple:
    """The digest of two sets of rows together."""
    if one is None:
        return other
    days = [[d for d in pair if d is not None] for pair in zip(one[1:3], other[1:3])]
    first, last = min(days[0], default=None), max(days[1], default=None)
    return (one[0] + other[0], first, last, *(a + b for a, b in zip(one[3:], other[3:])))


def copy_all(source: DataFrame, table: str, day: str) -> list[MonthCheck]:
    """Append every row of ``source`` (with its target label), also rows equal to rows
    the table holds, and check that each label's digest is the sum of what lay there
    and what came."""
    spark = source.sparkSession
    columns = [c for c in source.columns if c != PART]
    recover_partitions(spark, table)
    wanted = _digests(source, columns, day)
    labels = sorted(wanted)
    if not labels:
        return []
    target = spark.table(table).select(*source.columns).filter(F.col(PART).isin(labels))
    held = _digests(target, columns, day) if set(labels) & set(list_partitions(spark, table)) else {}
    append_rows(laid_out(source), table)
    target = spark.table(table).select(*source.columns).filter(F.col(PART).isin(labels))
    found = _digests(target, columns, day)
    checks = []
    for label in labels:
        now = found.get(label, (0, None, None))
        same = now == _sum(held.get(label), wanted[label])
        checks.append(MonthCheck(label, wanted[label][0], now[0], now[1], now[2], same, wanted[label]))
    return checks


def copy_missing(source: DataFrame, table: str, day: str) -> list[MonthCheck]:
    """Append the rows of ``source`` (with their target label) that the table does
    not hold yet, and check every label against the table.

    It can be run again after a crash at any point: only labels the table already
    has are compared row by row (as multisets), all others are copied as they are
    and compared by their digests.
    """
    spark = source.sparkSession
    columns = [c for c in source.columns if c != PART]
    recover_partitions(spark, table)
    known = set(list_partitions(spark, table))
    wanted = _digests(source, columns, day)
    labels = sorted(wanted)
    if not labels:
        return []
    shared = [label for label in labels if label in known]
    in_shared = F.col(PART).isin(shared)
    moving = source
    if shared:
        held = spark.table(table).select(*source.columns).filter(in_shared)
        moving = source.filter(~in_shared).unionByName(source.filter(in_shared).exceptAll(held))
    append_rows(laid_out(moving), table)

    target = spark.table(table).select(*source.columns).filter(F.col(PART).isin(labels))
    found = _digests(target, columns, day)
    missing = set()
    if shared:
        # The table may rightly hold more than was copied, but nothing may be missing.
        left_over = source.filter(in_shared).exceptAll(target.filter(in_shared))
        missing = {r[PART] for r in left_over.select(PART).distinct().collect()}
    checks = []
    for label in labels:
        rows, first, last = found.get(label, (0, None, None))[:3]
        same = label not in missing if label in shared else found.get(label) == wanted[label]
        checks.append(MonthCheck(label, wanted[label][0], rows, first, last, same, wanted[label]))
    return checks


# Table property: a backfill has begun; the rows that waited in default then, and those
# that lay in their months.
RUNNING = "ledgerloom.backfill_rows"


def _rows_in(spark: SparkSession, table: str, labels: list[str]) -> int:
    """Rows of some partitions, from the file footers."""
    return spark.table(table).filter(F.col(PART).isin(labels)).count()


def backfill(spark: SparkSession, table: str, day: str) -> list[MonthCheck]:
    """Move the rows out of default into monthly partitions, making those that are
    missing. Default is dropped only when every row has been found again.

    Rows equal to rows of their month are rows of their own and are moved as well. A
    table property marks a run that has begun: only a run that finds the mark of one
    that died takes equal rows for rows moved already. It drops default only if the
    months hold at least what lay in them when the first run began and what waits now:
    rows that came in between, to default or to a month, do not stand in its way.
    """
    if DEFAULT not in list_partitions(spark, table):
        return []
    waiting = spark.table(table).filter(F.col(PART) == DEFAULT).withColumn(PART, partition_label(F.col(day)))
    labels = [r[PART] for r in waiting.select(PART).distinct().collect()]  # a row per month
    count = _rows_in(spark, table, [DEFAULT])
    mark = table_property(spark, table, RUNNING)
    if mark is None:
        held = _rows_in(spark, table, labels)
        set_property(spark, table, RUNNING, f"{count},{held}")
        check = copy_all(waiting, table, day)
    else:
        held = int(mark.split(",")[1])
        check = copy_missing(waiting, table, day)
    lost = [c.part for c in check if not c.same]
    if lost or _rows_in(spark, table, labels) < held + count:
        raise RuntimeError(f"backfill of {table} is incomplete, default is kept: {lost}")
    drop_partitions(spark, table, [DEFAULT])
    set_property(spark, table, RUNNING, None)
    return check


def older_than(labels: list[str], limit: dt.date) -> list[str]:
    return [label for label in labels if label != DEFAULT and label_month(label) < limit]


def apply_retention(
    spark: SparkSession, table: str, as_of: dt.date, months: int, day: str = "transaction_dt"
) -> list[str]:
    """Drop the monthly partitions older than ``months``; return their labels. Rows that
    wait in default are put into their months first, so that old ones go as well."""
    backfill(spark, table, day)
    gone = older_than(list_partitions(spark, table), cutoff(as_of, months))
    drop_partitions(spark, table, gone)
    return gone
