"""Ledger jobs: generate, roll up, report, move to cold storage, read both parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import analytics
from ledgerloom.functions.periods import partition_label, cutoff, label_of
from ledgerloom.functions.tokens import cell_state, with_draws
from ledgerloom.operators import partitions
from ledgerloom.operators.dictionary import grid
from ledgerloom.operators.keys import continued_key, dense_key
from ledgerloom.operators.rollup import monthly_rollup, report
from ledgerloom.operators.union import full_view
from ledgerloom.schemas import FACT, ROLLUP
from ledgerloom.sinks.keyed import overwrite_partitions
from ledgerloom.sinks.tables import create_table, with_defaults
from ledgerloom.sources.listing import listed_sizes, listed_table
from ledgerloom.sources.literals import days_between, numbers


# The two words of a pair's counter state.
STATE = ("state_1", "state_2")


def day_grid(
    companies: DataFrame,
    accounts: DataFrame,
    first: dt.date | Column,
    last: dt.date | Column,
    per_day: int = 10,
    seed: int | None = None,
) -> DataFrame:
    """Companies × accounts × days × numbers, in as many tasks as the product is large:
    the pairs and the days are each cut into parts that meet in blocks. With a seed every
    pair carries the state its draws start from."""
    spark = companies.sparkSession
    counts = companies.count(), accounts.count()
    pairs = grid(companies.select("company_id"), accounts.select("account_id"), sizes=counts)
    if seed is not None:
        pairs = pairs.withColumns(dict(zip(STATE, cell_state(seed, F.col("company_id"), F.col("account_id")))))
    low, high = (d if isinstance(d, Column) else F.lit(d) for d in (first, last))
    # the bounds are fixed here: they may be subqueries, and the days are counted
    ends = spark.range(1).select(low.alias("low"), high.alias("high")).first()
    if not all(counts) or None in ends:
        width = (0, 1)
    else:
        width = (counts[0] * counts[1], (ends["high"] - ends["low"]).days + 1)
    days = spark.range(1).select(days_between(F.lit(ends["low"]), F.lit(ends["high"])).alias("transaction_dt"))
    cells = grid(pairs, days, weight=per_day, sizes=width)
    return cells.withColumn("repeat", numbers(1, per_day))


# The draws of a row: whether it is kept, its amount, and its three codes.
DRAWS = ["ok", "r", "ar1", "ar2", "ar3"]


def generated_rows(cells: DataFrame) -> DataFrame:
    """Draw an amount and analytic codes for every cell and keep three in four.
    The draws are a function of the cell, so a lost task gives the same rows again."""
    drawn = with_draws(cells, STATE, "transaction_dt", "repeat", DRAWS)
    return drawn.filter(analytics.kept(F.col("ok")) == 1).select(
        "transaction_dt",
        "company_id",
        "account_id",
        F.lit("").alias("operation_type"),
        analytics.random_amount(F.col("r")).alias("amount"),
        F.lit("RUR").alias("currency_code"),
        analytics.level_one(F.col("ar1")).alias("custom_1"),
        analytics.level_two(F.col("ar2")).alias("custom_2"),
        analytics.level_three(F.col("ar3")).alias("custom_3"),
    )


def generate(
    companies: DataFrame,
    accounts: DataFrame,
    first: dt.date | Column,
    last: dt.date | Column,
    seed: int,
    existing: DataFrame | None = None,
    per_day: int = 10,
) -> DataFrame:
    """A synthetic ledger with dense keys, continued after ``existing`` if given."""
    rows = generated_rows(day_grid(companies, accounts, first, last, per_day, seed))
    if existing is None:
        keyed = dense_key(rows, "transaction_id")
    else:
        keyed = continued_key(rows, "transaction_id", existing)
    return with_defaults(keyed, FACT)


def create_ledger(spark: SparkSession, namespace: str) -> tuple[str, str]:
    """Empty fact and rollup tables, partitioned by month."""
    fact = create_table(spark, f"{namespace}.{FACT.name}", FACT, (partitions.PART,))
    rollup = create_table(spark, f"{namespace}.{ROLLUP.name}", ROLLUP, (partitions.PART,))
    return fact, rollup


def _marks_table(rollup: str) -> str:
    return f"{rollup}_loaded"


def _marks(spark: SparkSession, fact: str) -> dict[str, str]:
    """The stored state of every partition of the fact, from a listing: a row a month."""
    sizes = listed_sizes(listed_table(spark, fact), [partitions.PART])
    return {r[partitions.PART]: r["mark"] for r in sizes.collect()}


def load_rollup(spark: SparkSession, fact: str, rollup: str) -> list[str]:
    """Bring the monthly totals up to date; return the labels of the months summed anew.

    The state of the fact's partitions at the last load lies in a table beside the rollup.
    Only months whose files have changed since are read, summed and overwritten, and
    months that the fact no longer holds go; so the load may run again at any time, also
    after a run that died: the state is noted last. Rows that wait in default belong to
    any month, so while there are such rows, or there were at the last load, a change of
    default means that all months are summed.
    """
    noted = _marks_table(rollup)
    if not spark.catalog.tableExists(noted):
        spark.sql(f"CREATE TABLE {noted} ({partitions.PART} string, mark string) USING parquet")
    now = _marks(spark, fact)  # before the rows are read: what comes in later is seen next time
    before = {r[partitions.PART]: r["mark"] for r in spark.table(noted).collect()}
    default = partitions.DEFAULT
    if now.get(default) != before.get(default):
        changed = sorted(set(now) - {default})
        wanted = None
    else:
        changed = sorted(p for p in now if p != default and now[p] != before.get(p))
        wanted = changed
    gone = set(before) - set(now) - {default}
    if wanted is None or changed or gone:
        spark.catalog.refreshTable(fact)
        rows = spark.table(fact)
        if wanted is not None:
            # a month whose partition went may still have rows in default
            again = sorted({*changed, *gone})
            own = rows.filter(F.col(partitions.PART).isin([*again, default]))
            own = own.filter(partition_label(F.col("transaction_dt")).isin(again))
        else:
            own, again = rows, None
        totals = monthly_rollup(own.drop(partitions.PART))
        labelled = totals.withColumn(partitions.PART, partition_label(F.col("period_dt")))
        overwrite_partitions(partitions.laid_out(labelled), rollup)
        spark.catalog.refreshTable(rollup)
        held = set(partitions.list_partitions(spark, rollup))
        stays = {r[partitions.PART] for r in labelled.select(partitions.PART).distinct().collect()} if gone or again is None else held
        left = held - stays if again is None else gone - stays
        partitions.drop_partitions(spark, rollup, sorted(left))
        changed = sorted(held - left) if again is None else changed
    fresh = spark.createDataFrame(sorted(now.items()), f"{partitions.PART} string, mark string")
    fresh.coalesce(1).write.insertInto(noted, overwrite=True)
    return changed


def month_report(
    spark: SparkSession,
    fact: str,
    rollup: str,
    companies: DataFrame,
    accounts: DataFrame,
    period: dt.date,
    inclusive: bool = True,
    **filters,
) -> DataFrame:
    """The report of one month from the stored tables. Only the month's partition of
    the rollup is read, and of the fact that one and (closed bound) the next."""
    days = partitions.read_days(spark.table(fact), "transaction_dt", period, cutoff(period, -1))
    totals = spark.table(rollup).filter(F.col(partitions.PART) == label_of(period))
    return report(
        days.drop(partitions.PART), companies, accounts, rollup=totals.drop(partitions.PART),
        inclusive=inclusive, period=period, **filters,
    )


def move_to_cold(
    spark: SparkSession, hot: str, cold: str, as_of: dt.date, months: int = 24, day: str = "transaction_dt"
) -> DataFrame:
    """Copy the months older than ``months`` to the archive, check every one of
    them, and drop from the hot table those that agree.

    A failed copy or check drops nothing, and the job may be run again at any
    point: rows the archive already holds are not copied a second time. Rows that
    wait in default are put into their months first, so none is left behind.
    Returns one row per month: rows copied, first and last day, and whether the
    month was dropped.
    """
    partitions.backfill(spark, hot, day)
    old = partitions.older_than(partitions.list_partitions(spark, hot), cutoff(as_of, months))
    moving = spark.table(hot).filter(F.col(partitions.PART).isin(old)).select(*FACT.columns, partitions.PART)
    check = partitions.copy_missing(moving, cold, day)
    # rows that came in while the copy ran would be dropped with their month
    spark.catalog.refreshTable(hot)
    left = spark.table(hot).filter(F.col(partitions.PART).isin(old))
    now = {r[partitions.PART]: tuple(r)[1:] for r in partitions.digest(left, list(FACT.columns), day).collect()}
    check = [c._replace(same=c.same and now.get(c.part) == c.mark) for c in check]
    partitions.drop_partitions(spark, hot, [c.part for c in check if c.same])
    schema = "part string, source_rows bigint, target_rows bigint, min_dt date, max_dt date, dropped boolean"
    return spark.createDataFrame([tuple(c)[:6] for c in check], schema)


def both_parts(spark: SparkSession, hot: str, cold: str, keyed: bool = False) -> DataFrame:
    """The reporting dataset over the hot and the cold table, each row once. It keeps
    the label column, so :func:`ledgerloom.operators.partitions.read_days` prunes both.

    ``keyed`` says that no table holds a row twice (its key is unique). Then a row can
    only repeat in a month that lies in both tables, which the catalog tells: those
    months, none after a finished move, are made distinct and all others are read
    without a shuffle."""
    named = [partitions.list_partitions(spark, t) for t in (hot, cold)]
    waits = [partitions.DEFAULT in labels for labels in named]
    hot_rows, cold_rows = (_in_months(spark.table(t), w) for t, w in zip((hot, cold), waits))
    if not keyed or any(waits):  # a waiting row may lie in any month of the other table
        return full_view(hot_rows, cold_rows)
    shared = sorted(set(named[0]) & set(named[1]))
    if not shared:
        return full_view(hot_rows, cold_rows, disjoint=True)
    both = F.col(partitions.PART).isin(shared)
    apart = full_view(hot_rows.filter(~both), cold_rows.filter(~both), disjoint=True)
    return apart.unionByName(full_view(hot_rows.filter(both), cold_rows.filter(both)))


def _in_months(rows: DataFrame, waits: bool, day: str = "transaction_dt") -> DataFrame:
    """The rows under the label of their month, those that wait in default as well: a
    row that waits here and lies in its month there is one row."""
    if not waits:
        return rows
    waiting = rows.filter(F.col(partitions.PART) == partitions.DEFAULT)
    relabelled = waiting.withColumn(partitions.PART, partition_label(F.col(day)))
    return rows.filter(F.col(partitions.PART) != partitions.DEFAULT).unionByName(relabelled)
