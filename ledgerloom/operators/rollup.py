"""Monthly totals and the report that sets them against their detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.periods import month_start, shift_months

PAIR = ["company_id", "account_id"]
CELL = [*PAIR, "period_dt"]


def monthly_rollup(fact: DataFrame) -> DataFrame:
    """Sum of the amount per tenant, account, month and currency. The partial sums
    are built before the shuffle, so a tenant of any size sends one row per task."""
    return fact.groupBy(
        "company_id", "account_id", month_start(F.col("transaction_dt")).alias("period_dt"), "currency_code"
    ).agg(F.sum("amount").alias("amount"))


def matching_months(day: Column, inclusive: bool) -> Column:
    """Months whose range holds a day. With the closed upper bound, the first day
    of a month also belongs to the month before."""
    own = month_start(day)
    if not inclusive:
        return F.array(own)
    return F.when(day == own, F.array(own, shift_months(own, -1))).otherwise(F.array(own))


def monthly_cells(fact: DataFrame) -> DataFrame:
    """Sums per rollup cell and analytic code, the first day of the month apart.
    Rollup and detail both follow from these rows, so the fact is read once."""
    day = F.col("transaction_dt")
    return (
        fact.withColumn("month", month_start(day))
        .filter(F.col("month").isNotNull() & F.col("company_id").isNotNull() & F.col("account_id").isNotNull())
        .groupBy(
            "company_id", "account_id", "month", "currency_code", "custom_1",
            (day == F.col("month")).alias("first_day"),
        )
        .agg(F.sum("amount").alias("amount"))
    )


def rollup_of_cells(cells: DataFrame) -> DataFrame:
    """Monthly totals from cells. They are brought together by the three columns the
    report joins on: the sum and the join then need no further shuffle. A cell holds
    one row per currency and code, however many fact rows it stands for."""
    return (
        cells.select("company_id", "account_id", F.col("month").alias("period_dt"), "currency_code", "amount")
        .repartition(*CELL)
        .groupBy(*CELL, "currency_code")
        .agg(F.sum("amount").alias("amount"))
    )


def detail_of_cells(cells: DataFrame, inclusive: bool = True) -> DataFrame:
    """Detail sums per tenant, account, month and analytic code; with the closed
    bound the sums of a first day also count for the month before."""
    own = F.array("month")
    months = F.when(F.col("first_day"), F.array(F.col("month"), shift_months(F.col("month"), -1))).otherwise(own)
    return (
        cells.select(
            "company_id", "account_id", "custom_1", "amount",
            F.explode(months if inclusive else own).alias("period_dt"),
        )
        .repartition(*CELL)
        .groupBy(*CELL, "custom_1")
        .agg(F.sum("amount").alias("detail"))
    )


def _one_month(
    fact: DataFrame, rollup: DataFrame | None, period, inclusive: bool
) -> tuple[DataFrame, DataFrame]:
    """Totals and detail sums of a single month, each a range of days. Without a stored
    rollup both follow from one set of cell sums: the fact is read once."""
    day, low, high = F.col("transaction_dt"), F.lit(period), shift_months(F.lit(period), 1)
    within = fact.filter((day >= low) & (day <= high if inclusive else day < high))
    if rollup is not None:
        detail = within.groupBy(*PAIR, "custom_1").agg(F.sum("amount").alias("detail"))
        return rollup.filter(F.col("period_dt") == low), detail
    known = F.col("company_id").isNotNull() & F.col("account_id").isNotNull()
    cells = (
        within.filter(known)
        .groupBy(*PAIR, "currency_code", "custom_1", (day < high).alias("own_month"))
        .agg(F.sum("amount").alias("amount"))
    )
    # The condition is on the sums: a filter on the cells would make the two plans differ.
    totals = (
        cells.repartition(*PAIR)
        .groupBy(*PAIR, "currency_code")
        .agg(F.expr("sum(amount) FILTER (WHERE own_month)").alias("amount"), F.max("own_month").alias("held"))
        .filter("held")
        .drop("held")
    )
    detail = cells.repartition(*PAIR).groupBy(*PAIR, "custom_1").agg(F.sum("amount").alias("detail"))
    return totals, detail


def report(
    fact: DataFrame,
    companies: DataFrame,
    accounts: DataFrame,
    rollup: DataFrame | None = None,
    inclusive: bool = True,
    company_id: int | None = None,
    parent_account: str | None = None,
    period=None,
) -> DataFrame:
    """Rollup total beside the detail total of each analytic code.

    A rollup row meets the detail days from its month's first day up to the first
    day of the next month (closed, as published) or short of it (half open). The
    day range becomes an equi-join on the month: a day belongs to one or two months
    and is summed before the join, so neither the pairs of one cell nor a large
    tenant ever meet in one task. Without a stored ``rollup`` the totals come from
    the same sums as the detail, in one pass over the fact.
    """
    if company_id is not None:
        fact = fact.filter(F.col("company_id") == company_id)
        rollup = rollup.filter(F.col("company_id") == company_id) if rollup is not None else None
    if parent_account is not None:
        accounts = accounts.filter(F.col("parent_account_id") == parent_account)
        fact = fact.join(accounts.select("account_id"), "account_id", "left_semi")
    if period is not None:
        totals, detail = _one_month(fact, rollup, period, inclusive)
    else:
        cells = monthly_cells(fact)
        totals = rollup_of_cells(cells) if rollup is None else rollup
        detail = detail_of_cells(cells, inclusive)
    joined = totals.join(detail, CELL if period is None else PAIR)
    joined = joined.join(companies.select("company_id", "company_name"), "company_id").join(
        accounts.select("account_id", "account_description"), "account_id"
    )
    # Cells of several currencies may hold the same total: they fall into one row.
    return (
        joined.groupBy("company_name", "account_description", F.col("amount").alias("amount_all"), "custom_1")
        .agg(F.sum("detail").alias("amount_custom_1"))
        .orderBy(
            F.asc_nulls_last("company_name"),
            F.asc_nulls_last("account_description"),
            F.asc_nulls_last("custom_1"),
        )
    )
