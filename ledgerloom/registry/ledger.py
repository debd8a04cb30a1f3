"""Ledger queries: rollup, report, tenants, hot and cold, keys and audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.functions import analytics
from ledgerloom.functions.periods import cutoff, half_open, month_start, months_interval, shift_months
from ledgerloom.functions.tokens import ADDEND, DAY_STEP, MASK, REPEAT_STEP, ROUNDS, draw_rounds
from ledgerloom.operators import audit
from ledgerloom.operators.dictionary import replicate_if_small
from ledgerloom.operators.keys import continued_key, dense_key
from ledgerloom.operators.rollup import monthly_rollup, report
from ledgerloom.operators.union import filtered_view, full_view
from ledgerloom.plans.ledger import DRAWS, day_grid, generate, generated_rows
from ledgerloom.registry import register
from ledgerloom.registry.base import (
    ACC_AGGREGATE, ACC_DATA, AS_OF, DICTIONARIES, HEAD_COMPANY, KEEP_MONTHS, LABEL_SQL, SHOWN,
    SHOWN_SQL, named_sql, report_sql, shown, stored_ledger,
)
from ledgerloom.schemas import FACT

CUTOFF = cutoff(AS_OF, KEEP_MONTHS)
SEED = 42


# --- rollup and report -------------------------------------------------------

@register("ledger_monthly_rollup", f"""
WITH {ACC_DATA}, {ACC_AGGREGATE}
SELECT company_id, account_id, period_dt, CAST(amount AS DOUBLE) AS amount, currency_code
FROM acc_aggregate""")
def ledger_monthly_rollup(spark, sf):
    totals = monthly_rollup(bindings.fact(spark, sf))
    return totals.withColumn("amount", F.col("amount").cast("double"))


@register("ledger_named_rollup", named_sql())
def ledger_named_rollup(spark, sf):
    """Monthly totals by company name and root account; a dictionary is replicated
    if its size allows it."""
    companies = replicate_if_small(bindings.companies(spark, sf).select("company_id", "company_name"))
    accounts = replicate_if_small(bindings.accounts(spark, sf).select("account_id", "parent_account_id"))
    named = monthly_rollup(bindings.fact(spark, sf)).join(companies, "company_id").join(accounts, "account_id")
    return named.groupBy("company_name", "parent_account_id", "period_dt").agg(
        F.sum("amount").cast("double").alias("amount")
    )


MONTH = "WHERE company_id = 5 AND parent_account_id = '1' AND in_month = DATE '1998-03-01'"


def _report(spark, sf, **options):
    rows = bindings.fact(spark, sf)
    answer = report(rows, bindings.companies(spark, sf), bindings.accounts(spark, sf), **options)
    return answer.select(
        "company_name", "account_description", "custom_1",
        F.col("amount_all").cast("double").alias("amount_all"),
        F.col("amount_custom_1").cast("double").alias("amount_custom_1"),
    )


@register("ledger_report_inclusive", report_sql(inclusive=True))
def ledger_report_inclusive(spark, sf):
    return _report(spark, sf)


@register("ledger_report_half_open", report_sql(inclusive=False))
def ledger_report_half_open(spark, sf):
    return _report(spark, sf, inclusive=False)


@register("ledger_report_month", report_sql(inclusive=True, where=MONTH))
def ledger_report_month(spark, sf):
    return _report(spark, sf, company_id=5, parent_account="1", period=dt.date(1998, 3, 1))


@register("ledger_report_month_half_open", report_sql(inclusive=False, where=MONTH))
def ledger_report_month_half_open(spark, sf):
    return _report(
        spark, sf, inclusive=False, company_id=5, parent_account="1", period=dt.date(1998, 3, 1)
    )


# --- tenants -----------------------------------------------------------------

@register("ledger_tenant_rows", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data WHERE company_id = {HEAD_COMPANY}""")
def ledger_tenant_rows(spark, sf):
    """Rows of one tenant from the stored ledger, whose files are sorted by tenant."""
    return shown(stored_ledger(spark, sf).filter(F.col("company_id") == HEAD_COMPANY))


@register("ledger_tenant_count", f"""
WITH {ACC_DATA} SELECT COUNT(*) AS cnt FROM acc_data WHERE company_id = {HEAD_COMPANY}""")
def ledger_tenant_count(spark, sf):
    rows = stored_ledger(spark, sf).filter(F.col("company_id") == HEAD_COMPANY)
    return rows.agg(F.count("*").alias("cnt"))


# --- hot and cold ------------------------------------------------------------

@register("ledger_cold_rows", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data
WHERE transaction_dt < date_trunc('month', DATE '{AS_OF}') - INTERVAL {KEEP_MONTHS} MONTH""")
def ledger_cold_rows(spark, sf):
    limit = shift_months(month_start(F.lit(AS_OF)), -KEEP_MONTHS)
    return shown(bindings.fact(spark, sf).filter(F.col("transaction_dt") < limit))


@register("ledger_hot_rows", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data
WHERE transaction_dt >= date_trunc('month', DATE '{AS_OF}') - INTERVAL {KEEP_MONTHS} MONTH""")
def ledger_hot_rows(spark, sf):
    limit = shift_months(month_start(F.lit(AS_OF)), -KEEP_MONTHS)
    return shown(bindings.fact(spark, sf).filter(F.col("transaction_dt") >= limit))


@register("ledger_cold_check", f"""
WITH {ACC_DATA}, per_day AS (
  SELECT transaction_dt AS on_day, COUNT(*) AS n FROM acc_data
  WHERE {LABEL_SQL} = 'p{cutoff(AS_OF, KEEP_MONTHS + 1):%Y%m01}' GROUP BY 1)
SELECT MIN(on_day) AS mindt, MAX(on_day) AS maxdt, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS cnt FROM per_day""")
def ledger_cold_check(spark, sf):
    last = cutoff(AS_OF, KEEP_MONTHS + 1)
    return audit.window_check(bindings.fact(spark, sf), "transaction_dt", last, CUTOFF)


def _parts(spark, sf):
    """Hot and cold rows; the last cold month is still in the hot part."""
    rows = bindings.fact(spark, sf).select(*SHOWN)
    hot = rows.filter(F.col("transaction_dt") >= F.lit(cutoff(AS_OF, KEEP_MONTHS + 1)))
    return hot, rows.filter(F.col("transaction_dt") < F.lit(CUTOFF))


PARTS_SQL = f"""hot AS (
  SELECT * FROM acc_data WHERE transaction_dt >= DATE '{cutoff(AS_OF, KEEP_MONTHS + 1)}'),
cold AS (SELECT * FROM acc_data WHERE transaction_dt < DATE '{CUTOFF}'),
v_acc_data_full AS (SELECT * FROM hot UNION SELECT * FROM cold)"""


@register("ledger_union_view", f"""
WITH {ACC_DATA}, {PARTS_SQL} SELECT {SHOWN_SQL} FROM v_acc_data_full""")
def ledger_union_view(spark, sf):
    return shown(full_view(*_parts(spark, sf)))


@register("ledger_union_days", f"""
WITH {ACC_DATA}, {PARTS_SQL} SELECT {SHOWN_SQL} FROM v_acc_data_full
WHERE transaction_dt BETWEEN DATE '1999-11-30' AND DATE '1999-12-01'""")
def ledger_union_days(spark, sf):
    days = F.col("transaction_dt").between(F.lit(dt.date(1999, 11, 30)), F.lit(dt.date(1999, 12, 1)))
    return shown(full_view(*_parts(spark, sf)).filter(days))


@register("ledger_union_filtered", f"""
WITH {ACC_DATA}, {PARTS_SQL} SELECT {SHOWN_SQL} FROM (
  SELECT * FROM hot  WHERE transaction_dt BETWEEN DATE '1999-11-30' AND DATE '1999-12-01'
  UNION
  SELECT * FROM cold WHERE transaction_dt BETWEEN DATE '1999-11-30' AND DATE '1999-12-01') v""")
def ledger_union_filtered(spark, sf):
    days = F.col("transaction_dt").between(F.lit(dt.date(1999, 11, 30)), F.lit(dt.date(1999, 12, 1)))
    return shown(filtered_view(*_parts(spark, sf), days))


@register("ledger_union_last_cold_day", f"""
WITH {ACC_DATA}, {PARTS_SQL} SELECT {SHOWN_SQL} FROM v_acc_data_full
WHERE transaction_dt = (SELECT MAX(transaction_dt) FROM cold)""")
def ledger_union_last_cold_day(spark, sf):
    hot, cold = _parts(spark, sf)
    last = cold.agg(F.max("transaction_dt")).scalar()
    return shown(full_view(hot, cold).filter(F.col("transaction_dt") == last))


@register("ledger_union_first_rows", f"""
WITH {ACC_DATA}, {PARTS_SQL}
SELECT {SHOWN_SQL} FROM v_acc_data_full
WHERE transaction_dt BETWEEN DATE '1999-11-30' AND DATE '1999-12-01'
ORDER BY transaction_id, transaction_dt, company_id, account_id, v_acc_data_full.amount,
         custom_1 NULLS FIRST, custom_2 LIMIT 5""")
def ledger_union_first_rows(spark, sf):
    days = F.col("transaction_dt").between(F.lit(dt.date(1999, 11, 30)), F.lit(dt.date(1999, 12, 1)))
    rows = full_view(*_parts(spark, sf)).filter(days)
    order = ["transaction_id", "transaction_dt", "company_id", "account_id", "amount", "custom_1", "custom_2"]
    return shown(rows.orderBy(*order).limit(5))


@register("ledger_conservation", f"""
WITH {ACC_DATA}, {PARTS_SQL},
h AS (SELECT {LABEL_SQL} AS part, COUNT(*) AS n FROM hot GROUP BY 1),
c AS (SELECT {LABEL_SQL} AS part, COUNT(*) AS n FROM cold GROUP BY 1),
v AS (SELECT {LABEL_SQL} AS part, COUNT(*) AS n FROM v_acc_data_full GROUP BY 1),
a AS (SELECT {LABEL_SQL} AS part, COUNT(*) AS n FROM acc_data GROUP BY 1)
SELECT part, COALESCE(h.n, 0) AS hot_rows, COALESCE(c.n, 0) AS cold_rows,
       COALESCE(v.n, 0) AS view_rows, COALESCE(a.n, 0) AS source_rows
FROM h FULL JOIN c USING (part) FULL JOIN v USING (part) FULL JOIN a USING (part)""")
def ledger_conservation(spark, sf):
    """Hot, cold, view and source read from the stored ledger: its joins run once."""
    stored = stored_ledger(spark, sf).select(*SHOWN, "part")
    hot = stored.filter(F.col("transaction_dt") >= F.lit(cutoff(AS_OF, KEEP_MONTHS + 1)))
    cold = stored.filter(F.col("transaction_dt") < F.lit(CUTOFF))
    return audit.conservation(
        {"hot": hot, "cold": cold, "view": full_view(hot, cold), "source": stored}, ["part"]
    )


# --- generator ---------------------------------------------------------------

BOUNDS_SQL = """bounds AS (
  SELECT CAST(MIN(l_shipdate) AS DATE) AS first_day, CAST(MAX(l_shipdate) AS DATE) AS last_day FROM lineitem)"""

GRID_SQL = f"""{DICTIONARIES}, {BOUNDS_SQL},
grid AS (
  SELECT company_id, account_id, CAST(d.generate_series AS DATE) AS transaction_dt, g.generate_series AS repeat
  FROM dct_companies, dct_accounts,
       (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS generate_series FROM bounds) d,
       generate_series(1, 10) g)"""


def _grid_input(spark, sf):
    """Dictionaries, and the first and last day of the ledger as scalar subqueries."""
    days = bindings.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    first, last = days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar()
    return bindings.companies(spark, sf), bindings.accounts(spark, sf), first, last


@register("ledger_grid_days", f"""
WITH {GRID_SQL}
SELECT company_id, account_id, CAST(date_trunc('month', transaction_dt) AS DATE) AS period_dt,
       COUNT(*) AS cnt, CAST(SUM(repeat) AS BIGINT) AS repeat_sum, MAX(transaction_dt) AS last_day
FROM grid GROUP BY 1, 2, 3""")
def ledger_grid_days(spark, sf):
    cells = day_grid(*_grid_input(spark, sf))
    return cells.groupBy(
        "company_id", "account_id", month_start(F.col("transaction_dt")).alias("period_dt")
    ).agg(
        F.count("*").alias("cnt"),
        F.sum("repeat").alias("repeat_sum"),
        F.max("transaction_dt").alias("last_day"),
    )


def _drawn_sql() -> str:
    """The mixing rounds, a table each: a word is made of the two before it."""
    tables, last, taken = [], "started", draw_rounds(DRAWS)
    words = {-1: "word_1", 0: "word_2"} | {i: f"x{i}" for i in range(1, len(ROUNDS) + 1)}
    for i, multiplier in enumerate(ROUNDS, start=1):
        tables.append(f"y{i} AS (SELECT *, ({words[i - 2]} * {multiplier} + {words[i - 1]} + {ADDEND}) & {MASK} AS z FROM {last})")
        draw = f", xor(z, z >> 15) / 2147483648.0::DOUBLE AS {taken[i]}" if i in taken else ""
        tables.append(f"x{i} AS (SELECT * EXCLUDE z, xor(z, z >> 15) AS x{i}{draw} FROM y{i})")
        last = f"x{i}"
    return ",\n".join(tables)


DRAWN_SQL = f"""{GRID_SQL},
hashed AS (SELECT *, md5(concat_ws('|', '{SEED}', CAST(company_id AS VARCHAR), account_id)) AS digest FROM grid),
started AS (
  SELECT *, ((CAST('0x' || substr(digest, 1, 8) AS BIGINT) & {MASK})
             + CAST(transaction_dt - DATE '1970-01-01' AS BIGINT) * {DAY_STEP}) & {MASK} AS word_1,
         ((CAST('0x' || substr(digest, 9, 8) AS BIGINT) & {MASK}) + repeat * {REPEAT_STEP}) & {MASK} AS word_2
  FROM hashed),
{_drawn_sql()},
first_codes(slot, code) AS (VALUES (0, 'A'), (1, 'B'), (2, 'C')),
second_codes(slot, code) AS (VALUES (6, 'XX'), (7, 'XX'), (8, 'XX'), (9, 'XX')),
acc_data AS (
  SELECT company_id, account_id, transaction_dt,
         CAST(round_even(r * 1000000, 0) * 100 AS DECIMAL(18,2)) AS amount,
         one.code AS custom_1, two.code AS custom_2, CAST(NULL AS VARCHAR) AS custom_3
  FROM x{len(ROUNDS)} LEFT JOIN first_codes one ON one.slot = floor(ar1 * 4)
             LEFT JOIN second_codes two ON two.slot = floor(ar2 * 10)
  WHERE ok > 0.25)"""


@register("ledger_generated", f"""
WITH {DRAWN_SQL}
SELECT company_id, account_id, CAST(date_trunc('month', transaction_dt) AS DATE) AS period_dt,
       custom_1, custom_2, COUNT(*) AS cnt, CAST(SUM(amount) AS DOUBLE) AS amount, COUNT(custom_3) AS rare_cnt
FROM acc_data GROUP BY 1, 2, 3, 4, 5""")
def ledger_generated(spark, sf):
    rows = generated_rows(day_grid(*_grid_input(spark, sf), seed=SEED))
    return rows.groupBy(
        "company_id", "account_id", month_start(F.col("transaction_dt")).alias("period_dt"), "custom_1", "custom_2"
    ).agg(
        F.count("*").alias("cnt"),
        F.sum("amount").cast("double").alias("amount"),
        F.count("custom_3").alias("rare_cnt"),
    )


@register("ledger_generated_keys", f"""
WITH {DRAWN_SQL}, n AS (SELECT COUNT(*) AS cnt FROM acc_data)
SELECT cnt, CAST(1 AS BIGINT) AS first_key, cnt AS last_key, cnt AS distinct_keys FROM n""")
def ledger_generated_keys(spark, sf):
    rows = generate(*_grid_input(spark, sf), SEED)
    return rows.agg(
        F.count("*").alias("cnt"),
        F.min("transaction_id").alias("first_key"),
        F.max("transaction_id").alias("last_key"),
        F.countDistinct("transaction_id").alias("distinct_keys"),
    )


@register("ledger_generated_append", f"""
WITH {DRAWN_SQL}, n AS (SELECT COUNT(*) AS cnt FROM acc_data WHERE company_id = {HEAD_COMPANY}),
m AS (SELECT MAX(l_orderkey * 8 + l_linenumber) AS last FROM lineitem)
SELECT cnt, last + 1 AS first_key, last + cnt AS last_key, cnt AS distinct_keys FROM n, m""")
def ledger_generated_append(spark, sf):
    """Rows of one company, with keys that go on after those of the ledger."""
    companies, accounts, first, last = _grid_input(spark, sf)
    head = companies.filter(F.col("company_id") == HEAD_COMPANY)
    lines = bindings.table(spark, sf, "lineitem")
    existing = lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"))
    return generate(head, accounts, first, last, SEED, existing=existing).agg(
        F.count("*").alias("cnt"),
        F.min("transaction_id").alias("first_key"),
        F.max("transaction_id").alias("last_key"),
        F.countDistinct("transaction_id").alias("distinct_keys"),
    )


@register("ledger_case_buckets", """
WITH draws AS (
  SELECT ((l_orderkey * 7 + l_linenumber * 131) % 1000) / 1000.0::DOUBLE AS r FROM lineitem),
codes AS (
  SELECT CASE floor(r * 4) WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE NULL END AS custom_1,
         CASE WHEN floor(r * 10) > 5 THEN 'XX' WHEN floor(r * 10) > 8 THEN 'ZZ' ELSE NULL END AS custom_2,
         CASE WHEN floor(r * 10) > 9 THEN 'RARE' END AS custom_3 FROM draws)
SELECT custom_1, custom_2, COUNT(*) AS cnt, COUNT(custom_3) AS rare_cnt FROM codes GROUP BY 1, 2""")
def ledger_case_buckets(spark, sf):
    number = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131) % 1000
    draws = bindings.table(spark, sf, "lineitem").select((number / F.lit(1000.0)).alias("r"))
    r = F.col("r")
    codes = draws.select(
        analytics.level_one(r).alias("custom_1"),
        analytics.level_two(r).alias("custom_2"),
        analytics.level_three(r).alias("custom_3"),
    )
    return codes.groupBy("custom_1", "custom_2").agg(
        F.count("*").alias("cnt"), F.count("custom_3").alias("rare_cnt")
    )


# --- keys --------------------------------------------------------------------

@register("ledger_surrogate_key", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS transaction_id, o_orderkey, o_custkey FROM orders""")
def ledger_surrogate_key(spark, sf):
    orders = bindings.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return dense_key(orders, "transaction_id", ["o_orderkey"])


@register("ledger_surrogate_key_offset", """
SELECT row_number() OVER (ORDER BY o_orderkey)
       + (SELECT MAX(l_orderkey * 8 + l_linenumber) FROM lineitem) AS transaction_id, o_orderkey
FROM orders""")
def ledger_surrogate_key_offset(spark, sf):
    lines = bindings.table(spark, sf, "lineitem")
    existing = lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"))
    orders = bindings.table(spark, sf, "orders").select("o_orderkey")
    return continued_key(orders, "transaction_id", existing, order_by=["o_orderkey"])


# --- audits ------------------------------------------------------------------

@register("ledger_pk_audit", f"""
WITH {ACC_DATA}
SELECT company_id, transaction_id, transaction_dt, COUNT(*) AS cnt FROM acc_data
GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def ledger_pk_audit(spark, sf):
    return audit.duplicate_keys(bindings.fact(spark, sf), list(FACT.key))


@register("ledger_id_audit", f"""
WITH {ACC_DATA}
SELECT transaction_id, COUNT(*) AS cnt FROM acc_data GROUP BY 1 HAVING COUNT(*) > 1""")
def ledger_id_audit(spark, sf):
    return audit.duplicate_keys(bindings.fact(spark, sf), ["transaction_id"])


NULL_COLUMNS = [
    "transaction_id", "transaction_dt", "company_id", "account_id", "amount", "currency_code",
    "operation_type", "custom_1", "custom_2",
]


@register("ledger_null_audit", f"WITH {ACC_DATA} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_cnt FROM acc_data" for c in NULL_COLUMNS
))
def ledger_null_audit(spark, sf):
    return audit.null_counts(bindings.fact(spark, sf), NULL_COLUMNS)


# A limit of six letters for the account code, which some codes exceed.
LENGTH_LIMITS = {"account_id": 6, "operation_type": 20, "currency_code": 3, "custom_1": 20, "custom_2": 20}


@register("ledger_length_audit", f"WITH {ACC_DATA} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(COALESCE(MAX(length({c})), 0) AS BIGINT) AS max_length,
        CAST({n} AS BIGINT) AS length_limit, COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations
        FROM acc_data""" for c, n in LENGTH_LIMITS.items()
))
def ledger_length_audit(spark, sf):
    return audit.length_violations(bindings.fact(spark, sf), LENGTH_LIMITS)


@register("ledger_month_rows", f"""
WITH {ACC_DATA}
SELECT company_id, CAST(date_trunc('month', transaction_dt) AS DATE) AS period_dt, COUNT(*) AS cnt FROM acc_data
WHERE transaction_dt >= DATE '1999-01-01' AND transaction_dt < DATE '1999-01-01' + INTERVAL '6' MONTH
GROUP BY 1, 2""")
def ledger_month_rows(spark, sf):
    rows = bindings.fact(spark, sf)
    low = F.lit(dt.date(1999, 1, 1))
    inside = half_open(F.col("transaction_dt"), low, low + months_interval(F.lit("6")))
    return rows.filter(inside).groupBy(
        "company_id", month_start(F.col("transaction_dt")).alias("period_dt")
    ).agg(F.count("*").alias("cnt"))
