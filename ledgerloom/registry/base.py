"""Parameters and SQL fragments the registered queries share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.operators.partitions import PART, write_monthly
from ledgerloom.schemas import FACT
from ledgerloom.shared import scratch_namespace
from ledgerloom.sinks.tables import create_table

# "Now" of the archive jobs and the months they keep: days before 1999-12-01 are cold.
AS_OF = dt.date(2001, 12, 1)
KEEP_MONTHS = 24
# "Now" of the partition assignment: months 2000-02 … 2000-10 are premade.
PREMADE_AS_OF = dt.date(2000, 6, 15)
# The tenant that single-tenant queries ask for.
HEAD_COMPANY = 1

# Columns of a ledger row that are set in the test tables.
SHOWN = [
    "transaction_id", "transaction_dt", "company_id", "account_id",
    "operation_type", "amount", "currency_code", "custom_1", "custom_2",
]

ACC_DATA = """acc_data AS (
  SELECT l_orderkey * 8 + l_linenumber          AS transaction_id,
         CAST(l_shipdate AS DATE)               AS transaction_dt,
         s_nationkey                            AS company_id,
         p_type                                 AS account_id,
         ''                                     AS operation_type,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         'RUR'                                  AS currency_code,
         NULLIF(l_returnflag, 'N')              AS custom_1,
         l_linestatus                           AS custom_2
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                JOIN part     ON l_partkey = p_partkey)"""

DICTIONARIES = """dct_companies AS (
  SELECT n_nationkey AS company_id, n_name AS company_name, n_regionkey AS parent_company_id FROM nation),
dct_accounts AS (
  SELECT DISTINCT p_type AS account_id,
         CASE WHEN p_type IN ('ECONOMY','PROMO','STANDARD') THEN '1' ELSE '2' END AS parent_account_id,
         'account ' || p_type AS account_description FROM part)"""

ACC_AGGREGATE = """acc_aggregate AS (
  SELECT company_id, account_id, CAST(date_trunc('month', transaction_dt) AS DATE) AS period_dt,
         SUM(amount) AS amount, currency_code
  FROM acc_data GROUP BY 1, 2, 3, 5)"""

SHOWN_SQL = """transaction_id, transaction_dt, company_id, account_id, operation_type,
       CAST(amount AS DOUBLE) AS amount, currency_code, custom_1, custom_2"""

LABEL_SQL = "'p' || strftime(transaction_dt, '%Y%m01')"


def _parts_sql(inclusive: bool) -> str:
    """Month totals and code sums. A table of days says which months a day counts for:
    its own and, where the upper bound is closed, on a first the month before."""
    counted = "SELECT DISTINCT transaction_dt AS on_day, CAST(date_trunc('month', transaction_dt) AS DATE) AS in_month FROM acc_data"
    if inclusive:
        counted += " UNION SELECT transaction_dt, CAST(transaction_dt - INTERVAL 1 MONTH AS DATE) FROM acc_data WHERE day(transaction_dt) = 1"
    return f"""month_total AS (
  SELECT company_id, account_id, currency_code, CAST(date_trunc('month', transaction_dt) AS DATE) AS in_month,
         SUM(amount) AS total FROM acc_data GROUP BY 1, 2, 3, 4),
counted AS ({counted}),
code_sum AS (
  SELECT company_id, account_id, in_month, custom_1, SUM(amount) AS code_total
  FROM acc_data JOIN counted ON on_day = transaction_dt GROUP BY 1, 2, 3, 4)"""


def report_sql(inclusive: bool, where: str = "") -> str:
    """The report: month totals beside code sums, by names."""
    return f"""
WITH {ACC_DATA}, {DICTIONARIES},
{_parts_sql(inclusive)}
SELECT company_name, account_description, custom_1,
       CAST(total AS DOUBLE) AS amount_all, CAST(SUM(code_total) AS DOUBLE) AS amount_custom_1
FROM month_total JOIN code_sum USING (company_id, account_id, in_month)
JOIN dct_companies USING (company_id) JOIN dct_accounts USING (account_id)
{where}
GROUP BY company_name, account_description, custom_1, total
ORDER BY 1, 2, 3"""


def cells_sql() -> str:
    """Month totals beside code sums, by keys."""
    return f"""
WITH {ACC_DATA},
{_parts_sql(True)}
SELECT company_id, account_id, in_month AS period_dt, currency_code, custom_1,
       CAST(total AS DOUBLE) AS amount_all, CAST(code_total AS DOUBLE) AS amount_custom_1
FROM month_total JOIN code_sum USING (company_id, account_id, in_month)"""


def named_sql() -> str:
    """Month totals by company name and root account."""
    return f"""
WITH {ACC_DATA}, {DICTIONARIES},
{_parts_sql(False)}
SELECT company_name, parent_account_id, in_month AS period_dt, CAST(SUM(total) AS DOUBLE) AS amount
FROM month_total JOIN dct_companies USING (company_id) JOIN dct_accounts USING (account_id)
GROUP BY ALL"""


def shown(df: DataFrame) -> DataFrame:
    """Ledger rows as the oracle writes them."""
    return df.select(*SHOWN).withColumn("amount", F.col("amount").cast("double"))


_stored: dict[tuple[str, str], str] = {}


def stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as a table partitioned by month. It is written once per session
    and only read after that; jobs that change a table write their own."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = new_ledger(spark, sf_dir)
    return spark.table(_stored[key])


def stored_ledger_name(spark: SparkSession, sf_dir: str) -> str:
    stored_ledger(spark, sf_dir)
    return _stored[(spark.sparkContext.applicationId, sf_dir)]


def new_ledger(spark: SparkSession, sf_dir: str) -> str:
    """A freshly written monthly ledger table in a schema of its own."""
    name = create_table(spark, f"{scratch_namespace(spark)}.{FACT.name}", FACT, (PART,))
    write_monthly(bindings.fact(spark, sf_dir), name, "transaction_dt")
    return name
