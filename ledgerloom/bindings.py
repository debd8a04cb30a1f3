"""Ledger and weather datasets over the test tables (see FIXTURES.md, part B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import FACT, MEASURES, MONEY
from ledgerloom.sinks.tables import with_defaults


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as ledger operations: the supplier's nation is the tenant, the
    part type the account. The two joins carry no hint: small sides are replicated
    by their measured size, large ones shuffle with skew handling."""
    lines = table(spark, sf_dir, "lineitem")
    tenants = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("company_id")
    )
    kinds = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("account_id")
    )
    rows = lines.join(tenants, "l_suppkey").join(kinds, "l_partkey").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("transaction_dt"),
        "company_id",
        "account_id",
        F.lit("").alias("operation_type"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.lit("RUR").alias("currency_code"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("custom_1"),
        F.col("l_linestatus").alias("custom_2"),
    )
    return with_defaults(rows, FACT)


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("company_id"),
        F.col("n_name").alias("company_name"),
        F.col("n_regionkey").alias("parent_company_id"),
    )


# Part types that stand for accounts under the first root account.
FIRST_ROOT_TYPES = ["ECONOMY", "PROMO", "STANDARD"]


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select(F.col("p_type").alias("account_id")).distinct()
    return kinds.select(
        "account_id",
        F.when(F.col("account_id").isin(FIRST_ROOT_TYPES), "1").otherwise("2").alias("parent_account_id"),
        F.concat(F.lit("account "), "account_id").alias("account_description"),
    )


# Degrees between the mean of an observation and its extremes: three measures that differ.
SPAN = 2.5


def weather_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw observations: 'error' events have no city, and an index column
    is left over from the file's origin."""
    value = F.col("value")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("station_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("city_name"),
        F.col("ts").alias("date"),
        F.lit("winter").alias("season"),
        value.alias("avg_temp_c"),
        (value - SPAN).alias("min_temp_c"),
        (value + SPAN).alias("max_temp_c"),
        *[F.lit(None).cast("double").alias(m) for m in MEASURES[3:]],
        F.col("event_id").alias("__index_level_0__"),
    )
    return rows


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as loaded observations, every city named."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("station_id"),
        F.col("event_type").alias("city_name"),
        F.col("ts").alias("dt"),
        value.alias("avg_temp_c"),
        (value - SPAN).alias("min_temp_c"),
        (value + SPAN).alias("max_temp_c"),
    )
