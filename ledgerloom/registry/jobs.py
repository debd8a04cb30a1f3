"""Jobs that write tables: backfill, cold move, retention, loads and reloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.functions.periods import cutoff, partition_label
from ledgerloom.operators import partitions
from ledgerloom.plans import weather
from ledgerloom.plans.ledger import both_parts, create_ledger, load_rollup, month_report, move_to_cold
from ledgerloom.registry import register
from ledgerloom.registry.base import (
    ACC_AGGREGATE, ACC_DATA, AS_OF, DICTIONARIES, HEAD_COMPANY, KEEP_MONTHS, LABEL_SQL, PREMADE_AS_OF, SHOWN, SHOWN_SQL,
    new_ledger, report_sql, shown,
)
from ledgerloom.schemas import FACT, WEATHER
from ledgerloom.shared import scratch_namespace, scratch_path
from ledgerloom.sinks.tables import (
    append_rows, append_with_identity, create_as, create_table, create_view, empty_table,
)
from ledgerloom.sources.files import write_parquet
from ledgerloom.sources.jdbc import ParquetTable, count_where

CUTOFF = cutoff(AS_OF, KEEP_MONTHS)


@register("ledger_backfill", f"""
WITH {ACC_DATA}
SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS amount
FROM acc_data GROUP BY 1""")
def ledger_backfill(spark, sf):
    """Load with few premade months, then move what fell into default."""
    name = create_table(spark, f"{scratch_namespace(spark)}.{FACT.name}", FACT, (partitions.PART,))
    partitions.write_assigned(bindings.fact(spark, sf), name, "transaction_dt", PREMADE_AS_OF)
    partitions.backfill(spark, name, "transaction_dt")
    return spark.table(name).groupBy("part").agg(
        F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")
    )


@register("ledger_cold_move", f"""
WITH {ACC_DATA}
SELECT {LABEL_SQL} AS part, COUNT(*) AS source_rows, COUNT(*) AS target_rows,
       MIN(transaction_dt) AS min_dt, MAX(transaction_dt) AS max_dt, true AS dropped
FROM acc_data WHERE transaction_dt < DATE '{CUTOFF}' GROUP BY 1""")
def ledger_cold_move(spark, sf):
    hot = new_ledger(spark, sf)
    cold = create_table(spark, f"{scratch_namespace(spark, 'cold')}.{FACT.name}", FACT, (partitions.PART,))
    return move_to_cold(spark, hot, cold, AS_OF, KEEP_MONTHS)


@register("ledger_after_move", f"""
WITH {ACC_DATA}
SELECT {LABEL_SQL} AS part, CASE WHEN transaction_dt < DATE '{CUTOFF}' THEN 'cold' ELSE 'hot' END AS storage,
       COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS amount
FROM acc_data GROUP BY 1, 2""")
def ledger_after_move(spark, sf):
    """Both tables after the move was run twice: the second run changes nothing."""
    hot = new_ledger(spark, sf)
    cold = create_table(spark, f"{scratch_namespace(spark, 'cold')}.{FACT.name}", FACT, (partitions.PART,))
    for _ in range(2):
        move_to_cold(spark, hot, cold, AS_OF, KEEP_MONTHS)
    both = spark.table(hot).withColumn("storage", F.lit("hot")).unionByName(
        spark.table(cold).withColumn("storage", F.lit("cold"))
    )
    return both.groupBy("part", "storage").agg(
        F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")
    )


@register("ledger_retention", f"""
WITH {ACC_DATA} SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt FROM acc_data
WHERE transaction_dt >= DATE '{CUTOFF}' GROUP BY 1""")
def ledger_retention(spark, sf):
    name = new_ledger(spark, sf)
    partitions.apply_retention(spark, name, AS_OF, KEEP_MONTHS)
    return spark.table(name).groupBy("part").agg(F.count("*").alias("row_cnt"))


@register("ledger_backfill_equal_rows", f"""
WITH {ACC_DATA}
SELECT {LABEL_SQL} AS part, 2 * COUNT(*) AS row_cnt, CAST(2 * SUM(amount) AS DOUBLE) AS amount
FROM acc_data GROUP BY 1""")
def ledger_backfill_equal_rows(spark, sf):
    """Rows that wait in default beside equal rows of their months: all are kept."""
    name = new_ledger(spark, sf)
    waiting = bindings.fact(spark, sf).withColumn(partitions.PART, F.lit(partitions.DEFAULT))
    append_rows(waiting, name)
    partitions.backfill(spark, name, "transaction_dt")
    return spark.table(name).groupBy("part").agg(
        F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")
    )


@register("ledger_retention_default", f"""
WITH {ACC_DATA} SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt FROM acc_data
WHERE transaction_dt >= DATE '{CUTOFF}' GROUP BY 1""")
def ledger_retention_default(spark, sf):
    """Retention of a table most of whose rows wait in default: old ones go as well."""
    name = create_table(spark, f"{scratch_namespace(spark)}.{FACT.name}", FACT, (partitions.PART,))
    partitions.write_assigned(bindings.fact(spark, sf), name, "transaction_dt", PREMADE_AS_OF)
    partitions.apply_retention(spark, name, AS_OF, KEEP_MONTHS)
    return spark.table(name).groupBy("part").agg(F.count("*").alias("row_cnt"))


@register("ledger_view_waiting", f"""
WITH {ACC_DATA}, rows_once AS (SELECT DISTINCT * FROM acc_data)
SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS amount
FROM rows_once GROUP BY 1""")
def ledger_view_waiting(spark, sf):
    """Hot and cold hold the same rows, one table in default: the view has each once."""
    hot = create_table(spark, f"{scratch_namespace(spark)}.{FACT.name}", FACT, (partitions.PART,))
    partitions.write_assigned(bindings.fact(spark, sf), hot, "transaction_dt", PREMADE_AS_OF)
    return both_parts(spark, hot, new_ledger(spark, sf), keyed=True).groupBy("part").agg(
        F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")
    )


@register("ledger_rollup_table", f"""
WITH {ACC_DATA}, {ACC_AGGREGATE}
SELECT company_id, account_id, period_dt, CAST(amount AS DOUBLE) AS amount, currency_code,
       'p' || strftime(period_dt, '%Y%m01') AS part FROM acc_aggregate""")
def ledger_rollup_table(spark, sf):
    """The rollup inserted into its own partitioned table."""
    fact, rollup = create_ledger(spark, scratch_namespace(spark))
    partitions.write_monthly(bindings.fact(spark, sf), fact, "transaction_dt")
    load_rollup(spark, fact, rollup)
    return spark.table(rollup).withColumn("amount", F.col("amount").cast("double"))


@register("ledger_stored_report", report_sql(inclusive=True, where="WHERE in_month = DATE '1998-03-01'"))
def ledger_stored_report(spark, sf):
    """The report of one month, all companies, from the stored fact and rollup."""
    fact, rollup = create_ledger(spark, scratch_namespace(spark))
    partitions.write_monthly(bindings.fact(spark, sf), fact, "transaction_dt")
    load_rollup(spark, fact, rollup)
    rows = month_report(
        spark, fact, rollup, bindings.companies(spark, sf), bindings.accounts(spark, sf), dt.date(1998, 3, 1)
    )
    return rows.withColumns({c: F.col(c).cast("double") for c in ("amount_all", "amount_custom_1")})


@register("ledger_catalog_rows", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data WHERE company_id <> {HEAD_COMPANY}""")
def ledger_catalog_rows(spark, sf):
    """Create from a query, empty, load again without the head company, and scan."""
    rows = bindings.fact(spark, sf).select(*FACT.columns)
    name = f"{scratch_namespace(spark)}.acc_copy"
    create_as(rows, name)
    empty_table(spark, name)
    append_rows(rows.filter(F.col("company_id") != HEAD_COMPANY), name)
    return shown(spark.table(name))


@register("ledger_foreign_count", f"""
WITH {ACC_DATA} SELECT COUNT(*) AS cnt FROM acc_data WHERE company_id = {HEAD_COMPANY}""")
def ledger_foreign_count(spark, sf):
    """Filtered count of a table read through the remote-table interface."""
    path = scratch_path(spark, "foreign")
    write_parquet(bindings.fact(spark, sf), path)
    return count_where(spark, ParquetTable(path), F.col("company_id") == HEAD_COMPANY)


@register("ledger_reunited", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data
WHERE transaction_dt BETWEEN DATE '1999-11-20' AND DATE '1999-12-10'""")
def ledger_reunited(spark, sf):
    """A day range across the cutoff, read from the hot and the cold table."""
    hot = new_ledger(spark, sf)
    cold = create_table(spark, f"{scratch_namespace(spark, 'cold')}.{FACT.name}", FACT, (partitions.PART,))
    move_to_cold(spark, hot, cold, AS_OF, KEEP_MONTHS)
    rows = both_parts(spark, hot, cold, keyed=True)
    return shown(partitions.read_days(rows, "transaction_dt", dt.date(1999, 11, 20), dt.date(1999, 12, 10)))


@register("ledger_reunited_overlap", f"""
WITH {ACC_DATA} SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS amount
FROM acc_data GROUP BY 1""")
def ledger_reunited_overlap(spark, sf):
    """Hot and cold table with one month in both: each of its rows counts once."""
    last = F.lit(cutoff(AS_OF, KEEP_MONTHS + 1))
    rows, names = bindings.fact(spark, sf), []
    for label, wanted in (("hot", F.col("transaction_dt") >= last), ("cold", F.col("transaction_dt") < F.lit(CUTOFF))):
        names.append(create_table(spark, f"{scratch_namespace(spark, label)}.{FACT.name}", FACT, (partitions.PART,)))
        partitions.write_monthly(rows.filter(wanted), names[-1], "transaction_dt")
    return both_parts(spark, *names, keyed=True).groupBy("part").agg(
        F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")
    )


@register("ledger_view", f"""
WITH {ACC_DATA} SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt FROM acc_data GROUP BY 1""")
def ledger_view(spark, sf):
    """A catalog view over a hot and a cold table that share a month."""
    space = scratch_namespace(spark, "view")
    rows = bindings.fact(spark, sf).select(*SHOWN, partition_label(F.col("transaction_dt")).alias("part"))
    create_as(rows.filter(F.col("transaction_dt") >= F.lit(cutoff(AS_OF, KEEP_MONTHS + 1))), f"{space}.acc_data")
    create_as(rows.filter(F.col("transaction_dt") < F.lit(CUTOFF)), f"{space}.cold_acc_data")
    both = create_view(
        spark, f"{space}.v_acc_data_full",
        f"SELECT * FROM {space}.acc_data UNION SELECT * FROM {space}.cold_acc_data",
    )
    return both.groupBy("part").agg(F.count("*").alias("row_cnt"))


@register("ledger_identity_insert", """
SELECT COUNT(*) AS cnt, CAST(1 AS BIGINT) AS first_id, COUNT(*) AS last_id, COUNT(*) AS distinct_ids
FROM (SELECT p_name FROM part UNION ALL SELECT s_name FROM supplier) n""")
def ledger_identity_insert(spark, sf):
    """Two inserts into a table that numbers its rows."""
    name = f"{scratch_namespace(spark)}.names"
    spark.sql(f"CREATE TABLE {name} (id bigint, name string) USING parquet")
    append_with_identity(bindings.table(spark, sf, "part").select(F.col("p_name").alias("name")), name, "id")
    append_with_identity(bindings.table(spark, sf, "supplier").select(F.col("s_name").alias("name")), name, "id")
    return spark.table(name).agg(
        F.count("*").alias("cnt"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.countDistinct("id").alias("distinct_ids"),
    )


@register("weather_load", """
SELECT CAST(user_id AS VARCHAR) AS station_id, event_type AS city_name, ts AS dt,
       'winter' AS season, value AS avg_temp_c, value + 2.5::DOUBLE AS max_temp_c
FROM events WHERE NULLIF(event_type, 'error') IS NOT NULL""")
def weather_load(spark, sf):
    """Clean the observations and append them to a declared catalog table."""
    name = create_table(spark, f"{scratch_namespace(spark, 'weather')}.{WEATHER.name}", WEATHER)
    cleaned = weather.clean(bindings.weather_source(spark, sf)).withColumnRenamed("date", "dt")
    weather.timed_load(cleaned, lambda df: append_rows(df, name))
    return spark.table(name).select("station_id", "city_name", "dt", "season", "avg_temp_c", "max_temp_c")
