"""Loads into stored tables: upserts, bulk loads with a reject log, defaults, reloads."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.functions.periods import moment
from ledgerloom.operators.partitions import PART, write_monthly
from ledgerloom.operators.rollup import monthly_rollup
from ledgerloom.plans import weather as plans
from ledgerloom.plans.ledger import create_ledger, load_rollup
from ledgerloom.registry import register
from ledgerloom.registry.base import ACC_AGGREGATE, ACC_DATA, new_ledger
from ledgerloom.schemas import ACCOUNTS, COMPANIES, FACT, ROLLUP, WEATHER
from ledgerloom.shared import scratch_namespace, scratch_path
from ledgerloom.sinks.keyed import upsert_into
from ledgerloom.sinks.tables import create_table, declared_defaults, describe, insert_omitting, plan_text, tables_in

# --- upsert ------------------------------------------------------------------

# Batches of one month's observations: the second begins before the first ends.
FIRST_UNTIL, SECOND_FROM = dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 10)


def _batch(events: DataFrame, sign: int) -> DataFrame:
    value = F.col("value") * sign
    return events.select(
        F.col("user_id").cast("string").alias("station_id"),
        F.col("event_type").alias("city_name"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("dt"),
        F.lit("winter").alias("season"),
        value.alias("avg_temp_c"),
        *[F.lit(None).cast("double").alias(f.name) for f in WEATHER.schema if f.name in WEATHER.columns[5:]],
        "event_id",
    )


@register("weather_upsert_table", f"""
WITH loads AS (
  SELECT 1 AS load, event_id, event_type, ts, user_id, value FROM events WHERE ts < TIMESTAMP '{FIRST_UNTIL}'
  UNION ALL
  SELECT 2, event_id, event_type, ts, user_id, -value FROM events WHERE ts >= TIMESTAMP '{SECOND_FROM}'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY load DESC, event_id DESC) AS place FROM loads)
SELECT event_type AS city_name, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS station_id, value AS avg_temp_c,
       strftime(ts, 'p%Y%m%d') AS part
FROM ranked WHERE place = 1""")
def weather_upsert_table(spark, sf):
    """Two batches into a table stored by day, the second one twice: the rows it names
    are replaced, and days it doesn't touch keep their files."""
    name = create_table(spark, f"{scratch_namespace(spark, 'weather')}.{WEATHER.name}", WEATHER, (PART,))
    events = bindings.table(spark, sf, "events")
    first = _batch(events.filter(F.col("ts") < moment(FIRST_UNTIL)), 1)
    second = _batch(events.filter(F.col("ts") >= moment(SECOND_FROM)), -1)
    label = F.concat(F.lit("p"), F.date_format("dt", "yyyyMMdd"))
    for batch in (first, second, second):
        upsert_into(batch, name, ["city_name", "dt"], label, ["event_id"])
    return spark.table(name).select("city_name", F.col("dt").cast("date").alias("day"), "station_id", "avg_temp_c", PART)


# --- bulk load ---------------------------------------------------------------

# Lines as text: brands for stations and 'n/a' for days can't be read; names hold quotes and commas.
LINES = """lines AS (
  SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 'station_id' WHEN p_size % 7 = 0 THEN 'dt'
                         WHEN p_size % 11 = 0 THEN '(line)' END AS bad_column,
         p_size AS station_id, p_name || ', "' || p_type || '"' AS city_name,
         DATE '2000-01-01' + CAST(p_partkey % 30 AS INTEGER) AS day,
         CASE WHEN p_size % 10 = 0 THEN p_brand ELSE CAST(p_size AS VARCHAR) END
         || ',"' || p_name || ', ""' || p_type || '""' || '",'
         || CASE WHEN p_size % 7 = 0 THEN 'n/a' ELSE strftime(DATE '2000-01-01' + CAST(p_partkey % 30 AS INTEGER), '%Y-%m-%d') || 'T00:00:00.000+03:00' END
         || ',"",' || p_size || ',,,,,,,,,' || CASE WHEN p_size % 11 = 0 THEN ',' ELSE '' END AS line
  FROM part)"""


def _lines(parts: DataFrame) -> DataFrame:
    size = F.col("p_size")
    stamp = F.concat(F.date_format(F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("p_partkey") % 30).cast("int")), "yyyy-MM-dd"), F.lit("T00:00:00.000+03:00"))
    return parts.select(F.concat(
        F.when(size % 10 == 0, F.col("p_brand")).otherwise(size.cast("string")),
        F.lit(',"'), "p_name", F.lit(', ""'), "p_type", F.lit('""",'),
        F.when(size % 7 == 0, F.lit("n/a")).otherwise(stamp),
        F.lit(',"",'), size.cast("string"), F.lit(",,,,,,,,,"),
        F.when(size % 11 == 0, F.lit(",")).otherwise(F.lit("")),
    ).alias("line"))


_targets: dict[tuple[str, str], tuple[str, list]] = {}


def _bulk_target(spark, sf) -> tuple[str, list]:
    """The distributed table after two bulk loads, and their results: run once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _targets:
        name = plans.create_loaded(spark, scratch_namespace(spark, "loaded"))
        parts, results = bindings.table(spark, sf, "part"), []
        for half in (0, 1):
            path = scratch_path(spark, "part-lines")
            _lines(parts.filter(F.col("p_partkey") % 2 == half)).write.text(path)
            results.append(plans.bulk_load(spark, path, name, error_share=0.5, header=False))
        _targets[key] = (name, results)
    return _targets[key]


@register("weather_bulk_target", f"""
WITH {LINES}
SELECT CAST(station_id AS INTEGER) AS station_id, CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) - 10800 AS dt_seconds,
       COUNT(*) AS cnt, MAX(city_name) AS city_name, CAST(SUM(station_id) AS DOUBLE) AS avg_temp_sum
FROM lines WHERE bad_column IS NULL GROUP BY 1, 2""")
def weather_bulk_target(spark, sf):
    """Rows of two bulk loads by station and day, summed where they lie."""
    name, _ = _bulk_target(spark, sf)
    rows = plans.by_station_and_day(spark.table(name))
    return rows.select("station_id", F.unix_seconds("dt").alias("dt_seconds"), "cnt", "city_name", F.col("avg_temp_sum").cast("double").alias("avg_temp_sum"))


@register("weather_reject_lines", f"WITH {LINES} SELECT bad_column, line FROM lines WHERE bad_column IS NOT NULL")
def weather_reject_lines(spark, sf):
    """The reject logs of the two loads: lines as they stand in the files."""
    _, (first, second) = _bulk_target(spark, sf)
    return first.rejects.unionByName(second.rejects).select("bad_column", "line")


@register("weather_reject_places", f"""
WITH {LINES}
SELECT COUNT(*) AS cnt, COUNT(*) AS places, true AS inside FROM lines WHERE bad_column IS NOT NULL""")
def weather_reject_places(spark, sf):
    """Every reject names a line of its own among those of its file."""
    logs = []
    for result in _bulk_target(spark, sf)[1]:
        length = result.splits.groupBy(F.col("_file").alias("file")).agg(F.sum("_lines").alias("length"))
        logs.append(result.rejects.join(length, "file"))
    return logs[0].unionByName(logs[1]).agg(
        F.count("*").alias("cnt"),
        F.count_distinct("file", "line_no").alias("places"),
        F.bool_and(F.col("line_no").between(F.lit(1), F.col("length"))).alias("inside"),
    )


# --- defaults, comments and plans in the catalog ------------------------------

@register("ledger_dictionary_load", """
SELECT n_nationkey AS company_id, n_name AS company_name, n_regionkey AS parent_company_id,
       TIMESTAMP '1900-01-01 00:00:00' AS dttm_start, TIMESTAMP '3000-12-31 00:00:00' AS dttm_end FROM nation
UNION ALL
SELECT 1000 + s_suppkey, s_name, NULL, TIMESTAMP '1900-01-01 00:00:00', TIMESTAMP '2000-01-01 00:00:00' FROM supplier""")
def ledger_dictionary_load(spark, sf):
    """Inserts that leave columns out: the catalog's defaults fill them, and a given
    value stands."""
    name = create_table(spark, f"{scratch_namespace(spark)}.{COMPANIES.name}", COMPANIES)
    insert_omitting(bindings.companies(spark, sf), name)
    others = bindings.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000).cast("int").alias("company_id"), F.col("s_name").alias("company_name"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("dttm_end"),
    )
    insert_omitting(others, name)
    return spark.table(name).select(F.col("company_id").cast("bigint").alias("company_id"), "company_name", "parent_company_id", "dttm_start", "dttm_end")


@register("ledger_catalog_report", f"""
WITH t(table_name, columns, described, defaults, keyed) AS (
  VALUES ('{ACCOUNTS.name}', 3, 3, 0, true), ('{COMPANIES.name}', 8, 8, 2, true),
         ('{FACT.name}', 15, 15, 0, true), ('{ROLLUP.name}', 6, 6, 0, true))
SELECT t.*, CASE table_name WHEN '{FACT.name}' THEN (SELECT COUNT(*) FROM lineitem)
                            WHEN '{COMPANIES.name}' THEN (SELECT COUNT(*) FROM nation) ELSE 0 END AS row_cnt FROM t""")
def ledger_catalog_report(spark, sf):
    """The tables of a namespace, as the catalog lists and describes them, and their rows."""
    space = scratch_namespace(spark)
    for spec, by in ((FACT, (PART,)), (ROLLUP, (PART,)), (COMPANIES, ()), (ACCOUNTS, ())):
        create_table(spark, f"{space}.{spec.name}", spec, by)
    insert_omitting(bindings.companies(spark, sf), f"{space}.{COMPANIES.name}")
    write_monthly(bindings.fact(spark, sf), f"{space}.{FACT.name}", "transaction_dt")
    reports = []
    for name in tables_in(spark, space):
        table = f"{space}.{name}"
        shown = describe(spark, table)
        ends = shown.filter("col_name = '# Partition Information'").count() > 0
        own = shown.filter("data_type <> '' and not col_name like '#%'").dropDuplicates(["col_name"])
        figures = own.agg(F.count("*").cast("int").alias("columns"), F.count_if(F.length("comment") > 0).cast("int").alias("described"))
        reports.append(figures.select(
            F.lit(name).alias("table_name"), "columns", "described",
            F.lit(len(declared_defaults(spark, table))).alias("defaults"),
            F.lit(ends == (name in (FACT.name, ROLLUP.name))).alias("keyed"),
            F.lit(spark.table(table).count()).cast("bigint").alias("row_cnt"),
        ))
    return functools.reduce(DataFrame.unionByName, reports)


@register("ledger_plan_report", f"""
SELECT true AS reads_month, true AS sums_before_shuffle, false AS has_python, COUNT(*) AS row_cnt
FROM lineitem WHERE l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01'""")
def ledger_plan_report(spark, sf):
    """What the shown plan of a month's rollup says, beside the rows it reads."""
    name = new_ledger(spark, sf)
    month = spark.table(name).filter(F.col(PART) == "p19980301")
    text = plan_text(monthly_rollup(month))
    said = {"reads_month": "PartitionFilters" in text and "p19980301" in text, "sums_before_shuffle": text.count("HashAggregate") >= 2, "has_python": "Python" in text}
    return month.agg(F.count("*").alias("row_cnt")).select(*[F.lit(v).alias(k) for k, v in said.items()], "row_cnt")


@register("weather_zones", """
SELECT 'Asia/Tokyo' AS zone, MIN(ts) AS first, MAX(ts) AS last, COUNT(*) AS cnt,
       CAST(floor(epoch(MIN(ts))) AS BIGINT) - 9 * 3600 AS first_seconds FROM events
UNION ALL
SELECT 'UTC', MIN(ts), MAX(ts), COUNT(*), CAST(floor(epoch(MIN(ts))) AS BIGINT) FROM events""")
def weather_zones(spark, sf):
    """The session's zone decides what instant a zone-less time is, and nothing else."""
    reports = []
    key = "spark.sql.session.timeZone"
    for zone in ("Asia/Tokyo", "UTC"):
        session = spark.newSession()
        session.conf.set(key, zone)
        own = bindings.table(session, sf, "events").agg(
            F.min("ts").cast("string").alias("first"), F.max("ts").cast("string").alias("last"), F.count("*").alias("cnt"),
            F.unix_seconds(F.min("ts").cast("timestamp")).alias("first_seconds"),
        )
        reports.append(F.struct(F.lit(zone).alias("zone"), *[F.lit(v).alias(k) for k, v in own.first().asDict().items()]))
    found = spark.range(1).select(F.inline(F.array(*reports)))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


# --- reload ------------------------------------------------------------------

LATE = "transaction_dt BETWEEN DATE '1998-02-10' AND DATE '1998-03-20'"


@register("ledger_rollup_reload", f"""
WITH {ACC_DATA}, {ACC_AGGREGATE}
SELECT company_id, account_id, period_dt, CAST(amount AS DOUBLE) AS amount, currency_code,
       'p' || strftime(period_dt, '%Y%m01') AS part FROM acc_aggregate""")
def ledger_rollup_reload(spark, sf):
    """The rollup loaded before some rows came, after they came, and once more."""
    fact, rollup = create_ledger(spark, scratch_namespace(spark))
    rows = bindings.fact(spark, sf)
    write_monthly(rows.filter(f"not ({LATE})"), fact, "transaction_dt")
    load_rollup(spark, fact, rollup)
    write_monthly(rows.filter(LATE), fact, "transaction_dt")
    for _ in range(2):
        load_rollup(spark, fact, rollup)
    return spark.table(rollup).withColumn("amount", F.col("amount").cast("double"))
