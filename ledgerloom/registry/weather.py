"""Weather queries: cleaning, the five questions, CSV loads, upsert and rewrite."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import bindings
from ledgerloom.functions.periods import moment
from ledgerloom.operators.layout import rewrite_columnar, stored_bytes
from ledgerloom.operators.upsert import keep_last, upsert
from ledgerloom.plans import weather as plans
from ledgerloom.registry import register
from ledgerloom.schemas import MEASURES
from ledgerloom.shared import scratch_path
from ledgerloom.sinks.tables import write_csv
from ledgerloom.sources.files import read_csv, read_parquet, write_parquet
from ledgerloom.sources.rejects import LoadResult, load_csv

CITY = "purchase"
DAY = dt.datetime(2024, 1, 5)
NEXT_DAY = dt.datetime(2024, 1, 6)

WEATHER = """weather AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id, event_type AS city_name, ts AS dt,
         value AS avg_temp_c, value - 2.5::DOUBLE AS min_temp_c, value + 2.5::DOUBLE AS max_temp_c FROM events)"""


@register("weather_count", f"WITH {WEATHER} SELECT COUNT(*) AS cnt FROM weather")
def weather_count(spark, sf):
    return plans.count_rows(bindings.weather(spark, sf))


@register("weather_date_range", f"WITH {WEATHER} SELECT MIN(dt) AS min_dt, MAX(dt) AS max_dt FROM weather")
def weather_date_range(spark, sf):
    return plans.date_range(bindings.weather(spark, sf))


@register("weather_by_city", f"""
WITH {WEATHER} SELECT city_name, COUNT(*) AS cnt FROM weather GROUP BY city_name ORDER BY city_name""")
def weather_by_city(spark, sf):
    return plans.by_city(bindings.weather(spark, sf))


@register("weather_city_extremes", f"""
WITH {WEATHER} SELECT MAX(max_temp_c) AS max_temp, MIN(min_temp_c) AS min_temp
FROM weather WHERE city_name = '{CITY}'""")
def weather_city_extremes(spark, sf):
    return plans.city_extremes(bindings.weather(spark, sf), CITY)


@register("weather_point", f"""
WITH {WEATHER} SELECT avg_temp_c FROM weather
WHERE city_name = '{CITY}' AND dt >= TIMESTAMP '{DAY}' AND dt < TIMESTAMP '{NEXT_DAY}'""")
def weather_point(spark, sf):
    return plans.day_lookup(bindings.weather(spark, sf), CITY, DAY, NEXT_DAY)


@register("weather_clean", """
SELECT CAST(user_id AS VARCHAR) AS station_id, event_type AS city_name, ts AS date,
       'winter' AS season, value AS avg_temp_c, value - 2.5::DOUBLE AS min_temp_c, value + 2.5::DOUBLE AS max_temp_c
FROM events WHERE NULLIF(event_type, 'error') IS NOT NULL""")
def weather_clean(spark, sf):
    return plans.clean(bindings.weather_source(spark, sf)).drop(*MEASURES[3:])


@register("weather_upsert", """
SELECT event_type AS city_name, CAST(ts AS DATE) AS day, MAX(event_id) AS event_id,
       arg_max(value, event_id) AS avg_temp_c FROM events GROUP BY 1, 2""")
def weather_upsert(spark, sf):
    rows = bindings.table(spark, sf, "events").select(
        F.col("event_type").alias("city_name"),
        F.col("ts").cast("date").alias("day"),
        "event_id",
        F.col("value").alias("avg_temp_c"),
    )
    return keep_last(rows, ["city_name", "day"], ["event_id"])


@register("weather_upsert_batch", """
WITH first AS (
  SELECT event_type, CAST(ts AS DATE) AS day, arg_max(value, event_id) AS v, COUNT(*) AS n
  FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2),
second AS (
  SELECT event_type, CAST(ts AS DATE) AS day, arg_max(-value, event_id) AS v, COUNT(*) AS n
  FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2)
SELECT COALESCE(s.event_type, f.event_type) AS city_name, COALESCE(s.day, f.day) AS day,
       COALESCE(s.v, f.v) AS avg_temp_c
FROM first f FULL JOIN second s ON f.event_type = s.event_type AND f.day = s.day""")
def weather_upsert_batch(spark, sf):
    """A second load overlaps the first by ten days and wins there."""
    rows = bindings.table(spark, sf, "events").select(
        F.col("event_type").alias("city_name"),
        F.col("ts").cast("date").alias("day"),
        "ts",
        "event_id",
        F.col("value").alias("avg_temp_c"),
    )
    key = ["city_name", "day"]
    first = keep_last(rows.filter(F.col("ts") < moment(dt.datetime(2024, 1, 20))), key, ["event_id"])
    late = rows.filter(F.col("ts") >= moment(dt.datetime(2024, 1, 10)))
    second = keep_last(late.withColumn("avg_temp_c", -F.col("avg_temp_c")), key, ["event_id"])
    columns = [*key, "avg_temp_c"]
    return upsert(first.select(*columns), second.select(*columns), key)


@register("weather_top1", """
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1""")
def weather_top1(spark, sf):
    rows = bindings.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return rows.orderBy(F.desc("ts"), F.desc("event_id")).limit(1)


@register("weather_limit", f"""
WITH {WEATHER} SELECT * FROM weather ORDER BY dt, station_id, city_name, avg_temp_c LIMIT 10""")
def weather_limit(spark, sf):
    return bindings.weather(spark, sf).orderBy("dt", "station_id", "city_name", "avg_temp_c").limit(10)


@register("weather_sample", """
SELECT event_id, ts, event_type FROM events
ORDER BY md5('7|' || CAST(event_id AS VARCHAR)), event_id LIMIT 5""")
def weather_sample(spark, sf):
    """Random rows: the order is a seeded hash, so the sample can be repeated."""
    rows = bindings.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return rows.orderBy(F.md5(F.concat(F.lit("7|"), F.col("event_id").cast("string"))), "event_id").limit(5)


@register("weather_random_rows")
def weather_random_rows(spark, sf):
    """Five rows by random order."""
    return bindings.weather(spark, sf).orderBy(F.rand(7)).limit(5)


@register("uuid_table", """
SELECT COUNT(*) AS row_cnt, COUNT(*) AS distinct_cnt, COUNT(*) AS wellformed_cnt FROM orders""")
def uuid_table(spark, sf):
    """A random identifier per row, written to a table and checked there."""
    ids = bindings.table(spark, sf, "orders").select("o_orderkey", F.expr("uuid()").alias("c1"))
    path = scratch_path(spark, "uuids")
    write_parquet(ids, path)
    wellformed = F.col("c1").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return spark.read.parquet(path).agg(
        F.count("*").alias("row_cnt"),
        F.countDistinct("c1").alias("distinct_cnt"),
        F.count_if(wellformed).alias("wellformed_cnt"),
    )


# --- CSV ---------------------------------------------------------------------

def _events_csv(spark, sf) -> tuple[str, T.StructType]:
    rows = bindings.weather(spark, sf)
    path = scratch_path(spark, "weather-csv")
    write_csv(rows, path)
    return path, rows.schema


@register("weather_csv_scan", f"WITH {WEATHER} SELECT * FROM weather")
def weather_csv_scan(spark, sf):
    path, schema = _events_csv(spark, sf)
    return read_csv(spark, path, schema)


@register("weather_columnar_rewrite", f"""
WITH {WEATHER}
SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, true AS smaller FROM weather""")
def weather_columnar_rewrite(spark, sf):
    """CSV rows rewritten as parquet, sorted by city and day; bytes are compared."""
    path, schema = _events_csv(spark, sf)
    rows = read_csv(spark, path, schema)
    columnar = rewrite_columnar(rows, scratch_path(spark, "weather-columnar"), ["city_name", "dt", "station_id"])
    csv_bytes = stored_bytes(rows).select("size_bytes").scalar()
    parquet_bytes = stored_bytes(columnar).select("size_bytes").scalar()
    return columnar.agg(F.count("*").alias("rows_after")).select(
        rows.agg(F.count("*")).scalar().alias("rows_before"),
        "rows_after",
        (parquet_bytes < csv_bytes).alias("smaller"),
    )


@register("weather_historic_dates", """
SELECT CAST(o_orderdate - INTERVAL 450 YEAR AS DATE) AS day, COUNT(*) AS cnt FROM orders GROUP BY 1""")
def weather_historic_dates(spark, sf):
    """Dates of the sixteenth century, stored in the hybrid calendar and read back."""
    days = bindings.table(spark, sf, "orders").select(
        F.add_months(F.col("o_orderdate").cast("date"), -450 * 12).alias("day")
    )
    path = scratch_path(spark, "historic")
    write_parquet(days, path, legacy_dates=True)
    return read_parquet(spark, path, legacy_dates=True).groupBy("day").agg(F.count("*").alias("cnt"))


# Rows with a brand for a station are not integers; rows with 'n/a' are not a time.
PART_CSV = """raw AS (
  SELECT CASE WHEN p_size % 10 = 0 THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS station_id,
         p_name AS city_name,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE DATE '2000-01-01' + CAST(p_partkey % 3650 AS INTEGER) END AS day,
         p_type AS season, p_retailprice AS avg_temp_c, p_partkey, p_size FROM part),
outcome AS (
  SELECT *, CASE WHEN p_size % 10 = 0 THEN 'station_id' WHEN day IS NULL THEN 'dt' END AS bad_column FROM raw)"""


def _part_csv(rows: DataFrame) -> DataFrame:
    size = F.col("p_size")
    day = F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("p_partkey") % 3650).cast("int"))
    stamp = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000+03:00"))
    price = F.col("p_retailprice")
    return rows.select(
        F.when(size % 10 == 0, F.col("p_brand")).otherwise(F.col("p_partkey").cast("string")).alias("station_id"),
        F.col("p_name").alias("city_name"),
        F.when(size % 7 == 0, F.lit("n/a")).otherwise(stamp).alias("dt"),
        F.col("p_type").alias("season"),
        *[price.alias(m) for m in MEASURES[:3]],
        *[F.lit(None).cast("double").alias(m) for m in MEASURES[3:]],
    )


_loads: dict[tuple[str, str], LoadResult] = {}


# The share of bad rows a load may have; with more it is refused.
ERROR_SHARE = 0.5


def _part_load(spark, sf) -> LoadResult:
    """The bulk load of the session, run once: its parts are read by three queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _loads:
        path = scratch_path(spark, "part-csv")
        write_csv(_part_csv(bindings.table(spark, sf, "part")), path)
        _loads[key] = load_csv(spark, path, plans.load_columns(), error_share=ERROR_SHARE)
    return _loads[key]


@register("weather_csv_loaded", f"""
WITH {PART_CSV}
SELECT CAST(station_id AS INTEGER) AS station_id, city_name,
       CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) - 10800 AS dt_seconds, season,
       CAST(CAST(avg_temp_c AS FLOAT) AS DOUBLE) AS avg_temp_c
FROM outcome WHERE bad_column IS NULL""")
def weather_csv_loaded(spark, sf):
    good = _part_load(spark, sf).good
    return good.select(
        "station_id", "city_name", F.unix_seconds("dt").alias("dt_seconds"), "season",
        F.col("avg_temp_c").cast("double").alias("avg_temp_c"),
    )


@register("weather_csv_rejects", f"""
WITH {PART_CSV} SELECT bad_column, COUNT(*) AS cnt FROM outcome WHERE bad_column IS NOT NULL GROUP BY 1""")
def weather_csv_rejects(spark, sf):
    return _part_load(spark, sf).rejects.groupBy("bad_column").agg(F.count("*").alias("cnt"))


@register("weather_load_report", f"""
WITH {PART_CSV}
SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE bad_column IS NULL) AS rows_loaded,
       COUNT(bad_column) AS rows_rejected, CAST(floor(COUNT(*) * {ERROR_SHARE}) AS BIGINT) AS error_limit FROM outcome""")
def weather_load_report(spark, sf):
    return _part_load(spark, sf).report()


@register("weather_date_check", """
SELECT CAST(MIN(ts) AS DATE) AS min_day, CAST(MAX(ts) AS DATE) AS max_day, true AS same FROM events""")
def weather_date_check(spark, sf):
    """Day range of the loaded table against the source: a narrow type would wrap."""
    path, schema = _events_csv(spark, sf)
    source = bindings.weather(spark, sf)
    first, last = source.agg(F.min("dt")).scalar(), source.agg(F.max("dt")).scalar()
    return plans.date_range(read_csv(spark, path, schema)).select(
        F.col("min_dt").cast("date").alias("min_day"),
        F.col("max_dt").cast("date").alias("max_day"),
        ((F.col("min_dt") == first) & (F.col("max_dt") == last)).alias("same"),
    )
