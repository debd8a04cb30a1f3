"""Weather jobs: clean, load, rewrite, and the five queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.periods import half_open
from ledgerloom.schemas import LOADED_WEATHER, WEATHER
from ledgerloom.sinks.tables import append_bucketed, create_table
from ledgerloom.sources.rejects import LoadColumn, LoadResult, load_csv, zoned_timestamp


def clean(raw: DataFrame) -> DataFrame:
    """Drop rows without a city and the leftover index, and keep the observation
    time without a zone, so that no session zone can shift historic dates."""
    return (
        raw.filter("city_name is not null")
        .withColumn("date", F.col("date").cast("timestamp_ntz"))
        .drop("__index_level_0__")
    )


def timed_load(df: DataFrame, sink: Callable[[DataFrame], None]) -> float:
    """Run a sink over the rows and return its seconds; scan, cleaning and write
    are timed together, because the write is what sets them going."""
    start = time.perf_counter()
    sink(df)
    return time.perf_counter() - start


def load_columns(station: str = "int", day: Callable = zoned_timestamp) -> list[LoadColumn]:
    """Columns of the bulk load: an integer station, the day as text with a zone,
    and single-precision measures."""
    columns = []
    for f in WEATHER.schema:
        if f.name == "station_id":
            columns.append(LoadColumn(f.name, station))
        elif f.name == "dt":
            columns.append(LoadColumn(f.name, "timestamp", day))
        else:
            columns.append(LoadColumn(f.name, "float" if f.dataType.typeName() == "double" else "string"))
    return columns


# Buckets of the bulk load's target, and the columns that deal its rows.
BUCKETS = 16
DISTRIBUTED_BY = ("station_id", "dt")


def create_loaded(spark: SparkSession, namespace: str, buckets: int = BUCKETS) -> str:
    """The empty target of the bulk load, its rows distributed by station and day."""
    return create_table(spark, f"{namespace}.{LOADED_WEATHER.name}", LOADED_WEATHER, (), DISTRIBUTED_BY, buckets)


def bulk_load(spark: SparkSession, path: str, table: str, **limits) -> LoadResult:
    """Load CSV files into the distributed table: good rows are inserted, bad ones logged.
    A load that is refused for its rejects inserts nothing."""
    result = load_csv(spark, path, load_columns(), **limits)
    append_bucketed(result.good, table)
    return result


def by_station_and_day(weather: DataFrame) -> DataFrame:
    """Rows and measures per station and day; the rows are summed in their buckets."""
    return weather.groupBy(*DISTRIBUTED_BY).agg(
        F.count("*").alias("cnt"), F.max("city_name").alias("city_name"), F.sum("avg_temp_c").alias("avg_temp_sum")
    )


def count_rows(weather: DataFrame) -> DataFrame:
    return weather.agg(F.count("*").alias("cnt"))


def date_range(weather: DataFrame) -> DataFrame:
    return weather.agg(F.min("dt").alias("min_dt"), F.max("dt").alias("max_dt"))


def by_city(weather: DataFrame) -> DataFrame:
    return weather.groupBy("city_name").agg(F.count("*").alias("cnt")).orderBy(F.asc_nulls_last("city_name"))


def city_extremes(weather: DataFrame, city: str) -> DataFrame:
    return weather.filter(F.col("city_name") == city).agg(
        F.max("max_temp_c").alias("max_temp"), F.min("min_temp_c").alias("min_temp")
    )


def day_lookup(weather: DataFrame, city: str, low, high) -> DataFrame:
    """Average temperature of a city on the days ``low <= dt < high``."""
    return weather.filter((F.col("city_name") == city) & half_open(F.col("dt"), low, high)).select("avg_temp_c")
