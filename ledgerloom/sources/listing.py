"""What lies in storage: paths, lengths and times of files, without reading any data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a stored table, from the catalog."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file: path, length, modificationTime, and the partition columns that
    the folders name. Spark lists the folders and asks the file system for each file; the
    content is not selected, so no file is opened. An empty folder has no rows."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.drop("content")


def listed_table(spark: SparkSession, table: str) -> DataFrame:
    return list_files(spark, table_location(spark, table))


def listed_sizes(files: DataFrame, by: list[str]) -> DataFrame:
    """Files, bytes and a mark of the stored state, by partition. Files are written once
    under names of their own, so a partition whose mark is the same holds the same rows;
    the mark is a sum of hashes and doesn't depend on the order of the files."""
    terms = [F.xxhash64(F.lit(seed), "path", "length", "modificationTime").cast("decimal(28,0)") for seed in (1, 2)]
    return files.groupBy(*by).agg(
        F.count("*").alias("file_cnt"),
        F.sum("length").alias("size_bytes"),
        F.concat_ws(":", F.count("*").cast("string"), *[F.sum(t).cast("string") for t in terms]).alias("mark"),
    )
