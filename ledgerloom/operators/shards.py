"""How evenly the rows of a table lie over the pieces it is stored in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skew(counts: DataFrame, rows: str = "row_cnt") -> DataFrame:
    """Skew coefficient (sample deviation over mean, in percent) and idle fraction
    (share of a worker's time spent waiting for the fullest segment)."""
    return counts.agg(
        F.count("*").alias("segments"),
        F.sum(rows).cast("bigint").alias("row_cnt"),
        (F.stddev_samp(rows) / F.avg(rows) * 100).alias("skew_coefficient"),
        (1 - F.avg(rows) / F.max(rows)).alias("idle_fraction"),
    )


def bucket_rows(files: DataFrame) -> DataFrame:
    """Files, rows and bytes of every bucket that has rows, from the stored files of a
    bucketed table (their names end in the bucket's number)."""
    number = F.regexp_extract("file_path", r"_(\d+)\.c\d+[^/]*$", 1).cast("int")
    return files.groupBy(number.alias("bucket")).agg(
        F.count("*").alias("file_cnt"),
        F.sum("row_cnt").alias("row_cnt"),
        F.sum("file_size").alias("size_bytes"),
    )
