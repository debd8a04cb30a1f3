"""Parquet and CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Zone-less timestamps in text, down to the microsecond.
ZONELESS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

# What the CSV parser hands on for a field with nothing in it. It is no text a file
# can hold as a field, so a quoted empty field is not taken for it.
NULL_MARK = "\u0000"


def read_parquet(spark: SparkSession, path: str, legacy_dates: bool = False) -> DataFrame:
    """Parquet scan. ``legacy_dates`` rebases dates and timestamps before 1582
    (and old INT96 values) from the hybrid calendar; it is a reader option, so
    other scans of the session keep their own mode."""
    mode = "LEGACY" if legacy_dates else "CORRECTED"
    return (
        spark.read.option("datetimeRebaseMode", mode)
        .option("int96RebaseMode", mode)
        .parquet(path)
    )


def csv_options() -> dict[str, str]:
    """How CSV text is read: an empty field is null, a quoted empty field an empty
    string, and a doubled quote stands for one quote."""
    return {"sep": ",", "quote": '"', "escape": '"', "nullValue": NULL_MARK, "emptyValue": "", "timestampNTZFormat": ZONELESS}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True, **options
) -> DataFrame:
    """CSV scan with a declared schema."""
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", True)
    for key, value in (csv_options() | options).items():
        reader = reader.option(key, value)
    return reader.csv(path)


def write_parquet(df: DataFrame, path: str, legacy_dates: bool = False, mode: str = "errorifexists") -> None:
    """Parquet write. ``legacy_dates`` stores old dates in the hybrid calendar, for
    readers that expect it; the session settings are put back after the write."""
    if not legacy_dates:
        df.write.mode(mode).parquet(path)
        return
    conf = df.sparkSession.conf
    keys = ("spark.sql.parquet.datetimeRebaseModeInWrite", "spark.sql.parquet.int96RebaseModeInWrite")
    before = {key: conf.get(key) for key in keys}
    for key in keys:
        conf.set(key, "LEGACY")
    try:
        df.write.mode(mode).parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
