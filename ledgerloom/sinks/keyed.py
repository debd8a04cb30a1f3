"""Upsert into a stored table: copy on write of the partitions a batch touches.

The key of a row decides its partition, so the rows a batch replaces lie in the
partitions of the batch. Only those are read, joined with the batch and written anew;
the files of all others stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.partitions import PART, recover_partitions
from ledgerloom.operators.upsert import keep_last
from ledgerloom.shared import scratch_path
from ledgerloom.sinks.tables import remove_folder, set_property, table_property

# Table property: the folder with the new partitions of a swap that has begun.
SWAP = "ledgerloom.swap"


def rows_of(spark: SparkSession, table: str, labels: list[str]) -> DataFrame:
    """The rows of some partitions; no other partition is listed or read."""
    return spark.table(table).filter(F.col(PART).isin(labels))


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that occur in ``df``, and only those."""
    spark = df.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def merged(held: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The held rows whose key the batch doesn't name, and the batch. Both sides hold a
    key once, so no key is hot; null key values count as equal."""
    named = batch.select(*[F.col(f"`{k}`").alias(f"_batch_{k}") for k in key])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_batch_{k}")) for k in key]
    kept = held.join(named, same, "left_anti")
    return kept.unionByName(batch)


def _counts(df: DataFrame) -> dict[str, int]:
    """Rows by partition label: one row per touched partition, from the file footers."""
    return {r[PART]: r["n"] for r in df.groupBy(PART).agg(F.count("*").alias("n")).collect()}


def _swap(spark: SparkSession, table: str, folder: str) -> dict[str, int]:
    """Put staged partitions in place of the table's and count them there."""
    staged = spark.read.schema(spark.table(table).schema).parquet(folder)
    wanted = _counts(staged)
    recover_partitions(spark, table)  # folders that a swap cut short has left
    overwrite_partitions(staged, table)
    spark.catalog.refreshTable(table)
    found = _counts(rows_of(spark, table, sorted(wanted)))
    if found != wanted:
        raise RuntimeError(f"the swap into {table} is incomplete, its rows are kept in {folder}")
    set_property(spark, table, SWAP, None)
    remove_folder(spark, folder)
    return wanted


def finish_swap(spark: SparkSession, table: str) -> bool:
    """Finish the swap of an upsert that died: its new partitions are complete in the
    staged folder, so they are put in place once more. True if there was one."""
    folder = table_property(spark, table, SWAP)
    if folder is None:
        return False
    _swap(spark, table, folder)
    return True


def upsert_into(batch: DataFrame, table: str, key: list[str], label: Column, loaded: list[str]) -> list[str]:
    """Insert the rows of a batch, replacing those of equal key; return the labels of the
    partitions written.

    ``label`` gives the partition of a row and must be a function of the key. Of rows with
    one key in the batch, the one with the largest ``loaded`` columns stays (columns the
    table lacks serve the order alone). A null label is an error. The same batch may be
    loaded again. One upsert runs on a table at a time.

    The new partitions are written to the shared folder first and their place is noted in a
    table property; only then are the old ones replaced. A run that dies before the note
    has changed nothing; one that dies behind it is finished by the next.
    """
    spark = batch.sparkSession
    finish_swap(spark, table)
    columns = spark.table(table).columns
    missing = F.raise_error(F.lit(f"a row for {table} has no partition")).cast("string")
    labelled = batch.withColumn(PART, F.coalesce(label, missing))
    last = keep_last(labelled.select(*columns, *[c for c in loaded if c not in columns]), key, loaded).select(*columns)
    fresh_path = scratch_path(spark, "batch")
    last.write.parquet(fresh_path)
    fresh = spark.read.schema(last.schema).parquet(fresh_path)
    labels = sorted(_counts(fresh))
    if labels:
        folder = scratch_path(spark, "swap")
        rows = merged(rows_of(spark, table, labels), fresh, key)
        rows.hint("rebalance", F.col(PART)).sortWithinPartitions(PART, *key).write.partitionBy(PART).parquet(folder)
        set_property(spark, table, SWAP, folder)
        _swap(spark, table, folder)
    remove_folder(spark, fresh_path)
    return labels
