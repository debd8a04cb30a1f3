"""Moves that drop data: nothing may be lost, counted twice, or go unseen."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.operators import partitions
from ledgerloom.operators.upsert import keep_last
from ledgerloom.plans.ledger import both_parts
from ledgerloom.schemas import FACT
from ledgerloom.shared import scratch_namespace
from ledgerloom.sinks.tables import append_rows, create_table

DAY = "transaction_dt"


@pytest.fixture
def rows(spark, sf_dir):
    return bindings.fact(spark, sf_dir).orderBy("transaction_id").limit(50).cache()


def empty(spark):
    return create_table(spark, f"{scratch_namespace(spark)}.{FACT.name}", FACT, (partitions.PART,))


def wait(rows, table):
    append_rows(rows.withColumn(partitions.PART, F.lit(partitions.DEFAULT)), table)


def test_digest_sees_a_value_that_moved_to_another_column(spark):
    schema = "day date, a string, b string, part string"
    one = spark.createDataFrame([(dt.date(2024, 1, 1), "Q", None, "p")], schema)
    other = spark.createDataFrame([(dt.date(2024, 1, 1), None, "Q", "p")], schema)
    first, second = (partitions.digest(d, ["day", "a", "b"], "day").first() for d in (one, other))
    assert first["checksum"] != second["checksum"] and first["checksum_2"] != second["checksum_2"]


def test_backfill_keeps_rows_equal_to_rows_of_their_month(spark, rows):
    name = empty(spark)
    partitions.write_monthly(rows, name, DAY)
    wait(rows, name)
    partitions.backfill(spark, name, DAY)
    assert spark.table(name).count() == 100
    assert partitions.DEFAULT not in partitions.list_partitions(spark, name)


def test_backfill_that_died_after_its_copy_copies_nothing_twice(spark, rows):
    name = empty(spark)
    wait(rows, name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{partitions.RUNNING}' = '50,0')")
    partitions.write_monthly(rows, name, DAY)
    partitions.backfill(spark, name, DAY)
    assert spark.table(name).count() == 50
    properties = [r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]
    assert partitions.RUNNING not in properties


def test_backfill_keeps_default_when_rows_are_missing(spark, rows):
    name = empty(spark)
    partitions.write_monthly(rows, name, DAY)
    wait(rows, name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{partitions.RUNNING}' = '50,50')")
    with pytest.raises(RuntimeError, match="default is kept"):
        partitions.backfill(spark, name, DAY)
    assert spark.table(name).count() == 100


def test_rows_that_came_after_a_dead_backfill_do_not_block_the_next(spark, rows):
    name = empty(spark)
    wait(rows, name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{partitions.RUNNING}' = '50,0')")
    partitions.write_monthly(rows.limit(20), name, DAY)  # it died in its copy
    more = rows.withColumn("transaction_id", F.col("transaction_id") + 1_000_000)
    wait(more, name)
    partitions.write_monthly(rows.withColumn("transaction_id", F.col("transaction_id") + 2_000_000), name, DAY)
    partitions.backfill(spark, name, DAY)
    assert spark.table(name).count() == 150 == spark.table(name).select("transaction_id", "account_id", "amount", "transaction_dt", "custom_1").distinct().count()
    assert partitions.DEFAULT not in partitions.list_partitions(spark, name)


def test_retention_drops_old_rows_of_default(spark, rows):
    name = empty(spark)
    wait(rows, name)
    last = rows.agg(F.max(DAY)).first()[0]
    partitions.apply_retention(spark, name, last, 0)
    left = spark.table(name).agg(F.min(DAY)).first()[0]
    assert left >= last.replace(day=1)


def test_a_row_without_a_day_is_refused(spark, rows):
    undated = rows.withColumn(DAY, F.lit(None).cast("date"))
    for write in (
        lambda t: partitions.write_monthly(undated, t, DAY),
        lambda t: partitions.write_assigned(undated, t, DAY, dt.date(2000, 6, 15)),
    ):
        with pytest.raises(Exception, match="a row has no transaction_dt"):
            write(empty(spark))


@pytest.mark.parametrize("keyed", [False, True])
def test_view_counts_a_waiting_row_once(spark, rows, keyed):
    hot, cold = empty(spark), empty(spark)
    wait(rows, hot)
    partitions.write_monthly(rows, cold, DAY)
    assert both_parts(spark, hot, cold, keyed=keyed).count() == 50


def test_keep_last_without_a_load_order_keeps_a_whole_row(spark):
    df = spark.createDataFrame([("k", None, 5)], "k string, loaded int, v int")
    assert tuple(keep_last(df, ["k"], ["loaded"]).first()) == ("k", None, 5)
