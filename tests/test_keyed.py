"""Upsert into a stored table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.partitions import PART, drop_partitions, list_partitions
from ledgerloom.schemas import TableSpec
from ledgerloom.shared import scratch_namespace, scratch_path
from ledgerloom.sinks import keyed
from ledgerloom.sinks.tables import create_table, set_property, table_property

SPEC = TableSpec("obs", T.StructType().add("city", T.StringType()).add("day", T.DateType()).add("value", T.IntegerType()), ("city", "day"))
def label():
    return F.concat(F.lit("p"), F.date_format("day", "yyyyMM"))

ROWS = "city string, day date, value int, n int"


@pytest.fixture
def table(spark):
    name = create_table(spark, f"{scratch_namespace(spark)}.obs", SPEC, (PART,))
    load(spark, name, [(c, dt.date(2024, m, d), 1, 0) for c in ("a", "b", None) for m in range(1, 7) for d in (1, 2)])
    return name


def load(spark, name, rows):
    return keyed.upsert_into(spark.createDataFrame(rows, ROWS), name, ["city", "day"], label(), ["n"])


def held(spark, name):
    return {(r.city, r.day): r.value for r in spark.table(name).collect()}


def files(spark, name):
    out = {}
    for path in spark.table(name).inputFiles():
        local = path.removeprefix("file://").removeprefix("file:")
        out.setdefault(os.path.basename(os.path.dirname(local)), set()).add((os.path.basename(local), os.stat(local).st_mtime_ns))
    return out


def test_batch_replaces_and_adds_by_key(spark, table):
    before, untouched = held(spark, table), files(spark, table)
    assert len(before) == 36
    new = [("a", dt.date(2024, 3, 1), 7, 1), ("a", dt.date(2024, 3, 1), 8, 2), (None, dt.date(2024, 3, 2), 9, 1), ("c", dt.date(2024, 9, 9), 5, 1)]
    assert load(spark, table, new) == ["p202403", "p202409"]
    want = before | {("a", dt.date(2024, 3, 1)): 8, (None, dt.date(2024, 3, 2)): 9, ("c", dt.date(2024, 9, 9)): 5}
    assert held(spark, table) == want and spark.table(table).count() == len(want)
    now = files(spark, table)
    assert {k for k in untouched if now[k] == untouched[k]} == {f"part=p2024{m:02d}" for m in (1, 2, 4, 5, 6)}
    load(spark, table, new)  # the same batch again
    assert held(spark, table) == want and spark.table(table).count() == len(want)
    assert load(spark, table, []) == [] and held(spark, table) == want


def test_only_touched_partitions_are_read(spark, table):
    rows = keyed.rows_of(spark, table, ["p202403"])
    assert all("part=p202403" in f for f in rows.inputFiles()) and rows.inputFiles()
    batch = spark.createDataFrame([("a", dt.date(2024, 3, 1), 7, "p202403")], "city string, day date, value int, part string")
    text = keyed.merged(rows, batch, ["city", "day"])._jdf.queryExecution().executedPlan().toString()
    assert "part#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_a_swap_that_died_is_finished(spark, table):
    want = held(spark, table)
    folder = scratch_path(spark, "swap")
    rows = keyed.rows_of(spark, table, ["p202402", "p202403"]).withColumn("value", F.lit(3))
    rows.write.partitionBy(PART).parquet(folder)
    set_property(spark, table, keyed.SWAP, folder)
    drop_partitions(spark, table, ["p202402"])  # one partition had been removed, none put in place
    assert load(spark, table, [("z", dt.date(2024, 6, 1), 4, 1)]) == ["p202406"]
    want |= {k: 3 for k in want if k[1].month in (2, 3)} | {("z", dt.date(2024, 6, 1)): 4}
    assert held(spark, table) == want
    assert table_property(spark, table, keyed.SWAP) is None
    assert list_partitions(spark, table) == [f"p2024{m:02d}" for m in range(1, 7)]


def test_rows_without_a_partition_are_refused(spark, table):
    want = held(spark, table)
    with pytest.raises(Exception, match="has no partition"):
        load(spark, table, [("a", None, 1, 1)])
    assert held(spark, table) == want


def test_the_mode_of_the_session_stays(spark, table):
    key = "spark.sql.sources.partitionOverwriteMode"
    assert spark.conf.get(key).lower() == "static"
    load(spark, table, [("a", dt.date(2024, 1, 1), 2, 1)])
    assert spark.conf.get(key).lower() == "static" and spark.table(table).count() == 36
