"""Assertions on physical plans."""

import re

import pytest

import __spark_entry__ as entry
from ledgerloom import bindings
from ledgerloom.operators import colocation, partitions
from ledgerloom.operators.rollup import monthly_rollup, report
from ledgerloom.registry.base import stored_ledger
from ledgerloom.registry.layout import bucketed_ledger


def plan(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


def test_report_scans_the_fact_once(spark, sf_dir):
    text = plan(entry.queries()["ledger_report_inclusive"](spark, sf_dir), run=True)
    assert sum("l_extendedprice" in s for s in scans(text)) == 1
    assert "ReusedExchange" in text


def test_report_of_one_month_scans_the_fact_once(spark, sf_dir):
    import datetime as dt

    sides = [f(spark, sf_dir) for f in (bindings.fact, bindings.companies, bindings.accounts)]
    for inclusive in (True, False):
        text = plan(report(*sides, inclusive=inclusive, period=dt.date(1998, 3, 1)), run=True)
        assert sum("l_extendedprice" in s for s in scans(text)) == 1


def test_tenant_filter_reaches_the_scan_of_sorted_files(spark, sf_dir):
    text = plan(entry.queries()["ledger_tenant_rows"](spark, sf_dir))
    assert "EqualTo(company_id,1)" in text and "Exchange" not in text and "Join" not in text
    files = stored_ledger(spark, sf_dir).select("company_id", "_metadata.file_path", "_metadata.row_index")
    by_file: dict = {}
    for r in files.orderBy("file_path", "row_index").collect():
        by_file.setdefault(r.file_path, []).append(r.company_id)
    assert all(c == sorted(c) for c in by_file.values())


def test_joins_fall_back_to_shuffles_when_nothing_is_small(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(entry.queries()["ledger_report_inclusive"](spark, sf_dir), run=True)
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert "SortMergeJoin" in text
    assert sum("l_extendedprice" in s for s in scans(text)) == 1


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_products_or_python_workers(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "ArrowEval" not in text


def test_weather_reads_only_its_columns(spark, sf_dir):
    queries = entry.queries()
    (count,) = scans(plan(queries["weather_count"](spark, sf_dir)))
    assert "ReadSchema: struct<>" in count
    (city,) = scans(plan(queries["weather_by_city"](spark, sf_dir)))
    assert "FileScan parquet [event_type#" in city
    point = plan(queries["weather_point"](spark, sf_dir))
    assert "Exchange" not in point
    assert "GreaterThanOrEqual(ts," in point and "EqualTo(event_type,purchase)" in point


def test_rollup_sums_before_the_shuffle(spark, sf_dir):
    text = plan(monthly_rollup(bindings.fact(spark, sf_dir)))
    assert text.index("functions=[sum(") < text.index("Exchange hashpartitioning") < text.index("partial_sum")


def test_day_range_prunes_partitions_on_both_sides_of_a_union(spark, sf_dir):
    import datetime as dt

    from ledgerloom.operators.union import full_view

    stored = stored_ledger(spark, sf_dir)
    both = full_view(stored, stored.filter("company_id > 0"))
    text = plan(partitions.read_days(both, "transaction_dt", dt.date(1998, 3, 15), dt.date(1998, 5, 10)))
    for scan in scans(text):
        filters = re.search(r"PartitionFilters: \[(.*?)\]", scan).group(1)
        assert "part" in filters
    assert len(scans(text)) == 2


def test_no_file_split_is_gathered_before_equal_rows_are_told_apart(spark, sf_dir):
    from ledgerloom.operators.union import filtered_view, full_view

    stored = stored_ledger(spark, sf_dir)
    for view in (full_view(stored, stored), filtered_view(stored, stored, stored["company_id"] > 0)):
        text = plan(view)
        below = text[text.index("Exchange hashpartitioning"):]
        assert text.count("Exchange") == 1 and "Aggregate" not in below and "Aggregate" in text


def test_bucketed_tables_join_without_a_shuffle(spark, sf_dir):
    fact, rollup = bucketed_ledger(spark, sf_dir)
    session = colocation.colocated_session(spark)
    joined = colocation.colocated_detail(session.table(rollup), session.table(fact))
    text = plan(joined, run=True)
    below = text[text.index("HashJoin"):]
    assert "Exchange" not in below and "NestedLoop" not in text
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_hot_tenants_are_bounded_by_the_buckets(spark):
    from pyspark.sql import functions as F

    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 500 + 2)).cast("int").alias("company_id"),
        F.col("id").alias("transaction_id"),
    )
    hot = colocation.hot_tenants(rows, buckets=8).collect()
    assert [(r.company_id, r.splits) for r in hot] == [(1, 3)]
    spread = colocation.spread(rows, colocation.hot_tenants(rows, buckets=8), ["transaction_id"])
    sizes = {(r.company_id, r.split): r["count"] for r in spread.groupBy("company_id", "split").count().collect()}
    assert sum(sizes.values()) == 9000
    assert all(abs(sizes[(1, i)] - 1000) < 200 for i in range(3))
