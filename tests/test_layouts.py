"""Clustering, listing, defaults, sums in buckets, and a rollup that may run again."""

import datetime as dt
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom import bindings
from ledgerloom.operators import colocation, layout, partitions
from ledgerloom.operators.partitions import PART
from ledgerloom.plans.ledger import create_ledger, load_rollup
from ledgerloom.registry.base import cells_sql
from ledgerloom.registry.layout import bucketed_ledger
from ledgerloom.schemas import COMPANIES
from ledgerloom.shared import scratch_namespace
from ledgerloom.sinks import tables
from ledgerloom.sources.listing import list_files, listed_sizes, listed_table


def groups(path, column, low, high):
    """Row groups whose statistics allow a value in the range, and all row groups."""
    hit = total = 0
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            meta = pq.ParquetFile(f"{path}/{name}").metadata
            place = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
            for g in range(meta.num_row_groups):
                own = meta.row_group(g).column(place).statistics
                total += 1
                hit += own.min <= high and own.max >= low
    return hit, total


def test_either_column_of_a_clustered_table_skips_row_groups(spark, tmp_path):
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).cast("int").alias("company_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("int")).alias("day"),
        F.sha1(F.col("id").cast("string")).alias("text"),
    )
    day = dt.date(2021, 5, 5)
    by_both, by_one = str(tmp_path / "z"), str(tmp_path / "s")
    written = layout.rewrite_clustered(rows, by_both, ["company_id", "day"], file_rows=15_000, group_bytes=1 << 16)
    layout.rewrite_columnar(rows, by_one, ["company_id", "day"], 8).count()
    assert written.count() == 120_000
    company, total = groups(by_both, "company_id", 77, 77)
    on_day, _ = groups(by_both, "day", day, day)
    hot, _ = groups(by_both, "company_id", 500, 500)
    assert total > 40 and company < total / 4 and on_day < total / 4 and hot < total / 2
    spread, all_groups = groups(by_one, "day", day, day)
    assert spread / all_groups > 2 * on_day / total  # sorted by company alone, a day is nearly everywhere
    for wanted in (F.col("company_id") == 77, F.col("day") == F.lit(day)):
        assert written.filter(wanted).count() == rows.filter(wanted).count()
        text = written.filter(wanted)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(" in text and "EqualTo(" in text


def test_clustering_of_few_and_null_values(spark, tmp_path):
    rows = spark.createDataFrame([(None, None), (1, None), (1, dt.date(2020, 1, 1))] * 5, "a int, d date")
    assert sorted(map(repr, layout.rewrite_clustered(rows, str(tmp_path / "x"), ["a", "d"]).collect())) == sorted(map(repr, rows.collect()))
    assert layout.rewrite_clustered(rows.filter("1 = 0"), str(tmp_path / "y"), ["a", "d"]).count() == 0


def test_listing_agrees_with_the_files_and_reads_none(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1000).withColumn("part", F.col("id") % 4).write.partitionBy("part").parquet(str(path))
    on_disk = {int(d.name.split("=")[1]): [f.stat().st_size for f in d.glob("*.parquet")] for d in path.glob("part=*")}
    files = list_files(spark, str(path))
    sizes = {r.part: (r.file_cnt, r.size_bytes) for r in listed_sizes(files, ["part"]).collect()}
    assert sizes == {p: (len(s), sum(s)) for p, s in on_disk.items()}
    for d in path.glob("part=*"):  # listed all the same when the files hold nothing that can be read
        for f in d.glob("*.parquet"):
            f.write_bytes(b"?" * f.stat().st_size)
    assert {r.part: r.size_bytes for r in listed_sizes(list_files(spark, str(path)), ["part"]).collect()} == {p: sum(s) for p, s in on_disk.items()}
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_defaults_lie_in_the_catalog(spark):
    name = tables.create_table(spark, f"{scratch_namespace(spark)}.c", COMPANIES)
    assert set(tables.declared_defaults(spark, name)) == {"dttm_start", "dttm_end"}
    tables.insert_omitting(spark.createDataFrame([(1, "x")], "company_id int, company_name string"), name)
    spark.sql(f"INSERT INTO {name} (company_id, dttm_end) VALUES (2, NULL), (3, TIMESTAMP_NTZ'2001-02-03 00:00:00')")
    rows = {r.company_id: (r.company_name, r.dttm_start, r.dttm_end) for r in spark.table(name).collect()}
    start = dt.datetime(1900, 1, 1)
    assert rows == {1: ("x", start, dt.datetime(3000, 12, 31)), 2: (None, start, None), 3: (None, start, dt.datetime(2001, 2, 3))}


def test_detail_is_summed_in_its_bucket_before_the_join(spark, sf_dir):
    from oracle import connect

    fact, rollup = bucketed_ledger(spark, sf_dir)
    spark.conf.set("spark.sql.files.openCostInBytes", "3m")
    try:
        session = colocation.colocated_session(spark)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert session.conf.get("spark.sql.files.openCostInBytes") == "3m"
    assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    sums = colocation.bucket_sums(session.table(fact))
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    joined = colocation.colocated_detail(session.table(rollup), session.table(fact))
    text = joined._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Join"):]
    assert below.count("HashAggregate") >= 4 and "Exchange" not in below
    want = {tuple(r[:5]): r[5:] for r in connect(sf_dir).execute(cells_sql()).fetchall()}
    got = {(r.company_id, r.account_id, r.period_dt, r.currency_code, r.custom_1): (float(r.amount_all), float(r.amount_custom_1)) for r in joined.collect()}
    assert got == want


def part_files(spark, table):
    found = {}
    for r in listed_table(spark, table).collect():
        found.setdefault(r[PART], set()).add((r.path, r.modificationTime))
    return found


def totals(spark, table):
    return {(r.company_id, r.account_id, r.period_dt): r.amount for r in spark.table(table).collect()}


def brute(rows):
    out = {}
    for r in rows:
        key = (r.company_id, r.account_id, r.transaction_dt.replace(day=1))
        out[key] = out.get(key, 0) + r.amount
    return out


@pytest.fixture
def ledger(spark, sf_dir):
    fact, rollup = create_ledger(spark, scratch_namespace(spark))
    rows = bindings.fact(spark, sf_dir).filter("transaction_dt between '1998-01-01' and '1998-04-30'")
    partitions.write_monthly(rows, fact, "transaction_dt")
    return fact, rollup, rows


def test_a_second_load_changes_nothing(spark, ledger):
    fact, rollup, rows = ledger
    assert load_rollup(spark, fact, rollup) == [f"p19980{m}01" for m in (1, 2, 3, 4)]
    want, files = brute(rows.collect()), part_files(spark, rollup)
    assert totals(spark, rollup) == want
    assert load_rollup(spark, fact, rollup) == []
    assert totals(spark, rollup) == want and part_files(spark, rollup) == files


def test_only_months_that_changed_are_summed_anew(spark, ledger):
    fact, rollup, rows = ledger
    load_rollup(spark, fact, rollup)
    files = part_files(spark, rollup)
    more = rows.filter("transaction_dt between '1998-02-01' and '1998-02-15'")
    partitions.write_monthly(more, fact, "transaction_dt")
    assert load_rollup(spark, fact, rollup) == ["p19980201"]
    assert totals(spark, rollup) == brute(rows.collect() + more.collect())
    now = part_files(spark, rollup)
    assert {p for p in now if now[p] != files[p]} == {"p19980201"}
    partitions.drop_partitions(spark, fact, ["p19980101"])
    load_rollup(spark, fact, rollup)
    assert totals(spark, rollup) == brute(rows.filter("transaction_dt >= '1998-02-01'").collect() + more.collect())


def test_rows_that_wait_in_default_count_for_their_months(spark, ledger):
    fact, rollup, rows = ledger
    load_rollup(spark, fact, rollup)
    waiting = rows.filter("day(transaction_dt) = 3").withColumn(PART, F.lit(partitions.DEFAULT))
    tables.append_rows(waiting, fact)
    want = brute(rows.collect() + waiting.collect())
    load_rollup(spark, fact, rollup)
    assert totals(spark, rollup) == want
    again = rows.filter("transaction_dt = '1998-03-09'")
    partitions.write_monthly(again, fact, "transaction_dt")
    assert load_rollup(spark, fact, rollup) == ["p19980301"]
    want = brute(rows.collect() + waiting.collect() + again.collect())
    assert totals(spark, rollup) == want
    partitions.backfill(spark, fact, "transaction_dt")
    load_rollup(spark, fact, rollup)
    assert totals(spark, rollup) == want


def test_partition_sizes_are_of_the_ledger_and_every_partition(spark, sf_dir):
    from ledgerloom import registry

    rows = registry.QUERIES["ledger_partition_sizes"](spark, sf_dir).collect()
    counts = {r["part"]: r["row_cnt"] for r in registry.QUERIES["layout_rows"](spark, sf_dir).collect()}
    assert {r["name"]: r["row_cnt"] for r in rows} == {"acc_data": sum(counts.values())} | {f"acc_data_{p}": n for p, n in counts.items()}
    assert any(p >= "p2000" for p in counts) and all(r["same_bytes"] and r["labelled"] for r in rows)
    assert rows[0]["name"] == "acc_data" and rows[0]["size_bytes"] == sum(r["size_bytes"] for r in rows[1:])
    assert [r["size_bytes"] for r in rows] == sorted((r["size_bytes"] for r in rows), reverse=True)
    assert all(re.fullmatch("[0-9]+ (bytes|kB|MB|GB|TB|PB)", r["size"]) for r in rows)
