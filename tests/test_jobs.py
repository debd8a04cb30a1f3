"""Jobs that change tables: layout, backfill, cold move, retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import partitions as p
from ledgerloom.plans import ledger
from ledgerloom.schemas import FACT, ROLLUP
from ledgerloom.shared import scratch_namespace
from ledgerloom.sinks.tables import create_table, with_defaults

AS_OF = dt.date(2024, 1, 17)


def rows(spark, days, first_id=0):
    data = [(first_id + i, dt.date.fromisoformat(d), 1 + i % 3, "1.1", "", float(i), "RUR") for i, d in enumerate(days)]
    df = spark.createDataFrame(
        data,
        "transaction_id bigint, transaction_dt date, company_id int, account_id string, operation_type string,"
        " amount double, currency_code string",
    )
    return with_defaults(df.withColumn("amount", F.col("amount").cast("decimal(18,2)")), FACT)


def table(spark, label="t"):
    return create_table(spark, f"{scratch_namespace(spark, label)}.{FACT.name}", FACT, (p.PART,))


def counts(spark, name):
    return {r.part: r["count"] for r in spark.table(name).groupBy("part").count().collect()}


DAYS = ["2021-12-31", "2022-01-01", "2022-01-31", "2023-08-31", "2023-09-01", "2024-05-31", "2024-06-01", "2023-12-05"]


def test_months_outside_the_premade_window_go_to_default(spark):
    name = table(spark)
    p.write_assigned(rows(spark, DAYS), name, "transaction_dt", AS_OF)
    assert counts(spark, name) == {"default": 5, "p20230901": 1, "p20240501": 1, "p20231201": 1}
    report = p.backfill_report(rows(spark, DAYS), "transaction_dt", AS_OF)
    assert {r.target: r.rows_moved for r in report.collect()} == {
        "p20211201": 1, "p20220101": 2, "p20230801": 1, "p20240601": 1, "total": 5,
    }


def test_backfill_empties_default_and_keeps_all_rows(spark):
    name = table(spark)
    p.write_assigned(rows(spark, DAYS), name, "transaction_dt", AS_OF)
    p.backfill(spark, name, "transaction_dt")
    assert "default" not in p.list_partitions(spark, name)
    assert counts(spark, name) == {
        "p20211201": 1, "p20220101": 2, "p20230801": 1, "p20230901": 1, "p20231201": 1, "p20240501": 1, "p20240601": 1,
    }
    assert p.backfill(spark, name, "transaction_dt") == []


def test_backfill_after_a_crash_between_copy_and_drop(spark):
    name = table(spark)
    p.write_assigned(rows(spark, DAYS), name, "transaction_dt", AS_OF)
    # What a crash leaves behind: the mark of the run, some months copied, default full.
    waiting = spark.table(name).filter("part = 'default'").count()
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{p.RUNNING}' = '{waiting},0')")
    half = spark.table(name).filter("part = 'default' and transaction_dt < date'2022-02-01'")
    p.write_monthly(half.drop("part"), name, "transaction_dt")
    assert spark.table(name).count() == len(DAYS) + 3
    p.backfill(spark, name, "transaction_dt")
    assert spark.table(name).count() == len(DAYS)
    assert spark.table(name).agg(F.countDistinct("transaction_id")).first()[0] == len(DAYS)


def test_backfill_adds_to_a_month_that_has_rows(spark):
    name = table(spark)
    p.write_assigned(rows(spark, ["2022-01-05", "2022-01-06"]), name, "transaction_dt", AS_OF)
    p.write_monthly(rows(spark, ["2022-01-07"], first_id=10), name, "transaction_dt")
    p.backfill(spark, name, "transaction_dt")
    assert counts(spark, name) == {"p20220101": 3}


def hot_and_cold(spark):
    hot, cold = table(spark, "hot"), table(spark, "cold")
    p.write_assigned(rows(spark, DAYS), hot, "transaction_dt", AS_OF)
    return hot, cold


def test_cold_move_is_exact_at_the_cutoff_and_repeatable(spark):
    hot, cold = hot_and_cold(spark)
    # The cutoff of 24 months before January 2024 is 2022-01-01: that day stays hot.
    moved = ledger.move_to_cold(spark, hot, cold, AS_OF, 24).collect()
    assert [(r.part, r.source_rows, r.target_rows, r.dropped) for r in moved] == [("p20211201", 1, 1, True)]
    assert counts(spark, cold) == {"p20211201": 1}
    assert spark.table(hot).count() == len(DAYS) - 1
    before = (counts(spark, hot), counts(spark, cold))
    assert ledger.move_to_cold(spark, hot, cold, AS_OF, 24).collect() == []
    assert (counts(spark, hot), counts(spark, cold)) == before


def test_cold_move_after_a_crash_and_with_late_rows(spark):
    hot, cold = hot_and_cold(spark)
    p.backfill(spark, hot, "transaction_dt")
    old = spark.table(hot).filter("part = 'p20220101'").limit(1)
    # A crash left one of two rows in the archive and dropped nothing.
    p.write_monthly(old.drop("part"), cold, "transaction_dt")
    ledger.move_to_cold(spark, hot, cold, AS_OF, 23)
    assert counts(spark, cold) == {"p20211201": 1, "p20220101": 2}
    # A late row of a month that has been moved and dropped: nothing is lost.
    p.write_assigned(rows(spark, ["2022-01-20"], first_id=100), hot, "transaction_dt", AS_OF)
    moved = ledger.move_to_cold(spark, hot, cold, AS_OF, 23).collect()
    assert [(r.part, r.source_rows, r.target_rows, r.dropped) for r in moved] == [("p20220101", 1, 3, True)]
    assert counts(spark, cold) == {"p20211201": 1, "p20220101": 3}
    assert spark.table(hot).count() + spark.table(cold).count() == len(DAYS) + 1


def test_cold_move_after_a_crash_before_the_catalog_entry(spark):
    hot, cold = hot_and_cold(spark)
    p.backfill(spark, hot, "transaction_dt")
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {cold}").filter("col_name = 'Location'").first().data_type
    # Files that were moved into place, in a folder the catalog has not entered.
    spark.table(hot).filter("part = 'p20220101'").drop("part").write.parquet(f"{place}/part=p20220101")
    assert p.list_partitions(spark, cold) == []
    ledger.move_to_cold(spark, hot, cold, AS_OF, 23)
    assert counts(spark, cold) == {"p20211201": 1, "p20220101": 2}


def test_cold_move_keeps_a_month_that_does_not_agree(spark, monkeypatch):
    hot, cold = hot_and_cold(spark)
    real = p.append_rows
    # An archive that loses a row on the way.
    monkeypatch.setattr(p, "append_rows", lambda df, name: real(df.filter("transaction_dt <> date'2022-01-31'") if name == cold else df, name))
    moved = {r.part: r.dropped for r in ledger.move_to_cold(spark, hot, cold, AS_OF, 23).collect()}
    assert moved == {"p20211201": True, "p20220101": False}
    assert counts(spark, hot)["p20220101"] == 2
    monkeypatch.setattr(p, "append_rows", real)
    ledger.move_to_cold(spark, hot, cold, AS_OF, 23)
    assert counts(spark, cold) == {"p20211201": 1, "p20220101": 2}
    assert "p20220101" not in counts(spark, hot)


def test_retention_drops_old_months_only(spark):
    name = table(spark)
    p.write_assigned(rows(spark, DAYS), name, "transaction_dt", AS_OF)
    p.write_monthly(rows(spark, ["2022-01-05"], first_id=50), name, "transaction_dt")
    # rows that wait in default go into their months first, and the old ones go
    assert p.apply_retention(spark, name, AS_OF, 12) == ["p20211201", "p20220101"]
    left = counts(spark, name)
    assert "default" not in left and min(left) == "p20230801" and sum(left.values()) == 5


def test_one_month_with_a_third_of_the_rows_is_written_whole(spark):
    days = F.when(F.col("id") % 3 == 0, F.lit(dt.date(2023, 5, 1))).otherwise(
        F.date_add(F.lit(dt.date(2022, 1, 1)), (F.col("id") % 700).cast("int"))
    )
    many = spark.range(30000).select(
        F.col("id").alias("transaction_id"), days.alias("transaction_dt"), F.lit(1).alias("company_id"),
        F.lit("1").alias("account_id"), F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("RUR").alias("currency_code"),
    )
    hot, cold = table(spark, "hot"), table(spark, "cold")
    p.write_monthly(with_defaults(many, FACT), hot, "transaction_dt")
    ledger.move_to_cold(spark, hot, cold, dt.date(2024, 1, 1), 6)
    both = ledger.both_parts(spark, hot, cold, keyed=True)
    assert both.agg(F.count("*"), F.countDistinct("transaction_id")).first() == (30000, 30000)
    assert spark.table(hot).agg(F.min("transaction_dt")).first()[0] == dt.date(2023, 7, 1)


def test_both_parts_shuffles_only_months_in_both_tables(spark):
    hot, cold = hot_and_cold(spark)
    ledger.move_to_cold(spark, hot, cold, AS_OF, 23)
    plan = ledger.both_parts(spark, hot, cold, keyed=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # A month that came back: one row is in both tables, one is new.
    again = spark.table(cold).filter("transaction_dt = date'2022-01-31'").drop("part")
    p.write_monthly(again, hot, "transaction_dt")
    p.write_monthly(rows(spark, ["2022-01-20"], first_id=100), hot, "transaction_dt")
    for keyed in (True, False):
        both = ledger.both_parts(spark, hot, cold, keyed)
        assert both.agg(F.count("*"), F.countDistinct("transaction_id")).first() == (len(DAYS) + 1, len(DAYS) + 1)


@pytest.fixture(scope="module")
def year(spark):
    """The published data set: ten companies, seventy accounts, all days of 2023."""
    from ledgerloom import seeds

    companies, accounts = seeds.companies(spark), seeds.accounts(spark)
    name = table(spark, "year")
    full = ledger.generate(companies, accounts, dt.date(2023, 1, 1), dt.date(2023, 12, 31), seed=42)
    p.write_assigned(full, name, "transaction_dt", AS_OF)
    head = ledger.generate(
        companies.filter("company_id = 1"), accounts, dt.date(2024, 1, 1), dt.date(2024, 12, 31), seed=43,
        existing=spark.table(name),
    )
    p.write_assigned(head, name, "transaction_dt", AS_OF)
    return name


def test_generated_year(spark, year):
    from ledgerloom import seeds

    df = spark.table(year)
    total, keys, low, high = df.agg(
        F.count("*"), F.countDistinct("transaction_id"), F.min("transaction_id"), F.max("transaction_id")
    ).first()
    assert (keys, low, high) == (total, 1, total)
    first = df.filter("transaction_dt < date'2024-01-01'").count()
    # Three in four of 10 × 70 × 365 × 10 cells, within five standard deviations.
    assert abs(first - 1_916_250) < 5 * (2_555_000 * 0.75 * 0.25) ** 0.5
    assert abs(total - first - 192_150) < 5 * (256_200 * 0.75 * 0.25) ** 0.5
    assert df.filter("custom_2 = 'ZZ' or custom_3 is not null").count() == 0
    assert seeds.companies(spark).count() == 10 and seeds.accounts(spark).count() == 70
    assert seeds.accounts(spark).filter("parent_account_id is null").count() == 9


def test_rollup_and_report_of_the_year(spark, year):
    from ledgerloom import seeds

    rollup = create_table(spark, f"{scratch_namespace(spark)}.acc_aggregate", ROLLUP, (p.PART,))
    p.backfill(spark, year, "transaction_dt")
    ledger.load_rollup(spark, year, rollup)
    assert spark.table(rollup).count() == 9240
    answer = ledger.month_report(
        spark, year, rollup, seeds.companies(spark), seeds.accounts(spark), dt.date(2023, 10, 1),
        company_id=5, parent_account="1",
    ).collect()
    assert len(answer) == 56
    whole, parts = {}, {}
    for r in answer:
        whole[r.account_description] = r.amount_all
        parts[r.account_description] = parts.get(r.account_description, 0) + r.amount_custom_1
    assert len(whole) == 14 and all(parts[a] > whole[a] for a in whole)
