import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit, shards
from ledgerloom.operators.dictionary import MOST_BLOCKS, fragments, grid, replicate_if_small
from ledgerloom.operators.keys import continued_key, dense_key
from ledgerloom.operators.rollup import monthly_rollup, report
from ledgerloom.operators.union import filtered_view, full_view
from ledgerloom.operators.upsert import keep_last, upsert

FACT = "transaction_id bigint, transaction_dt date, company_id int, account_id string, amount decimal(18,2), currency_code string, custom_1 string"


def facts(spark, rows):
    return spark.createDataFrame(
        [(i, day, c, a, amount, cur, code) for i, (day, c, a, amount, cur, code) in enumerate(rows)], FACT
    )


def d(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def ledger(spark):
    from decimal import Decimal as D

    return facts(spark, [
        (d("2024-01-31"), 1, "1.1", D("10.00"), "RUR", "A"),
        (d("2024-02-01"), 1, "1.1", D("20.00"), "RUR", "A"),
        (d("2024-02-29"), 1, "1.1", D("40.00"), "RUR", None),
        (d("2024-02-29"), 1, "1.1", D("60.00"), "EUR", None),
        (d("2024-03-01"), 1, "1.1", D("80.00"), "RUR", "A"),
        (d("2024-03-31"), 1, "1.1", D("160.00"), "RUR", "B"),
        (d("2024-03-01"), 2, "1.1", D("5.00"), "RUR", "A"),
    ])


def test_rollup_separates_currencies_and_months(ledger):
    rows = {
        (r.company_id, str(r.period_dt), r.currency_code): float(r.amount) for r in monthly_rollup(ledger).collect()
    }
    assert rows == {
        (1, "2024-01-01", "RUR"): 10, (1, "2024-02-01", "RUR"): 60, (1, "2024-02-01", "EUR"): 60,
        (1, "2024-03-01", "RUR"): 240, (2, "2024-03-01", "RUR"): 5,
    }


def brute_report(rows, inclusive, names):
    """Nested loops over rollup rows and fact rows, then the grouping."""
    totals = {}
    for r in rows:
        key = (r.company_id, r.account_id, r.transaction_dt.replace(day=1), r.currency_code)
        totals[key] = totals.get(key, 0) + r.amount
    out = {}
    for (company, account, month, _), total in totals.items():
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        for r in rows:
            day = r.transaction_dt
            inside = month <= day <= end if inclusive else month <= day < end
            if (r.company_id, r.account_id) == (company, account) and inside:
                key = (names[company], "account " + account, total, r.custom_1)
                out[key] = out.get(key, 0) + r.amount
    return out


@pytest.mark.parametrize("inclusive", [True, False])
def test_report_equals_nested_loops(spark, ledger, inclusive):
    names = {1: "one", 2: "two"}
    companies = spark.createDataFrame(list(names.items()), "company_id int, company_name string")
    accounts = spark.createDataFrame([("1.1", "1", "account 1.1")], "account_id string, parent_account_id string, account_description string")
    got = report(ledger, companies, accounts, inclusive=inclusive).collect()
    assert {tuple(r)[:2] + (r.amount_all, r.custom_1): r.amount_custom_1 for r in got} == brute_report(
        ledger.collect(), inclusive, names
    )
    # A stored rollup gives the same answer; nulls sort last within a total's rows.
    stored = report(ledger, companies, accounts, rollup=monthly_rollup(ledger), inclusive=inclusive).collect()
    assert stored == got
    order = [(r.company_name, r.account_description, r.custom_1 is None, r.custom_1 or "") for r in got]
    assert order == sorted(order)
    month = report(ledger, companies, accounts, inclusive=inclusive, company_id=1, parent_account="1", period=d("2024-02-01"))
    total = sum(r.amount_custom_1 for r in month.collect())
    # Two currencies with equal totals fall into one group, so each detail counts twice.
    assert float(total) == (2 * (120 + 80) if inclusive else 2 * 120)


def test_dense_key_follows_the_order_without_gaps(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") * 17 % 5000).alias("k"), F.lit("x").alias("v"))
    keyed = dense_key(rows, "n", ["k"], slice_rows=1000).collect()
    assert sorted((r.n, r.k) for r in keyed) == [(i + 1, i) for i in range(5000)]


def test_dense_key_with_one_hot_order_value(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("hot"), "id")
    keyed = dense_key(rows, "n", ["hot", "id"], slice_rows=500)
    assert keyed.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 3000, 3000)
    expected = sorted((r.hot, r.id) for r in keyed.collect())
    assert [(r.hot, r.id) for r in sorted(keyed.collect(), key=lambda r: r.n)] == expected


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_slices_follow_the_rows_even_with_a_single_order_value(spark, partitions):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, partitions)
    try:
        for rows, slices in ((4000, 4), (16000, 16)):
            one = spark.range(rows).select(F.lit(7).alias("k"), "id")
            keyed = dense_key(one, "n", ["k"], slice_rows=1000)
            sizes = [r["count"] for r in keyed.groupBy(F.ceil(F.col("n") / 10**9)).count().collect()]
            files = keyed.inputFiles()
            assert len(files) == slices and sizes == [rows]
            held = spark.read.parquet(*files).groupBy(F.col("_metadata.file_name")).count().collect()
            assert max(r["count"] for r in held) < 2000
            assert keyed.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, rows, rows)
    finally:
        spark.conf.set(key, before)


def test_offsets_of_many_files_add_up_over_groups(spark, monkeypatch):
    from ledgerloom.operators import keys

    monkeypatch.setattr(keys, "GROUP", 4)
    rows = spark.range(0, 3000, 1, 23).filter("id % 7 <> 0")
    found = sorted((r.n, r.id) for r in dense_key(rows, "n").collect())
    assert found == [(i + 1, x) for i, x in enumerate(x for x in range(3000) if x % 7)]


def test_dense_key_unordered_and_continued(spark):
    first = dense_key(spark.range(0, 1000, 1, 9).toDF("id"), "n")
    assert first.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 1000, 1000)
    more = continued_key(spark.range(50).toDF("id"), "n", first.select("n"))
    assert sorted(r.n for r in more.collect()) == list(range(1001, 1051))
    empty = continued_key(spark.range(5).toDF("id"), "n", first.select("n").limit(0))
    assert sorted(r.n for r in empty.collect()) == [1, 2, 3, 4, 5]


def test_keep_last_of_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.col("id").alias("loaded"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"),
    )
    got = {r.k: (r.loaded, r.v) for r in keep_last(rows, ["k"], ["loaded"]).collect()}
    want = {}
    for r in sorted(rows.collect(), key=lambda r: r.loaded):
        want[r.k] = (r.loaded, r.v)
    assert got == want and got["hot"] == (999, None)


def test_upsert_replaces_and_adds(spark):
    table = spark.createDataFrame([("a", d("2024-01-01"), 1.0), ("b", d("2024-01-01"), 2.0)], "c string, day date, t double")
    batch = spark.createDataFrame([("a", d("2024-01-01"), None), ("a", d("2024-01-02"), 3.0)], "c string, day date, t double")
    rows = sorted(tuple(r) for r in upsert(table, batch, ["c", "day"]).collect())
    assert rows == [("a", d("2024-01-01"), None), ("a", d("2024-01-02"), 3.0), ("b", d("2024-01-01"), 2.0)]


def test_union_keeps_each_row_once(spark):
    hot = spark.createDataFrame([(1, None), (1, None), (2, "b")], "k int, v string")
    cold = spark.createDataFrame([(2, "b"), (3, None)], "k int, v string")
    assert sorted(r.k for r in full_view(hot, cold).collect()) == [1, 2, 3]
    assert sorted(r.k for r in full_view(hot, cold, disjoint=True).collect()) == [1, 1, 2, 2, 3]
    assert sorted(r.k for r in filtered_view(hot, cold, F.col("k") > 1).collect()) == [2, 3]


def test_grid_is_the_full_product(spark):
    left = spark.range(7).select(F.col("id").alias("a"))
    right = spark.range(11).select(F.col("id").cast("string").alias("b"))
    for task_rows in (1, 5, 20, 1000):
        got = sorted((r.a, r.b) for r in grid(left, right, task_rows=task_rows).collect())
        assert got == sorted((a, str(b)) for a, b in itertools.product(range(7), range(11)))
    assert grid(left, right.filter("b = 'none'")).count() == 0 and grid(left.filter("a < 0"), right).count() == 0


def test_tasks_of_a_product_grow_with_it(spark):
    assert fragments(10, 50, 500) == (1, 1) and fragments(0, 5, 0) == (1, 1)
    for left, right, weight in ((1000, 1000, 1), (10, 100_000, 4), (1, 10**7, 1), (10**6, 10**6, 1), (3, 5, 10**9)):
        a, b = fragments(left, right, left * right * weight, task_rows=1000)
        wanted = min(MOST_BLOCKS, left * right, left * right * weight // 1000)
        assert a <= left and b <= right and wanted <= a * b <= 2 * wanted + a + b
    sizes = []
    for n in (100, 200, 400):
        left, right = spark.range(n).toDF("a"), spark.range(n).toDF("b")
        product = grid(left, right, task_rows=5000)
        counts = [r["count"] for r in product.groupBy(F.spark_partition_id()).count().collect()]
        sizes.append(len(counts))
        assert sum(counts) == n * n and max(counts) < 4 * 5000
    assert sizes[0] >= 2 and 3 <= sizes[1] / sizes[0] <= 5 and 3 <= sizes[2] / sizes[1] <= 5


def test_replication_depends_on_the_size(spark):
    small, large = spark.range(100), spark.range(100_000_000)
    def plan(side):
        joined = spark.range(10).join(replicate_if_small(side, limit=1 << 20), "id")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(small) and "broadcast" not in plan(large)


# Published segment counts and the two figures computed from them.
SEGMENTS = [3043484, 3046116, 3042351, 3045318, 3043230, 3040703, 3046047, 3041808, 3041737]


def test_skew_of_published_counts(spark):
    counts = spark.createDataFrame([(n,) for n in SEGMENTS], "row_cnt bigint")
    r = shards.skew(counts).first()
    assert (r.segments, r.row_cnt) == (9, 27390794)
    assert abs(r.skew_coefficient - 0.065476864453392) < 1e-12
    assert abs(r.idle_fraction - 0.000884550832747) < 1e-12


def test_audits(spark):
    rows = spark.createDataFrame(
        [(1, "abc"), (1, "abcdef"), (None, None), (None, "x"), (2, "")], "k int, t string"
    )
    assert sorted((r.k or 0, r.cnt) for r in audit.duplicate_keys(rows, ["k"]).collect()) == [(0, 2), (1, 2)]
    assert {r.column_name: r.null_cnt for r in audit.null_counts(rows, ["k", "t"]).collect()} == {"k": 2, "t": 1}
    assert [tuple(r) for r in audit.length_violations(rows, {"t": 3}).collect()] == [("t", 6, 3, 1)]
    both = audit.conservation({"a": rows, "b": rows.filter("k = 1")}, ["k"]).collect()
    assert {r.k: (r.a_rows, r.b_rows) for r in both if r.k} == {1: (2, 2), 2: (1, 0)}
