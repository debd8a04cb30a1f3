import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions import analytics, periods, tokens
from ledgerloom.functions.sizes import pretty_size


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_months(spark):
    leap, new_year = F.lit(dt.date(2024, 2, 29)), F.lit(dt.date(2024, 12, 31))
    assert one(
        spark,
        periods.month_start(leap),
        periods.shift_months(F.lit(dt.date(2023, 1, 31)), 1),
        periods.partition_label(new_year),
        F.lit(dt.date(2024, 1, 31)) + periods.months_interval(F.lit(" 1 ")),
    ) == (dt.date(2024, 2, 1), dt.date(2023, 2, 28), "p20241201", dt.date(2024, 2, 29))


@pytest.mark.parametrize(
    "as_of, months, expected",
    [
        (dt.date(2024, 1, 17), 24, dt.date(2022, 1, 1)),
        (dt.date(2024, 1, 1), 0, dt.date(2024, 1, 1)),
        (dt.date(2024, 1, 31), 1, dt.date(2023, 12, 1)),
        (dt.date(2024, 9, 5), -4, dt.date(2025, 1, 1)),
    ],
)
def test_cutoff(as_of, months, expected):
    assert periods.cutoff(as_of, months) == expected
    assert periods.label_month(periods.label_of(expected)) == expected


def test_half_open(spark):
    days = spark.sql("SELECT explode(array(date'2024-01-31', date'2024-02-01', date'2024-02-29', date'2024-03-01')) d")
    kept = days.filter(periods.half_open(F.col("d"), dt.date(2024, 2, 1), dt.date(2024, 3, 1))).collect()
    assert [r.d.day for r in kept] == [1, 29]


def test_codes_at_the_bucket_edges(spark):
    draws = [0.0, 0.2499, 0.25, 0.5, 0.59, 0.6, 0.75, 0.8999, 0.95, 0.999999999]
    df = spark.createDataFrame([(d,) for d in draws], "d double")
    d = F.col("d")
    rows = df.select(analytics.level_one(d), analytics.level_two(d), analytics.level_three(d)).collect()
    assert [r[0] for r in rows] == ["A", "A", "B", "C", "C", "C", None, None, None, None]
    assert [r[1] for r in rows] == [None] * 5 + ["XX"] * 5
    assert all(r[2] is None for r in rows)


def test_amount_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.0000005,), (0.0000015,), (0.0000025,), (0.999999999,)], "d double")
    amounts = [int(r[0]) for r in df.select(analytics.random_amount(F.col("d"))).collect()]
    assert amounts == [0, 200, 200, 100_000_000]


@pytest.mark.parametrize(
    "size, text",
    [
        (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10752, "11 kB"), (10751, "10 kB"),
        (10485247, "10239 kB"), (10485248, "10 MB"), (2428502016, "2316 MB"), (12 << 30, "12 GB"),
        (99 << 50, "99 PB"),
    ],
)
def test_pretty_size(spark, size, text):
    assert one(spark, pretty_size(F.lit(size))) == (text,)


def test_draws_do_not_depend_on_the_partitioning(spark):
    rows = spark.range(500).select(
        (F.col("id") * 7919).alias("state"),
        (F.col("id") * 104729 % 1000).alias("state_2"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 365).cast("int")).alias("day"),
        (F.col("id") % 10 + 1).cast("int").alias("n"),
    )
    names = ["a", "b"]
    first = tokens.with_draws(rows, ("state", "state_2"), "day", "n", names).orderBy("state").collect()
    again = tokens.with_draws(rows.repartition(5, "day"), ("state", "state_2"), "day", "n", names).orderBy("state").collect()
    assert first == again
    assert all(0 <= r.a < 1 and 0 <= r.b < 1 for r in first)
    assert 0.4 < sum(r.a for r in first) / 500 < 0.6


def test_draws_repeat_no_more_than_random_numbers_of_60_bits(spark):
    """2 million rows: 28 bits of state would repeat some 7,000 times, 60 bits never."""
    cells = spark.range(4000).withColumns(dict(zip(("s1", "s2"), tokens.cell_state(5, F.col("id")))))
    days = cells.withColumn("day", F.explode(F.expr("sequence(date'2023-01-01', date'2023-02-19')")))
    rows = days.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10))))
    names = ["a", "b", "c"]
    drawn = tokens.with_draws(rows, ("s1", "s2"), "day", "n", names)
    found = drawn.agg(
        F.count("*"), F.count_distinct(F.xxhash64(*names)), *[F.avg(n) for n in names], *[F.stddev_pop(n) for n in names],
        F.corr("a", "b"), F.corr("b", "c"), F.corr("a", F.col("n").cast("double")), F.corr("b", F.unix_date("day").cast("double")),
        *[F.count_distinct(n) for n in names],
    ).first()
    assert found[0] == found[1] == 2_000_000
    assert all(abs(x - 0.5) < 0.002 for x in found[2:5]) and all(abs(x - 12**-0.5) < 0.002 for x in found[5:8])
    assert all(abs(x) < 0.003 for x in found[8:12])
    # single words repeat as 31 random bits do: about 931 times in 2 million
    assert all(500 < 2_000_000 - x < 1500 for x in found[12:])
    own = Window.partitionBy("id", "day").orderBy("n")
    lags = drawn.select(*names, *[F.lag(n).over(own).alias(f"{n}_before") for n in names])
    assert all(abs(x) < 0.004 for x in lags.agg(*[F.corr(n, f"{n}_before") for n in names]).first())
    own = Window.partitionBy("id", "n").orderBy("day")
    lags = drawn.select(*names, *[F.lag(n).over(own).alias(f"{n}_before") for n in names])
    assert all(abs(x) < 0.004 for x in lags.agg(*[F.corr(n, f"{n}_before") for n in names]).first())
