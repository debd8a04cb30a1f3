"""Co-located tables: equal buckets for the fact and its rollup, so that they join
without a shuffle, with hot tenants spread over several buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.periods import month_start, shift_months
from ledgerloom.operators.dictionary import size_estimate
from ledgerloom.operators.layout import refresh_statistics
from ledgerloom.operators.rollup import CELL

BUCKETS = 32
# Bytes one bucket should hold, and the most buckets Spark allows by default.
BUCKET_BYTES = 1 << 30
MOST_BUCKETS = 100_000
SPLIT = "split"


def bucket_count(spark: SparkSession, table: str, least: int = BUCKETS) -> int:
    """Buckets for a stored table, by the size of its files: the usual number while
    it is small, more when a bucket would outgrow one task."""
    wanted = -(-refresh_statistics(spark, table, rows=False)["bytes"] // BUCKET_BYTES)
    return max(least, min(MOST_BUCKETS, wanted))


def hot_tenants(fact: DataFrame, key: str = "company_id", buckets: int = BUCKETS) -> DataFrame:
    """Tenants with more rows than an even bucket, and how many buckets each fills.
    There are at most ``buckets`` of them, whatever the number of tenants."""
    counts = fact.groupBy(key).agg(F.count("*").alias("row_cnt"))
    total = counts.agg(F.coalesce(F.sum("row_cnt"), F.lit(0))).scalar()
    return counts.filter(F.col("row_cnt") * buckets > total).select(
        key, F.ceil(F.col("row_cnt") * buckets / total).cast("int").alias("splits")
    )


def spread(fact: DataFrame, hot: DataFrame, by: list[str], key: str = "company_id") -> DataFrame:
    """Add the split number: rows of a hot tenant spread by their own hash, rows of
    all others have split 0."""
    number = F.pmod(F.xxhash64(*by), F.coalesce("splits", F.lit(1)).cast("bigint")).cast("int")
    return fact.join(F.broadcast(hot), key, "left").withColumn(SPLIT, number).drop("splits")


def repeated(rollup: DataFrame, hot: DataFrame, key: str = "company_id") -> DataFrame:
    """Repeat the rollup rows of a hot tenant once per split."""
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1))
    return rollup.join(F.broadcast(hot), key, "left").withColumn(SPLIT, numbers).drop("splits")


def write_buckets(df: DataFrame, table: str, key: str = "company_id", buckets: int = BUCKETS) -> None:
    """Write one sorted file per bucket; Spark's own hash decides the bucket."""
    (
        df.repartition(buckets, key, SPLIT)
        .write.bucketBy(buckets, key, SPLIT)
        .sortBy(key, SPLIT)
        .saveAsTable(table)
    )


def colocated_session(spark: SparkSession) -> SparkSession:
    """A session over the same catalog, with the caller's settings, in which two bucketed
    tables join where they lie although the join has more keys than the buckets. The
    setting is kept out of the caller's session: there it would let any join stay on a
    coarser key."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return session


def bucket_sums(fact: DataFrame, inclusive: bool = True) -> DataFrame:
    """The fact summed per tenant, split, account, month and code inside its buckets. A
    first of a month, which counts for two, is kept apart until it is summed."""
    day = F.col("transaction_dt")
    own = month_start(day)
    sums = fact.groupBy("company_id", SPLIT, "account_id", own.alias("month"), (day == own).alias("first_day"), "custom_1").agg(
        F.sum("amount").alias("detail")
    )
    months = F.array(F.col("month"))
    if inclusive:
        months = F.when(F.col("first_day"), F.array(F.col("month"), shift_months(F.col("month"), -1))).otherwise(months)
    each = sums.select("company_id", SPLIT, "account_id", "custom_1", "detail", F.explode(months).alias("period_dt"))
    return each.groupBy("company_id", SPLIT, "account_id", "period_dt", "custom_1").agg(F.sum("detail").alias("detail"))


# Bytes of the rollup's files per bucket up to which its rows are hashed, not sorted.
HASHED_BYTES = 64 << 20


def colocated_detail(rollup: DataFrame, fact: DataFrame, inclusive: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """Rollup total and detail total per analytic code, from two bucketed tables. The fact
    is summed where it lies, only its sums meet the rollup, in the same bucket, and only
    joined sums are shuffled, to add up a tenant's splits. The rollup, one row per cell and
    split, is hashed if a bucket of it is small, and sorted otherwise."""
    keys = ["company_id", SPLIT, "account_id", "period_dt"]
    small = size_estimate(rollup) <= HASHED_BYTES * buckets
    joined = rollup.hint("shuffle_hash" if small else "merge").join(bucket_sums(fact, inclusive), keys)
    return joined.groupBy(*CELL, "currency_code", F.col("amount").alias("amount_all"), "custom_1").agg(
        F.sum("detail").alias("amount_custom_1")
    )


def colocated_rollup(fact: DataFrame) -> DataFrame:
    """Monthly totals per split, computed inside the buckets (no shuffle)."""
    return fact.groupBy(
        "company_id", SPLIT, "account_id",
        month_start(F.col("transaction_dt")).alias("period_dt"), "currency_code",
    ).agg(F.sum("amount").alias("amount"))
