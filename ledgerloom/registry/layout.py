"""Layout queries: partitions, skew, sizes, buckets and co-location."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import bindings
from ledgerloom.functions.sizes import pretty_size
from ledgerloom.operators import colocation, layout, partitions, shards
from ledgerloom.registry import register
from ledgerloom.registry.base import (
    ACC_DATA, HEAD_COMPANY, LABEL_SQL, PREMADE_AS_OF, SHOWN_SQL,
    cells_sql, shown, stored_ledger, stored_ledger_name,
)
from ledgerloom.shared import scratch_namespace, scratch_path
from ledgerloom.sources.listing import listed_sizes, listed_table
from ledgerloom.sources.literals import literal_rows

FIRST_PREMADE, LAST_PREMADE = partitions.premade_window(PREMADE_AS_OF)

ASSIGNED_SQL = f"""CASE WHEN date_trunc('month', transaction_dt) BETWEEN DATE '{FIRST_PREMADE}'
                         AND DATE '{LAST_PREMADE}' THEN {LABEL_SQL} ELSE 'default' END"""


# --- partitions --------------------------------------------------------------

@register("ledger_partition_assignment", f"""
WITH {ACC_DATA}
SELECT 'acc_data_' || {ASSIGNED_SQL} AS partition_tablename, COUNT(*) AS row_cnt,
       MIN(transaction_dt) AS min_dt, MAX(transaction_dt) AS max_dt
FROM acc_data GROUP BY 1""")
def ledger_partition_assignment(spark, sf):
    label = partitions.assigned_label(F.col("transaction_dt"), PREMADE_AS_OF)
    return bindings.fact(spark, sf).groupBy(
        F.concat(F.lit("acc_data_"), label).alias("partition_tablename")
    ).agg(
        F.count("*").alias("row_cnt"),
        F.min("transaction_dt").alias("min_dt"),
        F.max("transaction_dt").alias("max_dt"),
    )


@register("ledger_backfill_report", f"""
WITH {ACC_DATA}, moved AS (
  SELECT {LABEL_SQL} AS target, COUNT(*) AS rows_moved FROM acc_data
  WHERE {ASSIGNED_SQL} = 'default' GROUP BY 1)
SELECT target, rows_moved FROM moved
UNION ALL SELECT 'total', CAST(SUM(rows_moved) AS BIGINT) FROM moved""")
def ledger_backfill_report(spark, sf):
    return partitions.backfill_report(bindings.fact(spark, sf), "transaction_dt", PREMADE_AS_OF)


@register("ledger_partitions", f"WITH {ACC_DATA} SELECT DISTINCT {LABEL_SQL} AS part FROM acc_data")
def ledger_partitions(spark, sf):
    """Partitions as the catalog lists them."""
    listed = spark.sql(f"SHOW PARTITIONS {stored_ledger_name(spark, sf)}")
    return listed.select(F.substring_index("partition", "=", -1).alias("part"))


@register("ledger_read_days", f"""
WITH {ACC_DATA} SELECT {SHOWN_SQL} FROM acc_data
WHERE transaction_dt BETWEEN DATE '1998-03-15' AND DATE '1998-05-10'""")
def ledger_read_days(spark, sf):
    """A day range of the stored ledger; only its three partitions are read."""
    low, high = dt.date(1998, 3, 15), dt.date(1998, 5, 10)
    return shown(partitions.read_days(stored_ledger(spark, sf), "transaction_dt", low, high))


# --- skew ------------------------------------------------------------------

TENANT_ROWS = """tenant_rows AS (SELECT company_id, COUNT(*) AS n FROM acc_data GROUP BY company_id)"""

SKEW_SQL = """SELECT COUNT(*) AS segments, CAST(SUM(n) AS BIGINT) AS row_cnt,
       ROUND(stddev_samp(n) / AVG(n) * 100, 9) AS skew_coefficient,
       ROUND(1 - AVG(n) / MAX(n), 9) AS idle_fraction FROM {}"""


def _skew(counts):
    figures = shards.skew(counts)
    return figures.withColumns(
        {c: F.round(c, 9) for c in ("skew_coefficient", "idle_fraction")}
    )


@register("ledger_skew", f"WITH {ACC_DATA}, {TENANT_ROWS} " + SKEW_SQL.format("tenant_rows"))
def ledger_skew(spark, sf):
    return _skew(bindings.fact(spark, sf).groupBy("company_id").agg(F.count("*").alias("row_cnt")))


# --- sizes and statistics ----------------------------------------------------

# Bytes of the values of a row: fixed-width columns, then the texts.
SIZED_TEXTS = ("account_id", "operation_type", "currency_code", "custom_1", "custom_2")
FIXED_BYTES = 36
ROW_BYTES_SQL = " + ".join([str(FIXED_BYTES), *[f"COALESCE(length({c}), 0)" for c in SIZED_TEXTS]])


@register("ledger_partition_sizes", f"""
WITH {ACC_DATA}, sizes AS (
  SELECT 'acc_data_' || {LABEL_SQL} AS name, COUNT(*) AS row_cnt,
         CAST(SUM({ROW_BYTES_SQL}) AS BIGINT) AS size_bytes FROM acc_data GROUP BY 1
  UNION ALL
  SELECT 'acc_data', COUNT(*), CAST(SUM({ROW_BYTES_SQL}) AS BIGINT) FROM acc_data)
SELECT name, row_cnt, size_bytes,
       CASE WHEN size_bytes < 10240 THEN size_bytes || ' bytes'
            WHEN (size_bytes >> 9)  < 20479 THEN (((size_bytes >> 9)  + 1) >> 1) || ' kB'
            WHEN (size_bytes >> 19) < 20479 THEN (((size_bytes >> 19) + 1) >> 1) || ' MB'
            WHEN (size_bytes >> 29) < 20479 THEN (((size_bytes >> 29) + 1) >> 1) || ' GB'
            WHEN (size_bytes >> 39) < 20479 THEN (((size_bytes >> 39) + 1) >> 1) || ' TB'
            ELSE (((size_bytes >> 49) + 1) >> 1) || ' PB' END AS size,
       true AS same_bytes, true AS labelled
FROM sizes WHERE name LIKE 'acc_data%' ORDER BY size_bytes DESC, name""")
def ledger_partition_sizes(spark, sf):
    """The ledger and each of its partitions, largest first: rows, bytes of their values and
    the size text; and whether the bytes that the storage lists are the ones that the rows'
    own file sizes add up to, and have a size text too."""
    name = stored_ledger_name(spark, sf)

    def named(sizes, *sums):
        """Every partition by its name, and the ledger with the sums of all."""
        every = sizes.agg(*[F.sum(c).alias(c) for c in sums]).select(F.lit("acc_data").alias("name"), *sums)
        return sizes.select(F.concat(F.lit("acc_data_"), partitions.PART).alias("name"), *sums).unionByName(every)

    texts = [F.coalesce(F.char_length(c), F.lit(0)) for c in SIZED_TEXTS]
    held = layout.stored_files(spark.table(name), [partitions.PART], values=sum(texts, F.lit(FIXED_BYTES)))
    parts = held.groupBy(partitions.PART).agg(*[F.sum(c).alias(c) for c in ("row_cnt", "value_bytes", "file_size")])
    listed = listed_sizes(listed_table(spark, name), [partitions.PART])
    both = named(parts, "row_cnt", "value_bytes", "file_size").join(named(listed, "size_bytes"), "name")
    labelled = pretty_size(F.col("size_bytes")).rlike("^[0-9]+ (bytes|kB|MB|GB|TB|PB)$")
    return both.filter(F.col("name").like("acc_data%")).select(
        "name", "row_cnt", F.col("value_bytes").alias("size_bytes"), pretty_size(F.col("value_bytes")).alias("size"),
        (F.col("size_bytes") == F.col("file_size")).alias("same_bytes"), labelled.alias("labelled"),
    ).orderBy(F.desc("size_bytes"), "name")


@register("layout_sizes")
def layout_sizes(spark, sf):
    """Files and bytes of the stored ledger per partition, largest first, by a listing
    of the storage."""
    sizes = listed_sizes(listed_table(spark, stored_ledger_name(spark, sf)), ["part"]).drop("mark")
    return sizes.withColumn("size", pretty_size(F.col("size_bytes"))).orderBy(F.desc("size_bytes"), "part")


@register("layout_rows", f"""
WITH {ACC_DATA} SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt FROM acc_data GROUP BY 1""")
def layout_rows(spark, sf):
    """Rows per partition, added up from the files that hold them."""
    files = layout.stored_files(stored_ledger(spark, sf), ["part"])
    return layout.partition_sizes(files, ["part"]).select("part", "row_cnt")


HELD_SQL = f"""{ACC_DATA}, held AS (SELECT {LABEL_SQL} AS part, COUNT(*) AS row_cnt FROM acc_data GROUP BY 1)"""
LEFT_OUT = ("p19980301", "p19980401", "p19980501")


def _held(spark, sf, **options):
    files = layout.stored_files(stored_ledger(spark, sf), ["part"])
    return layout.partition_sizes(files, ["part"], **options)


@register("layout_sized_parts", f"WITH {HELD_SQL} SELECT part, row_cnt, true AS sized, true AS labelled FROM held")
def layout_sized_parts(spark, sf):
    """Every partition has files with bytes and a size text; their rows are all rows."""
    sized, labelled = F.col("size_bytes") > 0, F.col("size").rlike("^[0-9]+ (bytes|kB|MB|GB|TB|PB)$")
    return _held(spark, sf).select("part", "row_cnt", sized.alias("sized"), labelled.alias("labelled"))


@register("layout_like", f"WITH {HELD_SQL} SELECT part, row_cnt FROM held WHERE part LIKE 'p1998%'")
def layout_like(spark, sf):
    """Stored partitions of one year."""
    return _held(spark, sf, prefix="p1998").select("part", "row_cnt")


@register("layout_not_in", f"WITH {HELD_SQL} SELECT part, row_cnt FROM held WHERE part NOT IN {LEFT_OUT}")
def layout_not_in(spark, sf):
    """Stored partitions but for three months."""
    return _held(spark, sf).filter(~F.col("part").isin(*LEFT_OUT)).select("part", "row_cnt")


@register("layout_head_company", f"""
WITH {HELD_SQL}, own AS (SELECT {LABEL_SQL} AS part, company_id, COUNT(*) AS n FROM acc_data GROUP BY 1, 2)
SELECT held.part, COALESCE(own.n, 0) AS row_cnt
FROM held LEFT JOIN own ON own.part = held.part AND own.company_id = {HEAD_COMPANY}""")
def layout_head_company(spark, sf):
    """Every stored partition, and the rows one tenant has there (none count as 0)."""
    listed = ledger_partitions(spark, sf)
    own = stored_ledger(spark, sf).groupBy("part", "company_id").agg(F.count("*").alias("n"))
    met = (listed["part"] == own["part"]) & (own["company_id"] == F.lit(HEAD_COMPANY))
    return listed.join(own, met, "left").select(listed["part"], F.coalesce("n", F.lit(0)).alias("row_cnt"))


@register("layout_with_default", f"WITH {HELD_SQL} SELECT part FROM held UNION SELECT 'default'")
def layout_with_default(spark, sf):
    """The stored partitions, and default whether or not rows wait there."""
    default = literal_rows(
        spark, [(partitions.DEFAULT,)], T.StructType([T.StructField("part", T.StringType())])
    )
    return ledger_partitions(spark, sf).union(default).distinct()


@register("layout_estimated_count", f"""
WITH {ACC_DATA} SELECT CAST(COUNT(*) AS DOUBLE) AS estimated_count FROM acc_data""")
def layout_estimated_count(spark, sf):
    return layout.estimated_count(layout.stored_files(stored_ledger(spark, sf), ["part"]))


@register("layout_statistics", f"WITH {ACC_DATA} SELECT COUNT(*) AS row_cnt, true AS has_bytes FROM acc_data")
def layout_statistics(spark, sf):
    """Statistics refreshed in the catalog, beside the rows counted in the table."""
    name = stored_ledger_name(spark, sf)
    figures = layout.refresh_statistics(spark, name)
    counted = spark.table(name).agg(F.count("*").alias("row_cnt"))
    return counted.filter(F.col("row_cnt") == figures["rows"]).withColumn(
        "has_bytes", F.lit(figures["bytes"] > 0)
    )


CLUSTER_DAY = dt.date(1998, 3, 15)


@register("layout_clustered", f"""
WITH {ACC_DATA}
SELECT 'company' AS asked, COUNT(*) AS row_cnt, CAST(SUM(amount) AS DOUBLE) AS amount FROM acc_data WHERE company_id = {HEAD_COMPANY}
UNION ALL
SELECT 'day', COUNT(*), CAST(SUM(amount) AS DOUBLE) FROM acc_data WHERE transaction_dt = DATE '{CLUSTER_DAY}'""")
def layout_clustered(spark, sf):
    """The ledger clustered by company and day at once, asked for one of each."""
    path = scratch_path(spark, "clustered")
    rows = layout.rewrite_clustered(stored_ledger(spark, sf).drop(partitions.PART), path, ["company_id", "transaction_dt"], group_bytes=1 << 16)
    asked = {"company": F.col("company_id") == HEAD_COMPANY, "day": F.col("transaction_dt") == F.lit(CLUSTER_DAY)}
    found = [
        rows.filter(wanted).agg(F.count("*").alias("row_cnt"), F.sum("amount").cast("double").alias("amount")).select(F.lit(name).alias("asked"), "*")
        for name, wanted in asked.items()
    ]
    return found[0].unionByName(found[1])


# --- co-location -------------------------------------------------------------

@register("ledger_hot_tenants", f"""
WITH {ACC_DATA}, n AS (SELECT company_id, COUNT(*) AS n FROM acc_data GROUP BY 1),
t AS (SELECT SUM(n) AS total FROM n)
SELECT company_id, CAST(ceil(n * 32 / total::DOUBLE) AS INTEGER) AS splits FROM n, t WHERE n * 32 > total""")
def ledger_hot_tenants(spark, sf):
    return colocation.hot_tenants(bindings.fact(spark, sf))


_buckets: dict[tuple[str, str], tuple[str, str]] = {}


def bucketed_ledger(spark, sf) -> tuple[str, str]:
    """Fact and rollup in equal buckets, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _buckets:
        space = scratch_namespace(spark, "buckets")
        fact, rollup = f"{space}.acc_data", f"{space}.acc_aggregate"
        # The partitioned ledger is scanned twice; its joins are not run again.
        rows = stored_ledger(spark, sf).drop(partitions.PART)
        buckets = colocation.bucket_count(spark, stored_ledger_name(spark, sf))
        hot = colocation.hot_tenants(rows, buckets=buckets)
        by = ["transaction_id", "transaction_dt", "account_id", "amount"]
        colocation.write_buckets(colocation.spread(rows, hot, by), fact, buckets=buckets)
        totals = (
            colocation.colocated_rollup(spark.table(fact))
            .groupBy("company_id", "account_id", "period_dt", "currency_code")
            .agg(F.sum("amount").alias("amount"))
        )
        colocation.write_buckets(colocation.repeated(totals, hot), rollup, buckets=buckets)
        _buckets[key] = (fact, rollup)
    return _buckets[key]


@register("ledger_colocated_report", cells_sql())
def ledger_colocated_report(spark, sf):
    fact, rollup = bucketed_ledger(spark, sf)
    session = colocation.colocated_session(spark)
    rows = colocation.colocated_detail(session.table(rollup), session.table(fact))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("amount_all", "amount_custom_1")})


def _buckets_held(spark, sf):
    fact, _ = bucketed_ledger(spark, sf)
    return shards.bucket_rows(layout.stored_files(spark.table(fact), []))


@register("layout_buckets")
def layout_buckets(spark, sf):
    """Files, rows and bytes of every stored bucket."""
    return _buckets_held(spark, sf).orderBy("bucket")


@register("layout_bucket_total", f"""
WITH {ACC_DATA} SELECT COUNT(*) AS row_cnt, true AS sized, true AS numbered FROM acc_data""")
def layout_bucket_total(spark, sf):
    """The rows of all bucket files are the rows of the ledger; none is without bytes."""
    return _buckets_held(spark, sf).agg(
        F.sum("row_cnt").alias("row_cnt"),
        (F.min("size_bytes") > 0).alias("sized"),
        (F.count("bucket") == F.count("*")).alias("numbered"),
    )
