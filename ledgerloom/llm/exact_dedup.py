"""Exact deduplication against immutable snapshots, screened by binary-fuse filters.

A snapshot is a set of texts that never changes again. It keeps an exact table, one row
per distinct text (digest, SHA-256, byte length, best row), cut into buckets by digest,
and one static binary-fuse filter per bucket. A new batch is digested and grouped by
itself; its distinct digests are screened by the filter of their bucket, and only the
positives join the exact buckets. Whatever shares a digest with another row is at last
compared byte for byte.

Skew: rows are counted per distinct text before every shuffle (one row per text and
task), so a text that a third of the rows repeat is one row where groups meet. Only the
last join, which hands each row its group, sees the rows of a hot text; it is a plain
equi-join whose large partitions Spark splits.
Texts are never shuffled, but for those that a bounded Bloom filter of the repeated
digests lets through, and these are reduced to distinct texts per task first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import bits, fuse
from ledgerloom.llm.common import BLANKS, code_points, pick, staged

# Distinct digests a bucket (and so a filter) is built for: 1 << 18 are 0.6 MB of filter.
BUCKET_DIGESTS = 1 << 18


def normalised(text: Column) -> Column:
    """The text without the characters [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def digested(docs: DataFrame) -> DataFrame:
    """One row per document: its digest, SHA-256, sizes, and a number of its own that
    tells rows apart that agree in everything else."""
    plain = pick(docs, ("doc_id", "long"), ("text", "string")).withColumn("norm", normalised("text"))
    return plain.select(
        "doc_id",
        F.xxhash64("norm").alias("digest"),
        F.sha2("norm", 256).alias("sha"),
        F.octet_length("norm").cast("long").alias("n_bytes"),
        code_points(F.col("text")).alias("points"),
        F.monotonically_increasing_id().alias("row_no"),
    )


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct text with the row that stays: most code points, then the
    smallest doc_id (a null id after all others), then the first row."""
    best = F.max(
        F.struct(
            "points",
            F.col("doc_id").isNotNull().alias("named"),
            (-F.col("doc_id")).alias("minus_id"),
            (-F.col("row_no")).alias("minus_row"),
        )
    )
    return rows.groupBy("digest", "sha", "n_bytes").agg(best.alias("best"), F.count("*").alias("n"))


@dataclass
class Snapshot:
    """The exact table of an immutable set of texts, and the filters of its buckets."""

    exact: DataFrame  # digest, sha, n_bytes, best, n, bucket
    filters: DataFrame  # bucket, filter
    buckets: int


def bucket_of(digest: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(7)), F.lit(buckets)).cast("int")


def build_snapshot(groups: DataFrame) -> Snapshot:
    """A snapshot of staged groups; the groups themselves are its exact buckets."""
    buckets = max(1, -(-groups.count() // BUCKET_DIGESTS))
    exact = groups.withColumn("bucket", bucket_of(F.col("digest"), buckets))

    def make(key: tuple, keys: pa.Table) -> pa.Table:
        digests = keys.column("digest").to_numpy().view(np.uint64)
        return pa.table(
            {"bucket": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([fuse.build(digests)], pa.binary())}
        )

    filters = exact.select("bucket", "digest").groupBy("bucket").applyInArrow(make, "bucket int, filter binary")
    return Snapshot(exact, staged(filters, "dedup-filters"), buckets)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Mark the groups of a batch whose digest may be in the snapshot. Groups and filters
    meet by bucket; a batch holds each text once, so a bucket is as even as its hash."""
    placed = groups.withColumn("bucket", bucket_of(F.col("digest"), snapshot.buckets))
    schema = T.StructType([*placed.schema.fields, T.StructField("maybe", T.BooleanType())])

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        hit = np.zeros(left.num_rows, bool)
        if left.num_rows and right.num_rows:
            digests = left.column("digest").to_numpy().view(np.uint64)
            hit = fuse.contains(right.column("filter")[0].as_py(), digests)
        return left.append_column("maybe", pa.array(hit, pa.bool_()))

    return placed.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInArrow(probe, schema)


def merge(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The groups of snapshot and batch together, one row per distinct text. Groups the
    filter rejects are new texts; positives join the exact buckets."""
    marked = staged(screen(grouped(batch), snapshot), "dedup-screened")
    old = snapshot.exact.select("digest", "sha", "n_bytes", "best", "n")
    both = old.join(
        marked.filter("maybe").select("digest", "sha", "n_bytes", F.col("best").alias("best_b"), F.col("n").alias("n_b")),
        ["digest", "sha", "n_bytes"],
        "full",
    ).select(
        "digest", "sha", "n_bytes",
        F.greatest("best", "best_b").alias("best"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("n_b", F.lit(0))).alias("n"),
    )
    return both.unionByName(marked.filter("not maybe").select("digest", "sha", "n_bytes", "best", "n"))


def check_bytes(docs: DataFrame, repeated: DataFrame, count: int) -> DataFrame:
    """Compare the texts of repeated digests byte for byte: one row (digest, sha, texts)
    per group with the number of different texts in it. The first grouping has the
    text itself as its key, so equal copies melt into one row in the task that reads them."""
    likely = bits.prefilter(repeated, "digest", count)
    texts = (
        pick(docs, ("text", "string"))
        .select(normalised("text").alias("norm"))
        .withColumn("digest", F.xxhash64("norm"))
        .filter(likely.holds(F.col("digest")))
        .groupBy("digest", "norm").agg(F.count("*").alias("rows"))
    )
    return texts.groupBy("digest", F.sha2("norm", 256).alias("sha")).agg(F.count("*").alias("texts"))


def deduplicate(docs: DataFrame, batch_of: Column | None = None, batches: int = 2) -> tuple[DataFrame, DataFrame]:
    """Group documents whose texts are equal once blanks are deleted.

    Returns (rows, groups). Rows: doc_id, points, row_no, digest, sha of every input
    row. Groups: digest, sha, best (the row that stays), n. ``batch_of`` numbers the
    batches 0 … ``batches`` - 1 in order of arrival; the first becomes a snapshot that
    the second is screened against, and so on. By default half of the rows, by a hash
    of the id, came first; the result is the same for every split.

    Null texts equal empty ones; a null id stays last among ties; fully repeated rows
    keep one; an empty table gives no rows. If two texts with one SHA-256 differ in
    bytes the job fails rather than drop either.
    """
    rows = staged(digested(docs), "dedup-rows")
    if batch_of is None:
        batch_of = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(batches))
    groups = staged(grouped(rows.filter(batch_of == 0)), "dedup-snapshot")
    for i in range(1, batches):
        groups = staged(merge(rows.filter(batch_of == i), build_snapshot(groups)), "dedup-snapshot")
    repeated = groups.filter("n > 1")
    checked = check_bytes(docs, repeated, repeated.count())
    sure = repeated.join(checked, ["digest", "sha"], "left").withColumn(
        "n",
        F.when(F.col("texts") == 1, F.col("n")).otherwise(
            F.raise_error(F.lit("texts with one SHA-256 differ in bytes")).cast("long")
        ),
    )
    return rows, groups.filter("n = 1").unionByName(sure.drop("texts"))


def labelled(docs: DataFrame) -> DataFrame:
    """Every document with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, groups = deduplicate(docs)
    several = groups.filter("n > 1").select("digest", "sha", "best", "n")
    joined = rows.join(several, ["digest", "sha"], "left")
    alone = F.col("n").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(-F.col("best.minus_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row_no") == -F.col("best.minus_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names. Rows whose
    digest no other row shares pass without a shuffle; the rest meet their group by an
    equi-join. Of fully repeated rows one is kept; null texts equal empty ones."""
    _, groups = deduplicate(docs)
    several = staged(groups.filter("n > 1").select("digest", "sha", "best"), "dedup-several")
    likely = bits.prefilter(several, "digest", several.count())
    norm = normalised(F.col("`text`"))
    named = docs.select(  # the row is held in one column, so that no other can clash with its own
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct(F.xxhash64(norm).alias("digest"), F.sha2(norm, 256).alias("sha")).alias("key"),
        F.struct(code_points(F.col("`text`")).alias("points"), (-F.col("`doc_id`").cast("long")).alias("minus_id")).alias("own"),
    )
    maybe = likely.holds(F.col("key.digest"))
    winners = several.select(
        F.struct("digest", "sha").alias("key"),
        F.struct(F.col("best.points").alias("points"), F.col("best.minus_id").alias("minus_id")).alias("best"),
    )
    near = named.filter(maybe)
    alone = near.join(winners, "key", "left_anti").select("row")  # the filter had let them through by mistake
    first = near.join(winners, "key").filter(F.col("best").eqNullSafe(F.col("own"))).dropDuplicates(["key"]).select("row")
    return named.filter(~maybe).select("row").unionByName(alone).unionByName(first).select("row.*")
