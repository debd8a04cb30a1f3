"""Bulk CSV load with declared types, mapping expressions and a reject log.

Lines are read as text and parsed by an expression, so a rejected line is logged as it
stands in the file, with the file and its line number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.shared import scratch_path
from ledgerloom.sources.files import csv_options

GOOD, BAD, BLANK = "good", "bad", "blank"
_BROKEN = "_broken"
# Where a line stands: its file, the split it was read in, and its place in the task.
_PLACE = ["_file", "_split", "_at"]


class TooManyRejects(RuntimeError):
    """The load was refused: more bad rows than the limit allows."""


@dataclass(frozen=True)
class LoadColumn:
    """A target column: its type, and optionally how its text becomes a value.
    The expression must give null (not fail) for text it cannot read."""

    name: str
    kind: str
    parse: Callable[[Column], Column] | None = None

    def value(self, text: Column) -> Column:
        return self.parse(text) if self.parse else text.try_cast(self.kind)


def zoned_timestamp(text: Column) -> Column:
    """Timestamp with milliseconds and zone, such as 2000-01-01T00:00:00.000+03:00."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))


@dataclass(frozen=True)
class LoadResult:
    """Loaded rows and rejects of one load, both read from the staged result."""

    staged: DataFrame
    columns: tuple[LoadColumn, ...]
    splits: DataFrame  # per split: lines before it in its file, and where it begins
    heads: DataFrame | None  # places of the header lines
    good_head: bool  # some header line reads like a row
    error_limit: int

    def _lines(self, status: str, may_be_head: bool) -> DataFrame:
        rows = self.staged.filter(F.col("status") == status)
        return rows.join(self.heads, _PLACE, "left_anti") if may_be_head and self.heads is not None else rows

    @property
    def good(self) -> DataFrame:
        return self._lines(GOOD, self.good_head).select(*[F.col(f"`{c.name}`") for c in self.columns])

    @property
    def rejects(self) -> DataFrame:
        """bad_column (``(line)`` if the fields can't be told apart), the line as it stands
        in the file, the file, and its line number there, from 1."""
        numbered = self._lines(BAD, True).join(self.splits, ["_file", "_split"])
        number = F.col("_before") + F.col("_at") - F.col("_first") + 1
        return numbered.select("bad_column", "line", F.col("_file").alias("file"), number.alias("line_no"))

    def report(self) -> DataFrame:
        """Rows in, loaded and rejected, and the limit the load was held to. Header and
        blank lines are no rows."""
        rows = self.staged.filter(F.col("status") != BLANK)
        if self.heads is not None:
            rows = rows.join(self.heads, _PLACE, "left_anti")
        return rows.agg(
            F.count("*").alias("rows_in"),
            F.count_if(F.col("status") == GOOD).alias("rows_loaded"),
            F.count_if(F.col("status") == BAD).alias("rows_rejected"),
        ).withColumn("error_limit", F.lit(self.error_limit).cast("bigint"))


def parsed_lines(lines: DataFrame, columns: list[LoadColumn], **options) -> DataFrame:
    """Lines (``value`` and the places) as typed columns, bad_column, line and status."""
    text = T.StructType([T.StructField(c.name, T.StringType()) for c in columns] + [T.StructField(_BROKEN, T.StringType())])
    parse = csv_options() | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN} | options
    value = F.col("value")
    ddl = ", ".join(f"`{f.name}` string" for f in text)
    fields = lines.withColumn("_fields", F.from_csv(value, ddl, {k: str(v) for k, v in parse.items()}))
    typed = fields.withColumns({f"_v_{i}": c.value(F.col(f"_fields.`{c.name}`")) for i, c in enumerate(columns)})
    quote = parse["quote"]
    unclosed = (F.char_length(value) - F.char_length(F.replace(value, F.lit(quote)))) % 2 == 1
    bad = F.when(F.col(f"_fields.{_BROKEN}").isNotNull() | unclosed, F.lit("(line)"))
    for i, c in enumerate(columns):
        bad = bad.when(F.col(f"_fields.`{c.name}`").isNotNull() & F.col(f"_v_{i}").isNull(), F.lit(c.name))
    blank = F.trim(value) == ""
    marked = typed.withColumn("bad_column", F.when(~blank, bad))
    status = F.when(blank, F.lit(BLANK)).when(F.col("bad_column").isNotNull(), F.lit(BAD)).otherwise(F.lit(GOOD))
    return marked.select(
        *[F.col(f"_v_{i}").alias(c.name) for i, c in enumerate(columns)],
        "bad_column",
        F.when(F.col("bad_column").isNotNull(), value).alias("line"),
        *_PLACE,
        status.alias("status"),
    )


def _splits(staged: DataFrame) -> DataFrame:
    """Per split of a file: the place of its first line and the lines before it. A task
    reads the lines of a split one after the other."""
    found = staged.groupBy("_file", "_split").agg(F.min("_at").alias("_first"), F.count("*").alias("_lines"))
    before = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0)))


def load_csv(
    spark: SparkSession,
    path: str,
    columns: list[LoadColumn],
    error_limit: int | None = None,
    error_share: float | None = None,
    header: bool = True,
    stage: str | None = None,
    **options,
) -> LoadResult:
    """Read every field as text, convert it, and part good rows from bad ones.

    The files are parsed once: all lines go to a staged table partitioned by the outcome,
    and counts, rejects and their places come from there. A row is bad when it has the
    wrong number of fields, a quote that isn't closed on its line, or a field whose text
    does not give a value of its type. With ``header`` the first line of every file is
    left out, whatever it says; blank lines are left out as well.

    The load is refused when it has more bad rows than ``error_limit``, or than
    ``error_share`` of its rows; without either, never.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
    )
    outcome = parsed_lines(lines, columns, **options)
    place = stage or scratch_path(spark, "csv-load")
    outcome.write.mode("overwrite").partitionBy("status").parquet(place)
    rest = [f for f in outcome.schema if f.name != "status"]
    staged = spark.read.schema(T.StructType(rest + [T.StructField("status", T.StringType())])).parquet(place)
    splits = _splits(staged)
    heads, good_head = None, False
    if header:
        heads = splits.filter("_split = 0").select("_file", "_split", F.col("_first").alias("_at"))
        good_head = bool(staged.filter(F.col("status") == GOOD).join(heads, _PLACE, "left_semi").limit(1).count())
    result = LoadResult(staged, tuple(columns), splits, heads, good_head, 0)
    counts = result.report().first()
    limits = [x for x in (error_limit, error_share and int(counts["rows_in"] * error_share)) if x is not None]
    limit = min(limits, default=counts["rows_in"])
    if counts["rows_rejected"] > limit:
        raise TooManyRejects(f"{counts['rows_rejected']} bad rows, the limit is {limit}")
    return LoadResult(staged, tuple(columns), splits, heads, good_head, limit)
