"""One dataset over the hot and the cold part of the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def each_once(rows: DataFrame) -> DataFrame:
    """Every row once. Few rows of a ledger are equal, so they are dealt by all columns
    first: a plain ``distinct`` would gather all rows of a file split in memory before it
    shuffles them, and a split has as many as the file gives. Here a task holds the rows of
    its partition, whose size the shuffle bounds."""
    return rows.repartition(*[F.col(f"`{c}`") for c in rows.columns]).distinct()


def full_view(hot: DataFrame, cold: DataFrame, disjoint: bool = False) -> DataFrame:
    """Rows of both parts, each row once. A filter on the result reaches both scans.

    ``disjoint`` promises that the parts share no month and that their keys are
    unique (both checked by the audits); the rows then need no shuffle to be told
    apart."""
    both = hot.unionByName(cold)
    return both if disjoint else each_once(both)


def filtered_view(hot: DataFrame, cold: DataFrame, condition) -> DataFrame:
    """The same with the filter written in both branches."""
    return each_once(hot.filter(condition).unionByName(cold.filter(condition)))
