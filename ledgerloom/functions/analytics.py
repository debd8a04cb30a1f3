"""The analytic codes the ledger generator derives from uniform draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def level_one(draw: Column) -> Column:
    """Four even buckets: A, B, C and no code."""
    bucket = F.floor(draw * 4)
    return F.when(bucket == 0, "A").when(bucket == 1, "B").when(bucket == 2, "C")


def level_two(draw: Column) -> Column:
    """XX above five tenths. The ZZ branch stands second and is never reached."""
    tenth = F.floor(draw * 10)
    return F.when(tenth > 5, "XX").when(tenth > 8, "ZZ")


def level_three(draw: Column) -> Column:
    """RARE needs ten tenths, which a draw below one never has."""
    return F.when(F.floor(draw * 10) > 9, "RARE")


def random_amount(draw: Column) -> Column:
    """Whole hundreds up to 100 million; halves round to even."""
    return (F.rint(draw * 1000000).cast("bigint") * 100).cast("decimal(18,2)")


def kept(draw: Column) -> Column:
    """Flag that is 1 for three rows in four."""
    return F.when(draw > 0.25, 1).otherwise(0)
