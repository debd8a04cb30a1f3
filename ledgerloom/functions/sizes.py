"""Byte counts as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("kB", "MB", "GB", "TB", "PB")


def pretty_size(size: Column) -> Column:
    """Size text: plain bytes below 10 kB, else the first unit that keeps the
    rounded number below 10240 (halves round up)."""
    size = size.cast("bigint")
    text = F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(UNITS, start=1):
        # Halves of the unit, so that one integer step rounds half up.
        halves = F.shiftright(size, 10 * power - 1)
        amount = F.shiftright(halves + 1, 1)
        label = F.concat(amount.cast("string"), F.lit(f" {unit}"))
        text = text.otherwise(label) if unit == UNITS[-1] else text.when(halves < 20479, label)
    return text
