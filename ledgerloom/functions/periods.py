"""Month arithmetic: truncation, shifts, ranges and partition labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(day, "month").cast("date")


def shift_months(day: Column, months: int | Column) -> Column:
    """Month shift that clamps to the month end (31 Jan + 1 = 28 or 29 Feb)."""
    return F.add_months(day, months)


def months_interval(text: Column) -> Column:
    """Interval of the number of months that a text names, such as '24'."""
    return F.make_ym_interval(F.lit(0), F.trim(text).cast("int"))


def cutoff(as_of: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` before ``as_of``: older days are cold."""
    index = as_of.year * 12 + as_of.month - 1 - int(months)
    return dt.date(index // 12, index % 12 + 1, 1)


def moment(value: dt.datetime) -> Column:
    """A zone-less time as a literal of that type. A plain literal would carry the
    session's zone, shift with it, and keep the comparison from the scan."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _literal(value) -> Column:
    return moment(value) if isinstance(value, dt.datetime) and value.tzinfo is None else F.lit(value)


def half_open(column: Column, low, high) -> Column:
    """``low <= column < high``."""
    return (column >= _literal(low)) & (column < _literal(high))


def partition_label(day: Column) -> Column:
    """Label of the monthly partition a day belongs to: ``pYYYYMMDD``."""
    return F.concat(F.lit("p"), F.date_format(month_start(day), "yyyyMMdd"))


def label_of(day: dt.date) -> str:
    """The same label for a date known to the driver."""
    return f"p{day.year:04d}{day.month:02d}01"


def label_month(label: str) -> dt.date:
    """The month a label stands for."""
    return dt.date(int(label[1:5]), int(label[5:7]), int(label[7:9]))
