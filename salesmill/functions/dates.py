"""Dates written day first, as ``21/8/2016`` or ``01/12/2016``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date form of the order files.
DAY_FIRST = "d/M/yyyy"


def day_first_date(text: Column | str) -> Column:
    """The date, or null where the text is not a valid day-first date.

    A null is counted by the quality checks; a raised error would end the whole job
    for one dirty row.
    """
    return F.try_to_date(text, DAY_FIRST)


def day_first_parts(text: Column | str) -> dict[str, Column]:
    """Two-digit day and month, the year, and the three joined as ``dd-MM-yyyy``.

    Parts that are not there are null, and a null part makes the joined text null.
    """
    parts = F.split(text, "/")
    day = F.lpad(F.get(parts, F.lit(0)), 2, "0")
    month = F.lpad(F.get(parts, F.lit(1)), 2, "0")
    year = F.get(parts, F.lit(2))
    dash = F.lit("-")
    return {
        "day": day,
        "month": month,
        "year": year,
        "padded": F.concat(day, dash, month, dash, year),
    }


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``; null if either is, negative if reversed."""
    return F.datediff(end, start)
