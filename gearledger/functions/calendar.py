"""Business calendar: every bound is an expression on a date column, so it runs in the plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DateLike = dt.date | str
Month = tuple[int, int]  # year, month


def day(value: DateLike) -> Column:
    return F.lit(str(value)).cast("date")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def previous_month_end(d: Column) -> Column:
    return F.last_day(F.add_months(d, -1))


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def year_start(d: Column) -> Column:
    return F.trunc(d, "YEAR")


def same_day_last_year(d: Column) -> Column:
    return F.add_months(d, -12)


def days_before(d: Column, days: int) -> Column:
    return F.date_sub(d, days)


def day_after(d: Column) -> Column:
    return F.date_add(d, 1)


def yesterday() -> Column:
    return F.date_sub(F.current_date(), 1)


def between_days(c: Column, start: DateLike | None, end: DateLike | None) -> Column:
    """Whole days start..end, as the half-open range start <= c < end + 1 day."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (c >= day(start))
    if end is not None:
        keep = keep & (c < day_after(day(end)))
    return keep


def yyyymmdd(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def month_index(year: int | Column, month: int | Column) -> int | Column:
    return year * 12 + month - 1


def in_months(rows: DataFrame, first: Month | Column, last: Month | Column) -> DataFrame:
    """Every row once per month from first to last, with ``year`` and ``month``.

    A bound is a year and month, or a column with a ``month_index``, such as one taken from a table.
    """
    start, end = (m if isinstance(m, Column) else F.lit(month_index(*m)) for m in (first, last))
    months = rows.withColumn("month_index", F.explode(F.sequence(start, end)))
    return months.withColumns({
        "year": F.expr("CAST(month_index DIV 12 AS INT)"), "month": F.expr("month_index % 12 + 1"),
    }).drop("month_index")
