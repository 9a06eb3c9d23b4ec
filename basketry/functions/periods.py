"""Date bounds. They stay plain range comparisons on the date column, so partitions can be pruned."""

import datetime as dt

from pyspark.sql import Column, functions as F

from basketry.functions.clean import _col


def week_bucket(order_date, week_end, weeks: int = 3) -> Column:
    """0 for the seven days up to and with week_end, 1 and 2 for the weeks before, else null."""
    bucket = F.floor(F.datediff(_col(week_end), _col(order_date)) / 7).cast("int")
    return F.when(bucket.between(0, weeks - 1), bucket)


def month_bucket(order_date, month_start, months: int = 4) -> Column:
    """0 for the report month, 1 for the month before and so on, else null."""
    bucket = F.months_between(_col(month_start), F.trunc(_col(order_date), "MM")).cast("int")
    return F.when(bucket.between(0, months - 1), bucket)


def first_of_month(month) -> dt.date:
    """'2024-03', a date or a datetime to the first day of that month."""
    if isinstance(month, str):
        year, number = month.split("-")[:2]
        return dt.date(int(year), int(number), 1)
    return dt.date(month.year, month.month, 1)


def shift_month(month, by: int) -> dt.date:
    first = first_of_month(month)
    index = first.year * 12 + first.month - 1 + by
    return dt.date(index // 12, index % 12 + 1, 1)


def in_months(order_date, first_month, last_month=None) -> Column:
    """Rows from the first day of first_month to the last day of last_month."""
    start = first_of_month(first_month)
    stop = shift_month(last_month or first_month, 1)
    c = _col(order_date)
    return (c >= F.lit(start)) & (c < F.lit(stop))
