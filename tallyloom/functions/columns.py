"""Small helpers to build column expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_lit(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def day_number(column: Column | str) -> Column:
    """Days since 1970-01-01, for orders and RANGE frames."""
    return F.unix_date(as_column(column))


def within(column: Column | str, start: Column, end: Column) -> Column:
    return as_column(column).between(start, end)


def sum_when(condition: Column, value: Column | str | int = 1) -> Column:
    """SUM(CASE WHEN condition THEN value ELSE 0 END)."""
    value = F.lit(value) if isinstance(value, int) else as_column(value)
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def ratio(above: Column | str, below: Column | str) -> Column:
    """Division in double precision, NULL when the divisor is zero."""
    return F.try_divide(as_column(above).cast("double"), as_column(below).cast("double"))


def add_all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Round a double after scaling it, as most engines do; `F.round` rounds its decimal text."""
    scale = F.lit(10.0**digits)
    return F.round(as_column(column).cast("double") * scale, 0) / scale
