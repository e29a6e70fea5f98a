"""Churn and growth labels from past and future purchase days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column


def churn_half(past: Column | str, future: Column | str) -> Column:
    """1 when fewer purchase days than int(half the past ones)."""
    return (as_column(future) < F.floor(as_column(past) / 2)).cast("int")


def churn_band(past: Column | str, future: Column | str) -> Column:
    """From 6 past days on: fewer than half; below 6: none."""
    past, future = as_column(past), as_column(future)
    return F.when((past >= 6) & (future < past / 2), 1).when((past < 6) & (future == 0), 1).otherwise(0)


def growth(past: Column | str, future: Column | str) -> Column:
    """From 4 past days on: at least twice as many; below 4: at least 8."""
    past, future = as_column(past), as_column(future)
    return F.when((past >= 4) & (future >= 2 * past), 1).when((past < 4) & (future >= 8), 1).otherwise(0)


def at_least(df: DataFrame, past: str, days: int) -> DataFrame:
    """Customers with enough history for a churn label."""
    return df.where(F.col(past) >= days)
