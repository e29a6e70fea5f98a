"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column, date_lit


def month_start(d: Column | str) -> Column:
    return F.trunc(as_column(d), "month")


def week_start_sunday(d: Column | str) -> Column:
    d = as_column(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_start_monday(d: Column | str) -> Column:
    return F.trunc(as_column(d), "week")


def is_weekend(d: Column | str) -> Column:
    """Friday, Saturday or Sunday."""
    return F.dayofweek(as_column(d)).isin(1, 6, 7)


def year_boundaries(later: Column | str, earlier: Column | str) -> Column:
    return F.year(as_column(later)) - F.year(as_column(earlier))


def month_key(d: Column | str) -> Column:
    return F.date_format(as_column(d), "yyyyMM")


def whole_weeks(later: Column | str, earlier: Column | str) -> Column:
    return F.floor(F.datediff(as_column(later), as_column(earlier)) / 7)


def naive_timestamp(text: Column | str, zone: str = "UTC") -> Column:
    """Text with a zone offset as zone-free time in `zone`; NULL when it cannot be read."""
    instant = as_column(text).try_cast("timestamp")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def last_yearly(today: Column | str, month: int, day: int) -> Column:
    """Last occurrence of a yearly date that is not after `today`."""
    today = as_column(today)
    this_year = F.make_date(F.year(today), F.lit(month), F.lit(day))
    return F.when(this_year > today, F.make_date(F.year(today) - 1, F.lit(month), F.lit(day))).otherwise(this_year)


def nearest_date(candidates: Sequence[Column], pivot: Column | str) -> Column:
    """Candidate with the smallest distance to the pivot; the first listed wins ties."""
    pivot = as_column(pivot)
    distances = [F.abs(F.datediff(c, pivot)) for c in candidates]
    nearest = F.least(*distances) if len(distances) > 1 else distances[0]
    out = None
    for c, d in zip(candidates, distances, strict=True):
        out = (F if out is None else out).when(d == nearest, c)
    return out


def date_range(spark: SparkSession, start: dt.date | str, end: dt.date | str, name: str = "day") -> DataFrame:
    """All days of a period."""
    days = F.sequence(date_lit(start), date_lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))


def reference_dates(today: dt.date, seed: int = 0, months: int = 2, per_weekday: int = 2) -> list[dt.date]:
    """Random dates of the last months: `per_weekday` different weeks for each weekday."""
    start = today - dt.timedelta(days=30 * months)
    days = [start + dt.timedelta(days=i) for i in range((today - start).days)]
    draw = random.Random(seed)
    out = []
    for weekday in range(7):
        out += draw.sample([d for d in days if d.weekday() == weekday], per_weekday)
    return sorted(out)
