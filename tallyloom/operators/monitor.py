"""Job schedules and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.keyed import append_absent

JOB_KEY = ["site", "bu", "initiative", "job", "photo_day"]

# Weekday names of the schedule, Monday = 0.
WEEKDAYS = {"LU": 0, "MA": 1, "MI": 2, "JU": 3, "VI": 4, "SA": 5, "DO": 6}

# Type codes of advertising audiences.
LIST_TYPES = {0: "USER_INTEREST", 2: "APP_USERS", 3: "COMBINED_LIST", 5: "WEBSITE_VISITORS", 6: "SIMILAR_AUDIENCE", 7: "CUSTOMER_LIST"}


def schedule_of(jobs: DataFrame, today: Column) -> DataFrame:
    """Expected start and end today, from weekday, hour and minute texts; a blank weekday is daily."""
    weekday = F.lit(None).cast("int")
    for name, number in WEEKDAYS.items():
        weekday = F.when(F.col("weekday") == name, number).otherwise(weekday)
    runs = jobs.where((F.col("weekday") == "") | (weekday == F.weekday(today)))

    def at(hour: str, minute: str) -> Column:
        seconds = F.col(hour).try_cast("int") * 3600 + F.col(minute).try_cast("int") * 60
        return F.timestamp_seconds(F.unix_date(today).cast("long") * 86400 + seconds).cast("timestamp_ntz")

    return runs.select(
        "site", "bu", "initiative", "job", at("start_hour", "start_minute").alias("expected_start"), at("end_hour", "end_minute").alias("expected_end"), today.alias("photo_day")
    )


def load_schedule(monitor: DataFrame, schedule: DataFrame, today: Column) -> DataFrame:
    """Drop today's rows that have not run, then add the scheduled jobs that are absent."""
    pending = (F.col("photo_day") == today) & F.col("real_start").isNull() & F.col("real_end").isNull()
    kept = monitor.where(~F.coalesce(pending, F.lit(False)))
    fresh = schedule.withColumns({"real_start": F.lit(None).cast("timestamp_ntz"), "real_end": F.lit(None).cast("timestamp_ntz")})
    return append_absent(kept, fresh.select(*monitor.columns), JOB_KEY)


def late_jobs(monitor: DataFrame, now: Column, sent: DataFrame) -> DataFrame:
    """Jobs that should have started or ended by now and did not; alerts already sent are left out."""
    key = JOB_KEY[:-1]
    starts = monitor.where((F.col("expected_start") <= now) & F.col("real_start").isNull()).select(*key, F.lit("START").alias("alert"))
    ends = monitor.where((F.col("expected_end") <= now) & F.col("real_end").isNull()).select(*key, F.lit("END").alias("alert"))
    return starts.unionByName(ends).distinct().join(sent, [*key, "alert"], "left_anti")


def upstream_end(monitor: DataFrame, initiative: str, site: str, day: Column) -> DataFrame:
    """Real end of an upstream initiative's jobs on a day."""
    rows = monitor.where((F.col("initiative") == initiative) & (F.col("site") == site) & (F.col("photo_day") == day) & F.col("real_end").isNotNull())
    return rows.select("job", "real_end")


def audience_metrics(metrics: DataFrame, lists: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Ad metrics with the name and type of their audience; a blank list name falls back to the interest."""
    once = lists.groupBy("criterion_id").agg(F.min_by(F.struct("user_list", "interest_name", "user_type"), F.struct("user_list", "interest_name", "user_type")).alias("l"))
    kind = F.col("l.user_type").cast("string")
    for code, name in LIST_TYPES.items():
        kind = F.when(F.col("l.user_type") == code, name).otherwise(kind)
    label = F.when(F.col("l.user_list") == "", F.col("l.interest_name")).otherwise(F.col("l.user_list"))
    return metrics.join(once, "criterion_id").select(*keep, label.alias("list_name"), kind.alias("list_type"))


def control_counts(rows: DataFrame, site: str, photo: str) -> DataFrame:
    return rows.groupBy(site, photo).agg(F.count(F.lit(1)).alias("n"))
