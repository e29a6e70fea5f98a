"""Joins with a contract. Physical joins are left to Catalyst and AQE, which know the sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column


class KeyNotUnique(ValueError):
    pass


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    """Fail when a key occurs twice; one row reaches the driver."""
    twice = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1)
    if not twice.isEmpty():
        raise KeyNotUnique(f"{name}: key {list(keys)} is not unique")


def join_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails when a key occurs twice on a side."""
    require_unique(left, keys, "left")
    require_unique(right, keys, "right")
    return left.join(right, list(keys), "left")


def join_blocks(population: DataFrame, blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Population left join every feature block on one key.

    Each block ends in a groupBy on the key and is hash partitioned by it, so every join
    after the first reuses the layout of the population.
    """
    return reduce(lambda master, block: master.join(block, list(keys), "left"), blocks, population)


JOIN_ROWS = 1_000_000


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, most: int = JOIN_ROWS) -> DataFrame:
    """Inner join of two large tables on a key that spreads well, with about `most` rows of the left one in a task.

    The session's shuffle parallelism is fixed, so a task's share of a sort-merge join grows with the tables. Above `most` rows a
    task both sides are laid out in as many parts as the count asks for; below it the join is left to Catalyst. The count of a
    plain scan reads no column.
    """
    parts = -(-left.count() // most)
    if parts > int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left, right = left.repartition(parts, left_key), right.repartition(parts, right_key)
    return left.join(right, left[left_key] == right[right_key])


def bind_columns(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put two frames side by side on a shared index; rows of either side stay."""
    return left.join(right, list(keys), "full")


def latest_snapshot(df: DataFrame, day: str, group: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest date, per group when given."""
    if not group:
        return df.where(F.col(day) == df.agg(F.max(day)).scalar())
    newest = df.groupBy(*group).agg(F.max(day).alias(day))
    return df.join(newest, [*group, day], "left_semi")


def above_threshold(scored: DataFrame, thresholds: dict[str, float], site: str, score: str) -> DataFrame:
    """Keep rows whose score reaches the threshold of their site; other sites are left out."""
    limits = scored.sparkSession.createDataFrame(list(thresholds.items()), f"{site} string, threshold double")
    return scored.join(limits, site).where(F.col(score) >= F.col("threshold"))


def first_source(population: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """Value from the first source, or else from the second."""
    a = first.select(key, F.col(value).alias("__a"))
    b = second.select(key, F.col(value).alias("__b"))
    return population.join(a, key, "left").join(b, key, "left").withColumn(value, F.coalesce("__a", "__b")).drop("__a", "__b")


def contacted_within(candidates: DataFrame, contacts: DataFrame, key: str, sent: str, today: Column, days: int) -> DataFrame:
    """Candidates without a contact in the last `days` days."""
    recent = contacts.where(as_column(sent).between(F.date_sub(today, days), today)).select(key).distinct()
    return candidates.join(recent, key, "left_anti")
