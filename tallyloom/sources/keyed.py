"""Table maintenance on plain files: each operator returns the new content of a table.

Write the result to a new folder (or table) and swap; a job that reads and overwrites
one folder loses it when an executor is lost half way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def truncate_insert(batch: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content of a staging table after a refresh: only the batch, in the table's column order."""
    return batch.select(*columns)


def replace_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows whose keys occur in the batch, then append the batch."""
    return target.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(
        batch, allowMissingColumns=True
    )


def append_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the batch rows whose keys the target lacks."""
    return target.unionByName(batch.join(target.select(*keys).distinct(), list(keys), "left_anti"))


def upsert_extract(history: DataFrame, batch: DataFrame, site: str = "site", day: str = "day") -> DataFrame:
    """Replace the (site, date) slices of a history table that occur in the batch."""
    return replace_keys(history, batch, [site, day])


def update_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set columns where all keys match, insert the other batch rows; one row per key on both sides."""
    new = batch.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns])
    rest = [c for c in target.columns if c not in keys and c not in columns]
    return target.join(new, list(keys), "full").select(
        *keys, *rest, *[F.coalesce(f"__new_{c}", c).alias(c) for c in columns]
    ).select(*target.columns)
