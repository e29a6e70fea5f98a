"""Readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, folder: str | Sequence[str], condition: str | None = None) -> DataFrame:
    """All Parquet parts of a folder as one table; the condition reaches the scan."""
    paths = [folder] if isinstance(folder, str) else list(folder)
    df = spark.read.parquet(*paths)
    return df if condition is None else df.where(condition)


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], schema: str, sep: str = "|", header: bool = True,
    skip_bad_lines: bool = False,
) -> DataFrame:
    """Delimited text with a declared schema; bad lines fail the read or are dropped."""
    mode = "DROPMALFORMED" if skip_bad_lines else "FAILFAST"
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).options(sep=sep, header=header, mode=mode).csv(paths)


def read_concatenated(spark: SparkSession, paths: Sequence[str], schema: str, names: Sequence[str], sep: str = "|") -> DataFrame:
    """Several delimited files as one table, renamed by position."""
    return read_delimited(spark, list(paths), schema, sep).toDF(*names)


def run_sql(spark: SparkSession, text: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """SQL over named frames, with typed parameters instead of pasted text."""
    return spark.sql(text, args=dict(args) if args else None, **frames)


class NamedQueries:
    """SQL texts by name, filled with parameters."""

    def __init__(self, texts: Mapping[str, str]):
        self.texts = dict(texts)

    def run(self, spark: SparkSession, name: str, args: Mapping | None = None, **frames: DataFrame) -> DataFrame:
        if name not in self.texts:
            raise KeyError(f"no query {name}; known: {sorted(self.texts)}")
        return run_sql(spark, self.texts[name], args, **frames)


def write_parquet(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a folder by the rows of a frame."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def write_delimited(df: DataFrame, folder: str, sep: str = "|") -> None:
    df.write.mode("overwrite").options(sep=sep, header=True).csv(folder)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Coerce to declared types; what cannot be read becomes NULL.

    Types: ``integer``, ``string``, ``date``, ``timestamp`` or ``decimal(n)``, which
    rounds to n digits. Spaces in names become ``__``.
    """

    def coerced(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind.startswith("decimal("):
            return F.round(c.try_cast("double"), int(kind[8:-1]))
        return c.try_cast({"integer": "bigint", "timestamp": "timestamp_ntz"}.get(kind, kind))

    return df.select(*[coerced(n, k).alias(n.replace(" ", "__")) for n, k in types.items()])


def latest_complete(paths: DataFrame, files: Sequence[str], path: str = "path") -> DataFrame:
    """Newest date folder that holds all required files; `paths` has one row per file."""
    parts = paths.select(
        F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})/[^/]+$", 1).try_cast("date").alias("folder_date"),
        F.regexp_extract(path, r"([^/]+)$", 1).alias("file"),
    )
    return (
        parts.where(F.col("file").isin(*files) & F.col("folder_date").isNotNull())
        .groupBy("folder_date").agg(F.count_distinct("file").alias("n"))
        .where(F.col("n") == len(files))
        .agg(F.max("folder_date").alias("folder_date"))
    )
