"""Registry of runnable queries: name -> builder, name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.oracle import oracle
from tallyloom.sources.tables import Tables

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Builders and SQL as registered, for queries made of other ones.
PARTS: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Plain output types: long, double and string only, in the order of the operator."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a builder that takes `Tables` and returns a DataFrame."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in BUILDERS:
            raise ValueError(f"{name} is registered twice")
        BUILDERS[name] = lambda spark, folder: presentable(build(Tables(spark, folder)))
        if sql is not None:
            ORACLES[name] = oracle(sql)
            PARTS[name] = (build, sql)
        return build

    return register
