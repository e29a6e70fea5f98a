"""Shared helpers of the corpus operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Fixed value: runs of these characters separate the words of a text.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_ROWS = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def key_columns(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """96 bits that name a row by id and text; never null, equal only for repeated rows."""
    parts = [F.col(doc_id), F.col(text), F.col(doc_id).isNull(), F.col(text).isNull()]
    return [F.xxhash64(*parts).alias("__k1"), F.hash(*reversed(parts)).alias("__k2")]


KEY = ["__k1", "__k2"]


def materialised(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as a table in the shared folder of the session, and read."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as keep it apart from the columns of `docs`."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def joined_by_key(docs: DataFrame, others: DataFrame, how: str = "inner", doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` joined with a table of KEY by the rows' keys, whatever the columns of `docs` are called, and the names of the keys in it."""
    names = free_names(docs, *KEY)
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(key_columns(doc_id, text), names)])
    return keyed.join(others.withColumnsRenamed(dict(zip(KEY, names))), names, how), names


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` alone would also change letters outside ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def small_or_shuffled(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a materialised narrow table of `rows` rows only when that count is below `limit`."""
    return F.broadcast(df) if rows <= limit else df


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans that nothing refers to any more.

    The JVM hears of frames that Python has dropped a moment later, so one collection does not find them.
    """
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.25)
