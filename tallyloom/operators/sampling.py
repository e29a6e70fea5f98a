"""Repeatable sampling, splits and resampling by a hash of the key.

The hash text is the same wherever it is computed, so a task that runs again after an
executor is lost draws the same rows. The hash is uniform, so ranks by hash need no
pass to find the cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column
from tallyloom.operators.ranking import bucket_count, global_rank

HASH_RANGE = 2**32


def key_hash(key: Column | str, seed: Column | str = "s") -> Column:
    """Uniform integer in [0, 2**32) from a key and a seed; a seed may differ from row to row."""
    start = F.concat(seed.cast("string"), F.lit("|")) if isinstance(seed, Column) else F.lit(f"{seed}|")
    text = F.concat(start, as_column(key).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def unit_hash(key: Column | str, seed: str = "s") -> Column:
    """Uniform number in [0, 1) from a key and a seed."""
    return key_hash(key, seed) / F.lit(float(HASH_RANGE))


def normal_hash(key: Column | str, seed: str = "s") -> Column:
    """Standard normal number from a key and a seed (Box-Muller)."""
    u = (key_hash(key, seed) + 1) / F.lit(HASH_RANGE + 1.0)
    v = unit_hash(key, seed + "#")
    return F.sqrt(-2 * F.log(u)) * F.cos(v * (2 * 3.141592653589793))


def hash_rank(
    df: DataFrame, key: str, seed: str = "s", group: Sequence[str] = (), rank: str = "rank", size: str | None = None
) -> DataFrame:
    """Place of each row in the random order of its group; ties of the hash go by key."""
    n = bucket_count(df)
    cuts = [HASH_RANGE * i / n for i in range(1, n)]
    return global_rank(df, key_hash(key, seed), key, group, rank=rank, size=size, cuts=cuts)


def bernoulli(df: DataFrame, key: str, n: int, seed: str = "s") -> DataFrame:
    """Keep each row with probability n / count(*); about n rows remain."""
    share = df.agg(F.least(F.lit(1.0), F.lit(float(n)) / F.count(F.lit(1))).alias("share"))
    return df.where(unit_hash(key, seed) < share.scalar())


def fixed_n(df: DataFrame, key: str, n: int, seed: str = "s") -> DataFrame:
    """n rows in hash order."""
    return df.orderBy(key_hash(key, seed), key).limit(n)


def fraction_by_group(
    df: DataFrame, group: str, key: str, fractions: dict[object, float], seed: str = "s"
) -> DataFrame:
    """Keep a fraction of each group; groups without a fraction are left out."""
    keep = F.lit(False)
    for value, fraction in fractions.items():
        keep = keep | ((F.col(group) == F.lit(value)) & (unit_hash(key, seed) < F.lit(fraction)))
    return df.where(keep)


def n_by_group(df: DataFrame, group: str, key: str, n: int, seed: str = "s") -> DataFrame:
    """n rows of each group in hash order."""
    return hash_rank(df, key, seed, [group], rank="__rank").where(F.col("__rank") <= n).drop("__rank")


def named_split(
    df: DataFrame, key: str, parts: Sequence[tuple[str, float]], seed: str = "s", strata: Sequence[str] = (),
    out: str = "split",
) -> DataFrame:
    """Random parts of exact size int(fraction * n) per stratum; the last part takes the rest."""
    ranked = hash_rank(df, key, seed, strata, rank="__rank", size="__size")
    label = F.lit(parts[-1][0])
    done = F.lit(0)
    branches = []
    for name, fraction in parts[:-1]:
        done = done + F.floor(F.round(F.col("__size") * F.lit(fraction), 9)).cast("long")
        branches.append((name, done))
    for name, limit in reversed(branches):
        label = F.when(F.col("__rank") <= limit, name).otherwise(label)
    return ranked.withColumn(out, label).drop("__rank", "__size")


def train_test(
    df: DataFrame, key: str, test: float, seed: str = "s", strata: Sequence[str] = (), out: str = "split"
) -> DataFrame:
    """Two disjoint parts with exact fractions inside each stratum."""
    return named_split(df, key, [("test", test), ("train", 1 - test)], seed, strata, out)


def mod_split(df: DataFrame, key: str, modulus: int, limits: Sequence[tuple[str, int]], out: str = "split") -> DataFrame:
    """Parts by remainder: a part takes the remainders below its limit, the last one the rest."""
    place = F.pmod(F.col(key), F.lit(modulus))
    label = F.lit(limits[-1][0])
    for name, limit in reversed(limits[:-1]):
        label = F.when(place < limit, name).otherwise(label)
    return df.withColumn(out, label)


def seed_proof_split(df: DataFrame, key: str, target: str, seeds: float, proof: float, seed: str = "s") -> DataFrame:
    """Positives split in seeds and proof; the rest of the positives and all negatives are 'others'."""
    strata = df.withColumn("__positive", F.coalesce(F.col(target) == 1, F.lit(False)).cast("int"))
    split = named_split(
        strata, key, [("seeds", seeds), ("proof", proof), ("others", 1 - seeds - proof)], seed, ["__positive"], "set"
    )
    return split.withColumn("set", F.when(F.col("__positive") == 1, F.col("set")).otherwise("others")).drop("__positive")


def balance_under(df: DataFrame, group: str, key: str, seed: str = "s") -> DataFrame:
    """Cut every group to the size of the smallest one."""
    ranked = hash_rank(df, key, seed, [group], rank="__rank", size="__size")
    smallest = df.groupBy(group).count().agg(F.min("count"))
    return ranked.where(F.col("__rank") <= smallest.scalar()).drop("__rank", "__size")


def balance_over(df: DataFrame, group: str, key: str, seed: str = "s", out: str = "copy") -> DataFrame:
    """Repeat rows until every group is as large as the largest one.

    Each row is kept, then whole rounds of copies are added, then one more copy for as
    many rows as are still missing, in hash order. Copies are made where the row is.
    """
    ranked = hash_rank(df, key, seed, [group], rank="__rank", size="__size")
    largest = df.groupBy(group).count().agg(F.max("count").alias("largest"))
    sized = ranked.withColumn("__largest", largest.scalar())
    copies = F.floor(F.col("__largest") / F.col("__size")) + F.when(
        F.col("__rank") <= F.col("__largest") % F.col("__size"), 1
    ).otherwise(0)
    return sized.withColumn(out, F.explode(F.sequence(F.lit(1).cast("long"), copies.cast("long")))).drop(
        "__rank", "__size", "__largest"
    )
