"""Segments by share of the population, from exact distributed ranks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ranking import global_rank, ntile
from tallyloom.operators.sampling import named_split, unit_hash
from tallyloom.session import cut_lineage

# Shares of the ranked population; the last segment takes the rest.
SHARES_4 = [0.1, 0.1, 0.2]
SHARES_5 = [0.2, 0.2, 0.2, 0.2]
SHARES_6 = [0.1, 0.1, 0.1, 0.1, 0.1]


def quantile_segments(
    df: DataFrame, shares: Sequence[float], order: Column | str, tie: str, descending: bool = True,
    out: str = "segment", prefix: str = "q",
) -> DataFrame:
    """q1, q2, ... by rank; each size is int(n * share), the last segment takes the rest."""
    ranked = global_rank(df, order, tie, descending=descending, rank="__rank", size="__size")
    label = F.lit(f"{prefix}{len(shares) + 1}")
    end = F.lit(0).cast("long")
    ends = []
    for share in shares:
        end = end + F.floor(F.col("__size") * F.lit(share)).cast("long")
        ends.append(end)
    for i in range(len(shares), 0, -1):
        label = F.when(F.col("__rank") <= ends[i - 1], f"{prefix}{i}").otherwise(label)
    return ranked.withColumn(out, label).drop("__rank", "__size")


def qcut(df: DataFrame, n: int, order: Column | str, tie: str, out: str = "bucket", descending: bool = False) -> DataFrame:
    """Equal-count buckets by rank."""
    return ntile(df, n, order, tie, descending=descending, out=out)


def ab_split(df: DataFrame, key: str, groups: Sequence[str], fractions: Sequence[float] | None = None, seed: str = "s", out: str = "group") -> DataFrame:
    """Named random groups; the last one takes the rest."""
    fractions = list(fractions or [1 / len(groups)] * len(groups))
    return named_split(df, key, list(zip(groups, fractions, strict=True)), seed, out=out)


def _reached(value: Column, key: Column, border: tuple | None) -> Column:
    """Whether a row stands at a border or before it, best value first, ties by key."""
    if border is None:
        return F.lit(False)
    edge = F.lit(border[0])
    return F.coalesce((value > edge) | ((value == edge) & (key <= F.lit(border[1]))), F.lit(False))


def _later(one: tuple | None, other: tuple | None) -> tuple | None:
    if one is None or other is None:
        return one or other
    return max(one, other, key=lambda border: (-border[0], border[1]))


def _in_turn(rows: pd.DataFrame, steps: Sequence[str], quotas: Sequence[int]) -> list[tuple | None]:
    """Border of every step over rows that fit in memory."""
    borders: list[tuple | None] = []
    for step, quota in zip(steps, quotas, strict=True):
        taken = rows.sort_values([step, "key"], ascending=[False, True]).head(quota)
        borders.append((float(taken[step].iloc[-1]), taken["key"].iloc[-1]) if len(taken) else None)
        rows = rows.drop(index=taken.index)
    return borders


def _bands(sample: pd.DataFrame, steps: Sequence[str], places: Sequence[int], margin: int) -> list[tuple]:
    """Two rows per step between which its border lies; the second is None when the band has no end.

    A step's band also covers what the bands before it leave open: its start counts rows that may be
    free as free, its end counts them as taken.
    """
    out = []
    possible, sure = sample, sample
    for step, place in zip(steps, places, strict=True):
        best = [rows.sort_values([step, "key"], ascending=[False, True])[[step, "key"]] for rows in (possible, sure)]
        start, end = place - margin - 1, place + margin
        high = (float(best[0][step].iloc[start]), best[0]["key"].iloc[start]) if 0 <= start < len(best[0]) else None
        low = (float(best[1][step].iloc[end]), best[1]["key"].iloc[end]) if end < len(best[1]) else None
        out.append((high, low))
        possible = possible.drop(index=best[0].index[: start + 1] if start >= 0 else [])
        sure = sure.drop(index=best[1].index[: end + 1])
    return out


def _holds(cells: pd.DataFrame, bands: Sequence[tuple], quotas: Sequence[int]) -> bool:
    """Whether every border lies in its band, from exact counts of the joint histogram.

    A cell has one digit per step: 0 before the band, 1 inside, 2 behind it.
    """
    sure = np.ones(len(cells), dtype=bool)
    possible = np.ones(len(cells), dtype=bool)
    n = cells["n"].to_numpy()
    for i, ((_, low), quota) in enumerate(zip(bands, quotas, strict=True)):
        digit = cells["cell"].str[i].to_numpy()
        if n[possible & (digit == "0")].sum() > quota or (low is not None and n[sure & (digit != "2")].sum() < quota):
            return False
        possible &= digit != "0"
        sure &= digit == "2"
    return True


def _borders(rows: DataFrame, steps: Sequence[str], quotas: Sequence[int], held: int, salt: int = 0) -> list[tuple | None]:
    """Last row of every step's quota.

    Up to `held` rows are solved at once. More are narrowed: a hashed sample gives a band for every
    step, one joint histogram of the bands (3 ** steps cells) proves them and counts the rows whose step is
    then known, and only the rows that are still open go on, with what is left of the quotas.
    """
    n = rows.count()
    if n <= held:
        return _in_turn(rows.toPandas(), steps, quotas)
    share = held / n
    for turn in range(salt, salt + 8):
        sample = rows.where(unit_hash("key", f"quota{turn}") < share).toPandas()
        places = [round(q * len(sample) / n) for q in quotas]
        bands = _bands(sample, steps, places, math.ceil(2 * math.sqrt(len(sample))))
        key = F.col("key")
        digits = [
            F.when(_reached(F.col(s), key, high), "0").when(F.lit(low is None) | _reached(F.col(s), key, low), "1").otherwise("2")
            for s, (high, low) in zip(steps, bands, strict=True)
        ]
        marked = rows.withColumn("cell", F.concat(*digits))
        cells = marked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()
        first = cells["cell"].str.lstrip("2")
        if _holds(cells, bands, quotas) and cells["n"][first.str.startswith("1")].sum() < n:
            break
    else:
        raise RuntimeError("no sample gave bands that hold the borders")
    known = [int(cells["n"][(first.str.len() == len(steps) - i) & first.str.startswith("0")].sum()) for i in range(len(steps))]
    left = [q - k for q, k in zip(quotas, known, strict=True)]
    open_ = cut_lineage(marked.where(F.ltrim("cell", F.lit("2")).startswith("1")).drop("cell"))
    inner = _borders(open_, steps, left, held, turn + 1)
    return [_later(high, border) for (high, _), border in zip(bands, inner, strict=True)]


def quota_by_probability(
    df: DataFrame, probabilities: Sequence[str], last: str, key: str, share: float = 0.1, last_share: float = 0.5,
    rest: str = "q5", out: str = "segment", held: int = 200_000,
) -> DataFrame:
    """Segments in turn without replacement: the best `share` by each probability, then `last_share`
    by the last one; who is left gets `rest`. Missing probabilities come last, ties go by key.

    All borders are found together (`_borders`, `held` bounds what the driver gets), so the result
    is one CASE over the input and the plan does not grow from step to step.
    """
    shares = [(name, share) for name in probabilities] + [(last, last_share)]
    numbers = {name: F.nanvl(F.coalesce(F.col(name).cast("double"), F.lit(-math.inf)), F.lit(-math.inf)) for name, _ in shares}
    narrow = cut_lineage(df.select(F.col(key).alias("key"), *[numbers[name].alias(f"s{i}") for i, (name, _) in enumerate(shares)]))
    n = narrow.count()
    steps = {f"s{i}": (name, int(n * part)) for i, (name, part) in enumerate(shares) if int(n * part)}
    borders = _borders(narrow, list(steps), [quota for _, quota in steps.values()], held) if steps else []
    label = F.lit(rest)
    for (name, _), border in reversed(list(zip(steps.values(), borders, strict=True))):
        label = F.when(_reached(numbers[name], F.col(key), border), name).otherwise(label)
    return df.withColumn(out, label)


def _scaled(columns: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="__raw", handleInvalid="skip"),
        StandardScaler(inputCol="__raw", outputCol="__scaled", withMean=True, withStd=True),
    ]


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int, seed: int = 1) -> PipelineModel:
    """Standardise and cluster; the model can be saved and applied to another date."""
    steps = [*_scaled(columns), KMeans(k=k, seed=seed, featuresCol="__scaled", predictionCol="cluster")]
    return Pipeline(stages=steps).fit(df)


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("__raw", "__scaled")


def elbow(df: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 1) -> DataFrame:
    """Inertia (squared distances) and distortion (mean distance) for several numbers of clusters."""
    scaled = Pipeline(stages=_scaled(columns)).fit(df).transform(df).select("__scaled").cache()
    out = []
    n = scaled.count()
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol="__scaled").fit(scaled)
        centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
        point = vector_to_array("__scaled")
        distance = F.array_min(
            F.transform(
                centers,
                lambda c: F.sqrt(F.aggregate(F.zip_with(point, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)),
            )
        )
        total = scaled.agg(F.sum(distance)).first()[0]
        out.append((k, float(model.summary.trainingCost), float(total / n)))
    scaled.unpersist()
    return df.sparkSession.createDataFrame(out, "k int, inertia double, distortion double")
