"""Load planning: pack orders into vehicles per city.

Packing is sequential by nature. A city is cut by age into chunks of bounded size, which
are packed in parallel; what a chunk leaves waiting is packed again with the rest of the
city, so a large city is never one task. Constraints hold for every vehicle; the plan is
a greedy one and not claimed to be optimal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import ratio
from tallyloom.operators.aggregates import first_row
from tallyloom.operators.ranking import global_rank
from tallyloom.session import cut_lineage

# Least share of a vehicle that must be filled, and share of the goods' value that pays for it.
MIN_FILL = 0.8
VALUE_SHARE = 0.1


def vehicle_rates(vehicles: DataFrame, rates: DataFrame) -> DataFrame:
    """Vehicles with one rate per city; of repeated rates the lowest counts."""
    once = first_row(rates.withColumn("city", F.trim("city")).select("city", "vehicle", "rate"), ["city", "vehicle"], ["rate"])
    return vehicles.join(once, "vehicle")


def candidates(waiting: DataFrame, fleet: DataFrame) -> DataFrame:
    """Vehicles whose minimum weight or volume the waiting goods of the city cover, largest first.

    `waiting`: city, weight, volume (sums). One row per vehicle of a city.
    """
    fits = (F.col("capacity_weight") * MIN_FILL <= F.col("weight")) | (F.col("capacity_volume") * MIN_FILL <= F.col("volume"))
    rows = fleet.join(waiting, "city").where(fits)
    place = Window.partitionBy("city").orderBy(F.desc("capacity_weight"), "vehicle")
    return rows.select("city", "vehicle", "capacity_weight", "capacity_volume", "rate", F.row_number().over(place).alias("choice"))


_PACKED = "city string, item_id long, day date, weight double, volume double, value double, vehicle string, load string, assigned date"


def _pack_chunk(goods: pd.DataFrame, fleet: pd.DataFrame) -> pd.DataFrame:
    """Greedy packing of one chunk, day by day, oldest goods first, largest vehicle first."""
    goods = goods.sort_values(["day", "item_id"]).reset_index(drop=True)
    fleet = fleet.sort_values(["capacity_weight", "vehicle"], ascending=[False, True])
    trucks = list(fleet[["vehicle", "capacity_weight", "capacity_volume", "rate"]].itertuples(index=False))
    weight, volume, value = (goods[c].to_numpy() for c in ("weight", "volume", "value"))
    one_weight, one_volume, one_value = weight.tolist(), volume.tolist(), value.tolist()  # single numbers are read faster from lists
    days, ids = goods["day"].to_numpy(), goods["item_id"].to_numpy()
    vehicle, load, assigned = (np.full(len(goods), None, dtype=object) for _ in range(3))
    starts = [0, *(np.flatnonzero(days[1:] != days[:-1]) + 1).tolist(), len(goods)]
    waiting: list[int] = []
    total_w = total_v = 0.0
    for first, end in zip(starts, starts[1:], strict=False):
        waiting += range(first, end)
        total_w += float(weight[first:end].sum())
        total_v += float(volume[first:end].sum())
        choice = 0
        while choice < len(trucks):
            truck = trucks[choice]
            if truck.capacity_weight * MIN_FILL > total_w and truck.capacity_volume * MIN_FILL > total_v:
                choice += 1
                continue
            taken, left, w, v, money = [], [], 0.0, 0.0, 0.0
            for i in waiting:
                if w + one_weight[i] <= truck.capacity_weight and v + one_volume[i] <= truck.capacity_volume:
                    taken.append(i)
                    w, v, money = w + one_weight[i], v + one_volume[i], money + one_value[i]
                else:
                    left.append(i)
            filled = w >= truck.capacity_weight * MIN_FILL or v >= truck.capacity_volume * MIN_FILL
            if not taken or not filled or money * VALUE_SHARE < truck.rate:
                choice += 1
                continue
            vehicle[taken], load[taken], assigned[taken] = truck.vehicle, f"{truck.vehicle}_{ids[taken[0]]}", days[first]
            waiting, total_w, total_v = left, total_w - w, total_v - v
    return goods.assign(vehicle=vehicle, load=load, assigned=assigned)


def pack(goods: DataFrame, fleet: DataFrame, chunk: int = 20_000, rounds: int = 2) -> DataFrame:
    """Assign goods to loads; rows without a load wait.

    `goods`: city, item_id (unique), day, weight, volume, value; `fleet`: city, vehicle,
    capacity_weight, capacity_volume, rate.
    """
    names = ["city", "item_id", "day", "weight", "volume", "value"]
    waiting = cut_lineage(
        goods.select("city", F.col("item_id").cast("long").alias("item_id"), "day", *[F.col(c).cast("double").alias(c) for c in names[3:]])
    )

    def run(pair_goods: pd.DataFrame, pair_fleet: pd.DataFrame) -> pd.DataFrame:
        if pair_goods.empty:
            return pair_goods.reindex(columns=[*names, "vehicle", "load", "assigned"])
        return _pack_chunk(pair_goods, pair_fleet)[[*names, "vehicle", "load", "assigned"]]

    done = None
    for _ in range(rounds):
        ranked = global_rank(waiting.withColumn("__day", F.unix_date("day")), F.col("__day"), "item_id", ["city"], rank="__rank")
        chunks = ranked.withColumn("__chunk", F.floor((F.col("__rank") - 1) / chunk)).drop("__day", "__rank")
        counts = chunks.select("city", "__chunk").distinct()
        trucks = counts.join(fleet, "city").select(F.col("city").alias("__city"), F.col("__chunk").alias("__part"), "vehicle", *[F.col(c).cast("double").alias(c) for c in ("capacity_weight", "capacity_volume", "rate")])
        packed = chunks.groupBy("city", "__chunk").cogroup(trucks.groupBy("__city", "__part")).applyInPandas(run, _PACKED).persist()
        loaded = packed.where(F.col("load").isNotNull())
        done = loaded if done is None else done.unionByName(loaded)
        waiting = packed.where(F.col("load").isNull()).select(*names)
    return done.unionByName(waiting, allowMissingColumns=True)


def load_delay(packed: DataFrame) -> DataFrame:
    """Number of goods by days waited."""
    rows = packed.where(F.col("load").isNotNull())
    return rows.groupBy(F.datediff("assigned", "day").alias("delay")).agg(F.count(F.lit(1)).alias("n"))


def pending(waiting: DataFrame, fleet: DataFrame) -> DataFrame:
    """Waiting sums per city against its smallest vehicle; `explained` when they fill none."""
    sums = waiting.groupBy("city").agg(*[F.sum(c).alias(c) for c in ("volume", "weight", "value")])
    least = fleet.groupBy("city").agg(F.min("capacity_volume").alias("capacity_volume"), F.min("capacity_weight").alias("capacity_weight"))
    small = (F.col("volume") < F.col("capacity_volume") * MIN_FILL) & (F.col("weight") < F.col("capacity_weight") * MIN_FILL)
    return sums.join(least, "city").withColumn("explained", small)


def totals(packed: DataFrame, fleet: DataFrame) -> DataFrame:
    """Sums per load and the filled shares of its vehicle."""
    sums = packed.where(F.col("load").isNotNull()).groupBy("city", "vehicle", "load").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("weight", "volume", "value")]
    )
    return sums.join(fleet, ["city", "vehicle"]).select(
        *sums.columns, ratio("weight", "capacity_weight").alias("weight_share"), ratio("volume", "capacity_volume").alias("volume_share"), "rate"
    )
