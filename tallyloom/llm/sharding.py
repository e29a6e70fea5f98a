"""Sharding by fixed virtual slots.

A record hashes into one of a few thousand slots by its id alone. A small versioned map says which shard owns each
slot. Rebalancing edits the map and never the hash, so only the records of reassigned slots move.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage, shared_folder

SLOTS = 4096


def slot_of(doc_id: str = "doc_id", slots: int = SLOTS) -> Column:
    """Slot of a record; a null id has the slot of its hash seed."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(slots)).cast("int")


def handed_over(owners: list[int], shards: int) -> list[int]:
    """Owners of the slots with one more shard, number `shards`: it takes slots one by one, each the last one of the shard that
    holds most (the first such shard), until it holds len(owners) // (shards + 1)."""
    owners = list(owners)
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, shard in enumerate(owners):
        held[shard].append(slot)
    for _ in range(len(owners) // (shards + 1)):
        fullest = max(range(shards), key=lambda s: (len(held[s]), -s))
        owners[held[fullest].pop()] = shards
    return owners


def _as_map(spark: SparkSession, owners: list[int], version: int) -> DataFrame:
    return spark.createDataFrame([(slot, shard, version) for slot, shard in enumerate(owners)], "vslot int, shard int, version int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 of the map (vslot, shard, version): one shard that grew to `shards`, so the map of a number of shards is always the same."""
    if not 0 < shards <= slots:
        raise ValueError("shards must be between 1 and the number of slots")
    owners = [0] * slots
    for n in range(1, shards):
        owners = handed_over(owners, n)
    return _as_map(spark, owners, 1)


def write_map(slot_map: DataFrame, folder: str) -> int:
    """Store a map under its version in a shared folder and return the version; a stored version is never replaced."""
    version = slot_map.agg(F.max("version")).head()[0]
    slot_map.coalesce(1).write.mode("error").parquet(f"{folder.rstrip('/')}/v{version}")
    return version


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """A map that `write_map` stored."""
    return spark.read.parquet(f"{folder.rstrip('/')}/v{version}")


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """Next version with one more shard, number `shards`; every slot that it does not take stays where it is (see `handed_over`).

    The map has one row for each slot, at most a few thousand, and is edited on the driver.
    """
    rows = sorted(slot_map.select("vslot", "shard", "version").collect())
    return _as_map(slot_map.sparkSession, handed_over([r["shard"] for r in rows], shards), max(r["version"] for r in rows) + 1)


def rebalance(slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Next version that evens out bytes: shards above the mean hand slots to shards below it.

    `loads` has (vslot, bytes); a slot without a load is empty. A shard above the mean keeps its smallest slots as far as they fit
    into the mean; the others, the largest first, each go to the shard that holds least by then. Both tables have one row for each
    slot, at most a few thousand, and the map is edited on the driver.
    """
    rows = sorted(slot_map.select("vslot", "shard", "version").collect())
    bytes_of = {r["vslot"]: r["bytes"] or 0 for r in loads.select("vslot", "bytes").collect()}
    owners = [r["shard"] for r in rows]
    slots_of: dict[int, list[int]] = {s: [] for s in owners}
    for r in rows:
        slots_of[r["shard"]].append(r["vslot"])
    mean = sum(bytes_of.get(r["vslot"], 0) for r in rows) / len(slots_of)
    held, queue = dict.fromkeys(slots_of, 0), []
    for shard, slots in slots_of.items():
        for size, slot in sorted((bytes_of.get(v, 0), v) for v in slots):
            if held[shard] + size <= mean:
                held[shard] += size
            else:
                queue.append((-size, slot, shard))
    room = [(size, shard) for shard, size in held.items()]
    heapify(room)
    for size, slot, _ in sorted(queue):
        least, shard = heappop(room)
        owners[slot] = shard
        heappush(room, (least - size, shard))
    return _as_map(slot_map.sparkSession, owners, rows[0]["version"] + 1)


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text", slot_map: DataFrame | None = None) -> DataFrame:
    """Shard of every document under the law `key`: the id and the number of shards decide.

    The map of that number of shards is written as version 1, read, grown by one shard, and written and read as version 2, whose
    shard is `grown_shard`; it equals the `shard` of a call with one more shard. With a stored `slot_map` of the same `shards`
    and `slots` the id and that map decide, and the law is `map`.

    Returns doc_id, size (UTF-8 bytes + 8; null text: 8), text_crc32 (null text: crc of nothing, 0), law, shard,
    slot (place within the shard, gapless from 0), grown_shard (shard with one more shard), vslot, slot_bytes and
    map_version. Places are the rows of earlier slots of the shard plus the place inside the virtual slot, ordered by
    id, size and checksum, so no task sees a whole shard. Repeated rows get places of their own; an empty table gives
    no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "slot-maps")
    if slot_map is None:
        owner = read_map(spark, folder, write_map(first_map(spark, shards, slots), folder))
    else:
        owner = slot_map
    later = read_map(spark, folder, write_map(grow(owner, shards), folder)).select("vslot", F.col("shard").alias("grown_shard"))
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content.cast("binary")).cast("long").alias("text_crc32"),
        slot_of(doc_id, slots).alias("vslot"),
    )
    rows = cut_lineage(rows)
    loads = rows.groupBy("vslot").agg(F.count("*").alias("n"), F.sum("size").alias("slot_bytes"))
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    table = owner.join(later, "vslot").join(loads, "vslot").withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32"))
    placed = rows.withColumn("inside", inside)
    return placed.join(F.broadcast(table), "vslot").select(
        "doc_id", "size", "text_crc32", F.lit("key" if slot_map is None else "map").alias("law"), "shard", (F.col("ahead") + F.col("inside") - 1).alias("slot"), "grown_shard",
        "vslot", "slot_bytes", F.col("version").alias("map_version"),
    )


def slot_loads(docs: DataFrame, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and rows of each virtual slot: (vslot, n, bytes)."""
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 8
    return docs.select(slot_of(doc_id, slots).alias("vslot"), size.cast("long").alias("size")).groupBy("vslot").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
