"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into a fixed number of slots for good. A map of slots to shards (version, slot, shard) is the only
thing that changes: rebalancing edits the map, so that only records of moved slots move. The map and the
per-slot sums have one row per slot, so both are bounded by the number of slots, whatever the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import scratch_dir

SLOTS = 8192
MAP_SCHEMA = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("virtual_slot", T.IntegerType()), T.StructField("shard", T.IntegerType())])


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a record; a null key has slot 0's hash seed, so it goes to one fixed slot."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def initial_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt round robin."""
    return [slot % shards for slot in range(slots)]


def edit_map(current: list[int], slot_bytes: dict[int, int], shards: int) -> list[int]:
    """Next version: move or swap slots between the fullest and the emptiest shard until neither brings them closer.

    Runs on the driver over one number per slot. New shards (shards above those in current) fill the same way.
    """
    new = list(current)
    weight = [slot_bytes.get(s, 0) for s in range(len(new))]
    load = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in enumerate(new):
        load[shard] += weight[slot]
        held[shard].add(slot)
    for _ in range(len(new) * 4):
        full, empty = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        best: tuple[int, int, int | None] = (gap, -1, None)  # the gap that stays, slot given, slot taken
        mine = sorted((weight[s], s) for s in held[full])
        theirs = sorted((weight[s], s) for s in held[empty])
        for w, s in mine:
            if w and abs(gap - 2 * w) < best[0]:
                best = (abs(gap - 2 * w), s, None)
        if best[0] > gap // 8:  # no single slot fits well: try pairs, by two pointers over the sorted weights
            j = 0
            for w, s in mine:
                while j < len(theirs) - 1 and 2 * (w - theirs[j][0]) > gap:
                    j += 1
                for k in (j - 1, j):
                    if 0 <= k < len(theirs) and w > theirs[k][0] and abs(gap - 2 * (w - theirs[k][0])) < best[0]:
                        best = (abs(gap - 2 * (w - theirs[k][0])), s, theirs[k][1])
        if best[1] < 0 or gap - best[0] < 2:
            break
        for slot, a, b in ((best[1], full, empty), (best[2], empty, full)):
            if slot is not None:
                held[a].discard(slot)
                held[b].add(slot)
                load[a] -= weight[slot]
                load[b] += weight[slot]
                new[slot] = b
    return new


def store_version(spark: SparkSession, path: str, version: int, mapping: list[int]) -> None:
    """Add a version of the map to the table at path: a folder per version, written once, never changed."""
    rows = [(version, slot, shard) for slot, shard in enumerate(mapping)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{path}/v{version}")


def read_version(spark: SparkSession, path: str, version: int) -> list[int]:
    """Shard of every slot in a stored version."""
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/v{version}").collect()  # one row per slot
    return [shard for _, _, shard in sorted(rows, key=lambda r: r[1])]


def slot_sizes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """virtual_slot, bytes, rows; summed on the map side, at most one row per slot and task is shuffled."""
    return (
        docs.select(virtual_slot(docs[id_col], slots).alias("virtual_slot"), record_size(docs[text_col]).alias("size"))
        .groupBy("virtual_slot")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    )


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def assign_shards(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Put every record into a shard so that the shards' bytes come out nearly equal.

    Returns id_col, size, text_crc32, virtual_slot, shard, map_version, position (gapless from 0 within each shard).
    Version 0 of the map deals slots round robin, version 1 is edited by the measured bytes per slot; both are stored
    at map_path (by default a new folder in the shared one), and records are placed by the stored version 1. Records with
    one key share a slot; a null text has no bytes and the checksum 0; an empty table gives no rows; rows that are
    equal in every column still get different positions. Positions come from ranks within slots plus the slots'
    offsets, so no task holds more than a slot.
    """
    spark = docs.sparkSession
    sizes = {r[0]: (r[1], r[2]) for r in slot_sizes(docs, id_col=id_col, text_col=text_col, slots=slots).collect()}
    first = initial_map(shards, slots)
    edited = edit_map(first, {k: v[0] for k, v in sizes.items()}, shards)
    map_path = map_path or f"{scratch_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    for version, mapping in enumerate((first, edited)):
        store_version(spark, map_path, version, mapping)
    edited = read_version(spark, map_path, 1)
    offset, filled = [0] * slots, [0] * shards
    for slot, shard in enumerate(edited):
        offset[slot] = filled[shard]
        filled[shard] += sizes.get(slot, (0, 0))[1]
    lookup = spark.createDataFrame([(s, edited[s], offset[s]) for s in range(slots)], "virtual_slot int, shard int, slot_offset long")
    rows = docs.select(
        docs[id_col].alias("__key"),
        record_size(docs[text_col]).alias("size"),
        F.crc32(F.coalesce(F.encode(docs[text_col], "UTF-8"), F.lit(b""))).alias("text_crc32"),
        virtual_slot(docs[id_col], slots).alias("virtual_slot"),
    )
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("__key", "text_crc32", "size"))
    return (
        rows.withColumn("__rank", rank.cast("long") - 1)
        .join(F.broadcast(lookup), "virtual_slot")  # as many rows as slots
        .select(F.col("__key").alias(id_col), "size", "text_crc32", "virtual_slot", "shard", F.lit(1).alias("map_version"), (F.col("slot_offset") + F.col("__rank")).alias("position"))
    )
