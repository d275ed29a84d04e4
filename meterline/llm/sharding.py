"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots (thousands, far more
than shards). Bytes and rows are aggregated per slot, and a *versioned* map
says which shard owns each slot. Rebalancing edits the map: it moves as few
slots as it needs and never re-hashes a record.

Sizes: the slot statistics and the map have ``n_slots`` rows whatever the
input, so they may reach the driver and be broadcast. Row positions are
numbered inside a slot (one window task per group of slots) and shifted by
the slot's base inside its shard, so no task ever holds a shard.

A record is hashed by its id and text together, so rows that share an id lie
in many slots. Where one record is repeated so often that its slot holds more
than ``HOT_SHARE`` of a shard besides its largest record, the slot is split
into as many further slots as it takes, and its rows are dealt to them row by
row. Each such slot holds at least that share of all bytes, so there are few,
whatever the input.

Cases: a NULL text counts as empty (size 1, checksum 0); a NULL id hashes by
its text; repeated rows share a slot, unless it is hot; a very long text is one
record, and a shard can't be smaller than it; ties in a slot are ordered by
(id, size, checksum); an empty table gives no rows; columns beyond the id and
the text are ignored whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.common import table, text_or_empty

N_SLOTS = 4096
HOT_SHARE, PART_SHARE = 1 / 4, 1 / 16  # of a shard's mean bytes
MAP_SCHEMA = "version int, slot int, shard int"


def digest(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every record: no text travels on."""
    text = text_or_empty(text_col)
    key = F.xxhash64(F.col(id_col), text)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot"),
    )


def slot_stats(rows: DataFrame) -> DataFrame:
    """Bytes and rows per slot; partial aggregation leaves at most n_slots rows a task."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                                             F.max("size").alias("largest"))


def split_slots(slot_bytes: np.ndarray, slot_rows: np.ndarray, largest: np.ndarray, n_shards: int) -> list[tuple[int, int, int]]:
    """(slot, first further slot, how many) of each hot slot; at most n_shards / HOT_SHARE of them."""
    part = max(1.0, slot_bytes.sum() * PART_SHARE / n_shards)
    out, at = [], len(slot_bytes)
    for slot in np.flatnonzero(slot_bytes - largest > slot_bytes.sum() * HOT_SHARE / n_shards):
        parts = int(min(np.ceil(slot_bytes[slot] / part), slot_rows[slot]))
        out.append((int(slot), at, parts))
        at += parts
    return out


def dealt(rows: DataFrame, hot: list[tuple[int, int, int]]) -> DataFrame:
    """Rows of hot slots dealt to their further slots, by their place in the written table."""
    if not hot:
        return rows
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts"))
    few = rows.sparkSession.createDataFrame(hot, "virtual_slot int, first int, parts int")
    return (rows.join(F.broadcast(few), "virtual_slot", "left")
            .withColumn("virtual_slot", F.coalesce((F.col("first") + place).cast("int"), F.col("virtual_slot")))
            .drop("first", "parts"))


def initial_map(n_slots: int, n_shards: int) -> np.ndarray:
    """Version 1: slots dealt round robin; entry s is the shard of slot s."""
    return np.arange(n_slots) % n_shards


def rebalance(owner: np.ndarray, slot_bytes: np.ndarray, n_shards: int) -> np.ndarray:
    """Edit a slot map so that bytes per shard are near equal.

    Slots leave shards that hold more than the mean, largest first while the
    shard stays at or above it, and go to the lightest shard. Then the
    heaviest and the lightest shard trade slots until no single move or swap
    narrows the gap. Slots that need not move keep their shard.
    """
    owner = np.array(owner)
    load = np.bincount(owner, weights=slot_bytes, minlength=n_shards)
    mean = slot_bytes.sum() / n_shards
    loose = []
    for shard in np.flatnonzero(load > mean):
        own = np.flatnonzero(owner == shard)
        for slot in own[np.argsort(-slot_bytes[own], kind="stable")]:
            if slot_bytes[slot] and load[shard] - slot_bytes[slot] >= mean:
                load[shard] -= slot_bytes[slot]
                loose.append(slot)
    light = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(light)
    for slot in sorted(loose, key=lambda s: (-slot_bytes[s], s)):
        b, shard = heapq.heappop(light)
        owner[slot] = shard
        heapq.heappush(light, (b + slot_bytes[slot], shard))
    load = np.bincount(owner, weights=slot_bytes, minlength=n_shards)
    for _ in range(len(owner)):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = load[hi] - load[lo]
        a = np.flatnonzero((owner == hi) & (slot_bytes > 0))
        b = np.flatnonzero(owner == lo)
        give = slot_bytes[a][:, None] - np.concatenate(([0], slot_bytes[b]))[None, :]
        if not give.size:
            break
        best = np.unravel_index(np.abs(gap - 2 * give).argmin(), give.shape)
        if abs(gap - 2 * give[best]) >= gap:
            break
        owner[a[best[0]]] = lo
        if best[1]:
            owner[b[best[1] - 1]] = hi
        load[hi] -= give[best]
        load[lo] += give[best]
    return owner


def store_map(spark: SparkSession, path: str, version: int, owner: np.ndarray) -> None:
    """Add one version of the slot map to the table at ``path``; older versions stay."""
    rows = [(version, slot, int(shard)) for slot, shard in enumerate(owner)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the slot map (the latest unless named)."""
    versions = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == version)


def assign(rows: DataFrame, stats: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard and gapless position inside it for every row of ``digest``.

    ``stats`` and ``slot_map`` have one row per slot, so both are broadcast.
    """
    base = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    places = (slot_map.withColumnRenamed("slot", "virtual_slot")
              .join(stats, "virtual_slot")
              .select("virtual_slot", "shard", F.col("version").alias("map_version"),
                      F.coalesce(F.sum("rows").over(base), F.lit(0)).alias("base")))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (rows.withColumn("inside", F.row_number().over(inside) - 1)
            .join(F.broadcast(places), "virtual_slot")
            .withColumn("position", (F.col("base") + F.col("inside")).cast("long"))
            .drop("base", "inside"))


def shard(docs: DataFrame, map_path: str, n_shards: int = 16, n_slots: int = N_SLOTS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put all records into shards of near-equal bytes through the stored slot map."""
    spark = docs.sparkSession
    rows = table(digest(docs, n_slots, id_col, text_col), "shard-digest")
    stats = table(slot_stats(rows), "shard-slots")
    counted = {r["virtual_slot"]: r for r in stats.collect()}  # n_slots rows at most
    held = lambda c, n: np.array([counted[k][c] if k in counted else 0 for k in range(n)], np.int64)
    hot = split_slots(held("bytes", n_slots), held("rows", n_slots), held("largest", n_slots), n_shards)
    if hot:
        rows = table(dealt(rows, hot), "shard-dealt")
        stats = table(slot_stats(rows), "shard-slots")
        counted = {r["virtual_slot"]: r for r in stats.collect()}
        n_slots = hot[-1][1] + hot[-1][2]
    first = initial_map(n_slots, n_shards)
    store_map(spark, map_path, 1, first)
    store_map(spark, map_path, 2, rebalance(first, held("bytes", n_slots), n_shards))
    return assign(rows, stats, load_map(spark, map_path))
