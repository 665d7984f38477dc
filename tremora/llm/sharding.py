"""Sharding through fixed virtual slots: records hash into SLOTS slots, and a versioned table maps slots to shards.

Only DataFrame and SQL functions. The map, not the hash, decides a record's shard, so rebalancing edits some of SLOTS
map rows and moves only their records. Shards are balanced by bytes: slots go, largest first, to the shard that has least.

A store is a folder of map versions, each written once. With a store, records are placed by its newest version; rows or
shard counts that it does not fit are met by rebalancing, which adds a version. Without one the map is made for the rows.

Defined cases: a null text has size 8 and the checksum of no bytes; a null id is an id; rows that repeat are placed one
by one; no rows: no rows. The checksum is part of what is hashed, so rows that share an id spread if their texts differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, scratch, workspace

SLOTS = 4096
SHARDS = 24
#: Bytes that each record takes besides its text.
OVERHEAD = 8


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of each document."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, n) of all slots, those without records too: a table of exactly `slots` rows."""
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return every.join(held, "virtual_slot", "left").na.fill(0)


def first_map(held: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: (version, virtual_slot, shard, bytes, n).

    One fold over the slots, largest first, that keeps the shards' loads; its input has a row a slot, whatever the data.
    """
    one = held.agg(F.sort_array(F.collect_list(F.struct("bytes", F.col("virtual_slot").alias("s"), "n")), asc=False).alias("slots"))
    load = f"transform(sequence(1, {shards}), x -> cast(0 as bigint))"
    least = "array_position(a.loads, array_min(a.loads))"
    fold = f"""aggregate(slots, named_struct('loads', {load}, 'out', cast(array() as array<int>)),
      (a, x) -> named_struct('loads', transform(a.loads, (l, i) -> if(i + 1 = {least}, l + x.bytes, l)), 'out', concat(a.out, array(cast({least} - 1 as int)))), a -> a.out)"""
    return one.selectExpr("slots", f"{fold} AS out").selectExpr("inline(arrays_zip(slots, out))").selectExpr("1 AS version", "slots.s AS virtual_slot", "out AS shard", "slots.bytes AS bytes", "slots.n AS n")


def rebalance(old: DataFrame, held: DataFrame, shards: int) -> DataFrame:
    """The next version of a map for new loads and at least as many shards; slots only move out of shards that are too full.

    Of a shard above the new mean, slots leave in hash order while they fit into what it has too much; they go to the
    shards below the mean, along the sums of what these lack.
    """
    cur = old.select("version", "virtual_slot", "shard").join(held, "virtual_slot")
    mean = cur.agg((F.sum("bytes") / shards).alias("mean"))
    loads = cur.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard")).join(cur.groupBy("shard").agg(F.sum("bytes").alias("load")), "shard", "left").na.fill(0)
    loads = loads.join(F.broadcast(mean))  # one row
    by_hash = Window.partitionBy("shard").orderBy(F.xxhash64("virtual_slot", F.lit("move")))
    cur = cur.join(F.broadcast(loads), "shard").withColumn("gone", F.sum("bytes").over(by_hash))  # a row a shard
    leaves = (F.col("bytes") > 0) & (F.col("gone") <= F.col("load") - F.col("mean"))
    moved = cur.where(leaves).withColumn("at", F.sum("bytes").over(Window.orderBy("virtual_slot")) - F.col("bytes") / 2)
    room = loads.where("load < mean").withColumn("to_at", F.sum(F.col("mean") - F.col("load")).over(Window.orderBy("shard"))).select(F.col("shard").alias("to"), "to_at", (F.col("to_at") - (F.col("mean") - F.col("load"))).alias("from_at"))
    moved = moved.join(F.broadcast(room), (F.col("at") >= F.col("from_at")) & (F.col("at") < F.col("to_at")), "left")
    moved = moved.select("virtual_slot", F.coalesce("to", "shard").alias("to"))
    return cur.join(moved, "virtual_slot", "left").select((F.col("version") + 1).alias("version"), "virtual_slot", F.coalesce("to", "shard").alias("shard"), "bytes", "n")


def place(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows of sized() with shard and slot: the record's place in its shard, gapless from 0, by virtual slot and id.

    Places are a record's number in its virtual slot plus the records of the shard's earlier slots: no shard is sorted
    as a whole. The map has a row a slot, and so may be broadcast.
    """
    at = Window.partitionBy("shard").orderBy("virtual_slot")
    starts = slot_map.select("virtual_slot", "shard", (F.sum("n").over(at) - F.col("n")).alias("start"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    rows = rows.withColumn("inside", F.row_number().over(inside) - 1)
    return rows.join(F.broadcast(starts), "virtual_slot").withColumn("slot", (F.col("start") + F.col("inside")).cast("long")).drop("start", "inside")


def newest(spark: SparkSession, store: str) -> DataFrame | None:
    """The newest complete version of the map in a store, null without one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    found = [f.getPath() for f in fs.listStatus(at) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    numbers = [int(p.getName().removeprefix("map-")) for p in found]
    return spark.read.parquet(f"{store}/map-{max(numbers)}") if numbers else None


def store_map(slot_map: DataFrame, store: str) -> DataFrame:
    """Adds a version to a store and returns it as read back; it is an error if another job has added it."""
    path = f"{store}/map-{slot_map.first().version}"
    slot_map.coalesce(1).write.mode("error").parquet(path)
    return slot_map.sparkSession.read.parquet(path)


def current_map(held: DataFrame, shards: int, store: str, slack: float = 1.1) -> DataFrame:
    """The map for loads (virtual_slot, bytes, n): the store's newest version while it has that many shards and none holds
    more than `slack` times the mean and a slot, else the next version, edited by rebalance()."""
    old = newest(held.sparkSession, store)
    if old is None:
        return store_map(first_map(held, shards), store)
    now = old.select("version", "virtual_slot", "shard").join(held, "virtual_slot")
    per = now.groupBy("shard").agg(F.sum("bytes").alias("load"), F.max("bytes").alias("slot"))
    top = per.agg(F.max("load").alias("most"), F.sum("load").alias("all"), F.max("slot").alias("slot")).first()
    grown = old.agg(F.max("shard")).first()[0] + 1 < shards
    if not grown and top.most <= slack * top.all / shards + top.slot:
        return now
    edited = rebalance(old, held, shards)
    return store_map(edited, store)


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, store: str | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version); law `bytes`: sizes near equal."""
    with workspace() as w:
        rows = materialize(sized(docs, slots), "shard-sizes")
        held = materialize(slot_bytes(rows, slots), "slot-bytes")
        slot_map = current_map(held, shards, store or scratch(docs.sparkSession, "slot-maps"))
        placed = place(rows, slot_map).join(F.broadcast(slot_map.select("virtual_slot", F.col("version").alias("map_version"))), "virtual_slot")
        out = placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
        return w.result(out, "shard-places")
