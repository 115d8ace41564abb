"""Sharding over fixed virtual slots.

A record's key is hashed into one of a fixed number of slots, a few thousand. Bytes are summed per slot, and a versioned
table maps each slot to a shard. Rebalancing edits that table: slots stay where they are while their shard is within its
share, the others move, largest first, to the shard with the fewest bytes. Records never move on their own. Everything
is DataFrame expressions; the only gathered array has one entry per slot, a constant.

Edge cases: a null text has no bytes, its record the fixed overhead only. Records equal in key and text share a slot. An
empty table leaves the first map as it is. A slot is never split, so a single record larger than a share makes its shard
that large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 8192


def virtual_slot(*key: Column | str, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt round."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and records per slot: at most one row per slot and task is shuffled."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def rebalance(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for ``shards`` shards: also for more shards than before, or fewer.

    Two folds over the array of slots, largest first (a constant number of entries). The first keeps a slot in its
    shard while the shard stays within an equal share; the second gives each other slot to the emptiest shard.
    """
    entry = F.struct((-F.coalesce("bytes", F.lit(0))).alias("minus"), F.col("virtual_slot"), F.col("shard"))
    whole = (
        slot_map.join(F.broadcast(weights), "virtual_slot", "left")
        .groupBy((F.col("version") + 1).alias("version"))
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("total"))
    )
    placed = "array<struct<virtual_slot:int,shard:int>>"
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
        F.array().cast(placed).alias("done"),
        F.array().cast("array<struct<minus:bigint,virtual_slot:int,shard:int>>").alias("left"),
    )

    def added(load: Column, shard: Column, amount: Column) -> Column:
        return F.transform(load, lambda x, i: F.when(i == shard, x + amount).otherwise(x))

    def put(acc: Column, x: Column, shard: Column, left: Column) -> Column:
        one = F.struct(x["virtual_slot"].alias("virtual_slot"), shard.cast("int").alias("shard"))
        return F.struct(added(acc["load"], shard, -x["minus"]).alias("load"), F.concat(acc["done"], F.array(one)).alias("done"), left.alias("left"))

    def keep(acc: Column, x: Column) -> Column:
        stays = (x["shard"] < shards) & (F.get(acc["load"], x["shard"]) - x["minus"] <= F.col("share"))
        later = F.struct(acc["load"].alias("load"), acc["done"].alias("done"), F.concat(acc["left"], F.array(x)).alias("left"))
        return F.when(stays, put(acc, x, x["shard"], acc["left"])).otherwise(later)

    def move(acc: Column, x: Column) -> Column:
        emptiest = F.array_position(acc["load"], F.array_min(acc["load"])) - 1
        return put(acc, x, emptiest, acc["left"])

    kept = whole.withColumn("share", F.ceil(F.col("total") / shards)).withColumn("kept", F.aggregate("entries", start, keep))
    moved = kept.select("version", F.aggregate(F.col("kept.left"), F.col("kept"), move)["done"].alias("done"))
    return moved.select("version", F.inline("done")).select("version", "virtual_slot", "shard")


def write_version(slot_map: DataFrame, path: str) -> None:
    """Add a version to a stored map; earlier versions stay readable."""
    slot_map.write.mode("append").parquet(path)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    maps = spark.read.schema("version int, virtual_slot int, shard int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version)


def placed(records: DataFrame, slot_map: DataFrame, weights: DataFrame, order: list[str]) -> DataFrame:
    """Each record's ``shard`` and its ``slot``: its place in the shard, gapless from 0.

    Slots of a shard follow one another; a record's place is the records of the slots before plus its rank in its own
    slot, so that no window is wider than a slot.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slot_map.select("virtual_slot", "shard")
        .join(F.broadcast(weights.select("virtual_slot", "records")), "virtual_slot", "left")
        .select("virtual_slot", "shard", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("_before"))
    )
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order)) - 1
    ranked = records.withColumn("_rank", rank)
    return ranked.join(F.broadcast(offsets), "virtual_slot").withColumn("slot", F.col("_before") + F.col("_rank")).drop("_before", "_rank")
