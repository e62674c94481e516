"""Fixed virtual slots: records hash into slots, slots map to shards.

A record's slot never changes. Shards own slots through a small table with versions,
(version, slot, shard); rebalancing writes a new version that moves as few slots as the
bytes ask for. All of it is joins, aggregates and one fold over the slots, whose number is
a parameter (thousands), however many records there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from batchlake.llm.base import landed, text_bytes
from batchlake.session import work_path

SLOTS = 4096


def slot_of(key: Column, crc: Column, slots: int = SLOTS) -> Column:
    """Slot of a record: by its key; records without one go by their text."""
    return F.pmod(F.coalesce(F.xxhash64(key.cast("string"), F.when(key.isNull(), crc))), F.lit(slots)).cast("int")


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32 and vslot of every row of ``docs``.

    Other columns are left out, whatever their names. A null text has no bytes; a null
    doc_id is a key like any other, spread over the slots by its text.
    """
    data = text_bytes()
    crc = F.crc32(data)
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        crc.alias("text_crc32"),
        slot_of(F.col("doc_id"), crc, slots).alias("vslot"),
    )


def slot_totals(sized: DataFrame) -> DataFrame:
    """Bytes and rows of each slot in use; at most one row for each slot and task is shuffled."""
    return sized.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt round, whatever they hold."""
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def rebalanced(current: DataFrame, totals: DataFrame, shards: int, version: int) -> DataFrame:
    """The next version of a map: equal bytes for ``shards`` shards, with few moves.

    A shard keeps its largest slots as long as they fit into the mean; the rest, largest
    first, each go to the shard that holds least (the smallest number on a tie). Slots of
    shards that no longer exist move too. The fold runs over slots, not over records.
    """
    known = current.join(totals, "vslot", "left").select(
        "vslot", "shard", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes")
    )
    mean = known.agg((F.sum("bytes") / shards).alias("mean"))
    largest = W.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    marked = (
        known.crossJoin(F.broadcast(mean))  # one row
        .withColumn("held", F.sum("bytes").over(largest))
        .withColumn("stays", (F.col("held") <= F.col("mean")) & (F.col("shard") < shards))
    )
    kept = marked.filter("stays").select("vslot", "shard")
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: F.aggregate("slots", F.lit(0).cast("long"), lambda a, x: a + F.when(x.stays & (x.shard == s), x.bytes).otherwise(F.lit(0).cast("long"))),
    )
    moving = F.array_sort(
        F.filter("slots", lambda x: ~x.stays),
        lambda a, b: F.when(a.bytes > b.bytes, -1).when(a.bytes < b.bytes, 1).when(a.vslot < b.vslot, -1).otherwise(1),
    )
    gathered = marked.agg(F.collect_list(F.struct("vslot", "shard", "bytes", "stays")).alias("slots"))

    def place(state: Column, x: Column) -> Column:
        least = (F.array_position(state.loads, F.array_min(state.loads)) - 1).cast("int")
        return F.struct(
            F.transform(state.loads, lambda v, i: F.when(i == least, v + x.bytes).otherwise(v)).alias("loads"),
            F.concat(state.moved, F.array(F.struct(x.vslot.alias("vslot"), least.alias("shard")))).alias("moved"),
        )

    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<vslot:int,shard:int>>").alias("moved"))
    moved = gathered.select(F.inline(F.aggregate(moving, start, place, lambda s: s.moved)))
    return kept.unionByName(moved).select(F.lit(version).alias("version"), "vslot", "shard")


class SlotMap:
    """Versions of a slot-to-shard map, stored as one Parquet folder in the shared folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "slot-map")

    def store(self, rows: DataFrame) -> DataFrame:
        version = rows.schema["version"].dataType.simpleString()
        assert version == "int"
        rows.coalesce(1).write.mode("append").parquet(self.path)
        return self.latest()

    def versions(self) -> DataFrame:
        return self.spark.read.schema("version int, vslot int, shard int").parquet(self.path)

    def latest(self) -> DataFrame:
        rows = self.versions()
        newest = rows.agg(F.max("version").alias("newest"))
        return rows.join(F.broadcast(newest), rows.version == newest.newest).drop("newest")


def assign(sized: DataFrame, slot_map: DataFrame, totals: DataFrame) -> DataFrame:
    """Shard and place in the shard of every record; places count from 0 without gaps.

    Records are numbered within their virtual slot, slots within their shard, so the
    largest sort is one slot of thousands, not a shard. Both maps have one row for each
    slot and are broadcast: their size is the fixed number of slots.
    """
    before = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        slot_map.select("vslot", "shard")
        .join(F.broadcast(totals), "vslot")
        .select("vslot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        sized.withColumn("place", F.row_number().over(within) - 1)
        .join(F.broadcast(placed), "vslot")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"), "vslot")
    )


def shard_by_bytes(docs: DataFrame, shards: int = 8, slots: int = SLOTS, slot_map: SlotMap | None = None) -> DataFrame:
    """All documents in ``shards`` shards of nearly equal bytes.

    Writes version 0 of the map, then the version edited for the bytes counted, and
    assigns by the latest one. Empty input gives no rows. Rows repeated whole get
    places of their own; a text larger than a shard's share keeps a slot to itself.
    """
    spark = docs.sparkSession
    sized = measured(docs, slots)
    store = slot_map or SlotMap(spark)
    totals = landed(slot_totals(sized), "slot-totals")
    store.store(first_map(spark, shards, slots))
    latest = store.store(rebalanced(store.latest(), totals, shards, 1))
    return assign(sized, latest, totals)
