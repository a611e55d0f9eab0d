"""Sharding through fixed virtual slots and a stored, versioned slot map.

Every record is hashed into one of ``SLOTS`` virtual slots; the number of slots
never changes. Bytes are summed by slot, and a map sends slots to shards: the
first version deals the slots, largest first, to the shard with the fewest
bytes; later versions are edits of the one before (``rebalance`` moves slots
only, and only as many as the new shard needs). Maps are small tables of at
most ``SLOTS`` rows, written below one folder as ``version=N``.

Records with equal text share a slot, so copies stay in one shard. A group of
copies that is too heavy for that (more than half of a shard's fair share of
bytes or rows) is spread over all slots by row instead, so a group with a third
of all rows neither fills a shard nor a task.

Law: ``bytes``. Shards differ by about the size of a slot at most, unless a
single record is larger than that.

Defined results: a null text has no bytes (size 1, crc32 0); a null id is a
value like any other; repeated rows are placed one by one; an empty table gives
an empty result and an empty map; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlake.session import materialize, shared_path

SLOTS = 4096
#: Sub-groups of a slot, each numbered by itself; bounds the rows of one window.
PARTS = 16
#: A group of copies heavier than this part of a shard's fair share is spread.
SPREAD_SHARE = 0.5


def records(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, size, text_crc32, key, row): size in UTF-8 bytes plus 1, a hash of
    the text and a hash that tells rows apart. Stored once; texts stay behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("key"),
        F.xxhash64(F.col(id_col), F.monotonically_increasing_id()).alias("row"),
    )
    return materialize(out, "shard_records")


def heavy_keys(recs: DataFrame, shards: int, slots: int = SLOTS) -> list[int]:
    """Keys of the groups that weigh more than ``SPREAD_SHARE`` of a fair share,
    in bytes or in rows. There are at most 4 x shards of them.

    Only slots that weigh as much are searched, found by one aggregation to
    ``slots`` rows."""
    slot = F.pmod("key", F.lit(slots)).alias("slot")
    totals = recs.groupBy(slot).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).cache()
    both = totals.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    if not both["n"]:
        return []
    heavy = (F.col("bytes") > both["bytes"] * SPREAD_SHARE / shards) | (F.col("n") > both["n"] * SPREAD_SHARE / shards)
    at = [r["slot"] for r in totals.where(heavy).select("slot").collect()]
    totals.unpersist()
    if not at:
        return []
    found = recs.where(slot.isin(at)).groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return [r["key"] for r in found.where(heavy & (F.col("n") > 1)).select("key").collect()]


def with_slot(recs: DataFrame, spread: list[int], slots: int = SLOTS) -> DataFrame:
    """Adds virtual_slot and part (the sub-group of the slot)."""
    key = F.when(F.col("key").isin(spread), F.col("row")).otherwise(F.col("key")) if spread else F.col("key")
    part = F.pmod(F.shiftright("row", 20), F.lit(PARTS))
    return recs.withColumn("virtual_slot", F.pmod(key, F.lit(slots)).cast("int")).withColumn("part", part.cast("int"))


def slot_totals(slotted: DataFrame) -> DataFrame:
    """Bytes and rows by (virtual_slot, part); at most SLOTS x PARTS rows."""
    out = slotted.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return materialize(out, "shard_totals")


def _add(loads: Column, at: Column, amount: Column) -> Column:
    return F.transform(loads, lambda x, i: F.when(i == at, x + amount).otherwise(x))


def _slots_by_weight(totals: DataFrame, *more: Column) -> DataFrame:
    """One row: the (at most SLOTS) slots as an array, largest first."""
    by_slot = totals.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes"))
    item = F.struct((-F.col("bytes")).alias("less"), "virtual_slot", *more)
    return by_slot, item


def first_map(totals: DataFrame, shards: int) -> DataFrame:
    """(virtual_slot, shard): slots, largest first, each to the shard with the fewest bytes so far."""
    by_slot, item = _slots_by_weight(totals)
    zero = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("dealt"),
    )

    def deal(state: Column, x: Column) -> Column:
        at = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        return F.struct(
            _add(state["loads"], at, -x["less"]).alias("loads"),
            F.concat(state["dealt"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), at.alias("shard")))).alias("dealt"),
        )

    packed = by_slot.agg(F.sort_array(F.collect_list(item)).alias("slots"))
    dealt = packed.select(F.aggregate("slots", zero, deal, lambda s: s["dealt"]).alias("dealt"))
    return dealt.select(F.inline("dealt"))


def rebalance(slot_map: DataFrame, totals: DataFrame, shards: int) -> DataFrame:
    """The map edited for one more shard (number ``shards``): slots, largest
    first, move into it while it stays within its fair share and the shard that
    gives keeps its own. No other slot moves."""
    by_slot, _ = _slots_by_weight(totals)
    item = F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard")
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards)),
        lambda i: F.aggregate("slots", F.lit(0).cast("long"), lambda a, x: a + F.when(x["shard"] == i, -x["less"]).otherwise(F.lit(0))),
    )
    packed = by_slot.join(F.broadcast(slot_map), "virtual_slot").agg(F.sort_array(F.collect_list(item)).alias("slots"))
    packed = packed.select("slots", loads.alias("loads"))
    packed = packed.select("slots", "loads", (F.aggregate("loads", F.lit(0).cast("long"), lambda a, x: a + x) / (shards + 1)).alias("fair"))
    zero = F.struct(F.col("loads").alias("loads"), F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("dealt"))

    def move(state: Column, x: Column) -> Column:
        has, new = F.get(state["loads"], x["shard"]), F.get(state["loads"], F.lit(shards))
        to = F.when((has + x["less"] >= F.col("fair")) & (new - x["less"] <= F.col("fair")), F.lit(shards)).otherwise(x["shard"])
        return F.struct(
            _add(_add(state["loads"], x["shard"], x["less"]), to, -x["less"]).alias("loads"),
            F.concat(state["dealt"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), to.cast("int").alias("shard")))).alias("dealt"),
        )

    return packed.select(F.inline(F.aggregate("slots", zero, move, lambda s: s["dealt"])))


def store_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Writes a version of the map (an existing version is never changed) and reads it back."""
    path = f"{folder}/version={version}"
    slot_map.coalesce(1).write.mode("error").parquet(path)
    return slot_map.sparkSession.read.schema("virtual_slot int, shard int").parquet(path)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the newest by default."""
    maps = spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == (-1 if version is None else version)).drop("version")


def place(slotted: DataFrame, totals: DataFrame, slot_map: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds shard and slot, the record's place in its shard (gapless from 0).

    Rows are numbered within (virtual_slot, part) only; where such a sub-group
    starts in its shard comes from the totals, so no task sorts a whole shard."""
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.join(F.broadcast(slot_map), "virtual_slot").select(
        "virtual_slot", "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("virtual_slot", "part").orderBy(id_col, "row")
    numbered = slotted.withColumn("place", F.row_number().over(within) - 1)
    # at most SLOTS x PARTS rows of four numbers
    joined = numbered.join(F.broadcast(starts), ["virtual_slot", "part"])
    return joined.withColumn("slot", (F.col("start") + F.col("place")).cast("long")).drop("start", "place")


def shard(docs: DataFrame, shards: int, folder: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """Places every record; the map goes to ``folder`` as version 0, its edit
    for one more shard as version 1 (column ``next_shard``)."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "shard_map")
    recs = records(docs, id_col)
    slotted = with_slot(recs, heavy_keys(recs, shards))
    totals = slot_totals(slotted)
    now = store_map(first_map(totals, shards), folder, 0)
    later = store_map(rebalance(now, totals, shards), folder, 1)
    placed = place(slotted, totals, now, id_col)
    return placed.join(F.broadcast(later.withColumnRenamed("shard", "next_shard")), "virtual_slot")
