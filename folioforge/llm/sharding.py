"""Sharding over fixed virtual slots; native DataFrame operations only.

Records are hashed into a fixed number of slots that never changes. The bytes of each slot are added up, and a versioned
map says which shard holds which slot. Only the map is edited when shards become uneven or are added: the slots that
move are few and no record is hashed anew. What reaches the driver is one row for each slot, a few thousand whatever the
number of records.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import own, table

SLOTS = 8192
SHARDS = 40
#: Bytes that a record has besides its text.
OVERHEAD = 16


@dataclass(frozen=True)
class SlotMap:
    """shard_of[s] is the shard of slot s. A change of it is a new version."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """(version, shards, vslot, shard): the form in which the map is stored, one file set for each version."""
        return spark.createDataFrame([(self.version, self.shards, v, s) for v, s in enumerate(self.shard_of)], "version int, shards int, vslot int, shard int")

    @staticmethod
    def from_frame(stored: DataFrame, version: int | None = None) -> SlotMap:
        """The given version of a stored map, or the latest."""
        version = stored.agg(F.max("version")).first()[0] if version is None else version
        rows = stored.where(F.col("version") == version).orderBy("vslot").collect()
        return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))

    def loads(self, sizes: list[int]) -> list[int]:
        out = [0] * self.shards
        for v, s in enumerate(self.shard_of):
            out[s] += sizes[v]
        return out


def first_map(sizes: list[int], shards: int) -> SlotMap:
    """Version 1: heaviest slot first, each to the shard with the fewest bytes and then the fewest slots."""
    free = [(0, 0, s) for s in range(shards)]
    shard_of = [0] * len(sizes)
    for v in sorted(range(len(sizes)), key=lambda v: (-sizes[v], v)):
        load, held, s = heapq.heappop(free)
        shard_of[v] = s
        heapq.heappush(free, (load + sizes[v], held + 1, s))
    return SlotMap(1, shards, tuple(shard_of))


def rebalanced(old: SlotMap, sizes: list[int], tolerance: float = 0.02) -> SlotMap:
    """The next version: slots move from the fullest shard to the emptiest until both are within tolerance of the mean.

    A move takes the heaviest slot that still leaves the receiver at or under the giver; without such a slot the edit ends.
    The same map comes back if nothing has to move.
    """
    loads, mean, shard_of = old.loads(sizes), sum(sizes) / max(1, old.shards), list(old.shard_of)
    held: list[list[int]] = [[] for _ in range(old.shards)]
    for v in sorted(range(len(sizes)), key=lambda v: sizes[v]):
        held[shard_of[v]].append(v)
    moved = False
    while True:
        giver, receiver = max(range(old.shards), key=loads.__getitem__), min(range(old.shards), key=loads.__getitem__)
        gap = loads[giver] - loads[receiver]
        fits = [v for v in held[giver] if 0 < sizes[v] and 2 * sizes[v] <= gap]
        if not fits or max(loads[giver] - mean, mean - loads[receiver]) <= tolerance * mean:
            break
        v = fits[-1]
        held[giver].remove(v)
        held[receiver] = sorted([*held[receiver], v], key=sizes.__getitem__)
        shard_of[v], moved = receiver, True
        loads[giver] -= sizes[v]
        loads[receiver] += sizes[v]
    return SlotMap(old.version + 1, old.shards, tuple(shard_of)) if moved else old


def grown(old: SlotMap, sizes: list[int]) -> SlotMap:
    """The next version with one more shard, which takes slots from the fullest others and is the only one to take any."""
    wider = SlotMap(old.version + 1, old.shards + 1, old.shard_of)
    loads, goal, shard_of = wider.loads(sizes), sum(sizes) / wider.shards, list(old.shard_of)
    givers = [(-load, s) for s, load in enumerate(loads[:-1])]
    heapq.heapify(givers)
    held = {s: [v for v in sorted(range(len(sizes)), key=lambda v: sizes[v]) if shard_of[v] == s] for s in range(old.shards)}
    taken = 0
    while taken < goal and givers:
        load, s = heapq.heappop(givers)
        fits = [v for v in held[s] if 0 < sizes[v] <= goal - taken]
        if not fits:
            continue
        v = fits[len(fits) // 2]
        held[s].remove(v)
        shard_of[v], taken = old.shards, taken + sizes[v]
        heapq.heappush(givers, (load + sizes[v], s))
    return SlotMap(wider.version, wider.shards, tuple(shard_of))


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """Id and text together: many rows of one id or many copies of one text spread over the slots."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots)).cast("int")


def slot_sizes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> list[int]:
    """Bytes of every slot, by partial sums in the tasks and one row for each slot at the driver."""
    sums = documents.select(virtual_slot(F.col(doc_id), F.col(text), slots).alias("vslot"), record_size(F.col(text)).alias("size")).groupBy("vslot").agg(F.sum("size").alias("size"))
    out = [0] * slots
    for r in sums.collect():
        out[r["vslot"]] = r["size"]
    return out


def assign(documents: DataFrame, slot_map: SlotMap, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, vslot, shard, slot) for every record under a map.

    slot: the record's place in its shard, gapless from 0: the shard's slots one after the other, and inside a slot by id
    and checksum. Places are counted inside the slots, thousands of groups, and the slots' offsets are added from the slot
    counts, one row for each slot. A null text has size 16 and checksum 0; null ids come first in a slot; repeated rows
    get places of their own; an empty table gives no rows; other columns are not returned.
    """
    from pyspark.sql import Window

    slots = len(slot_map.shard_of)
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        record_size(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(doc_id), F.col(text), slots).alias("vslot"),
    )
    spark = documents.sparkSession
    counts = rows.groupBy("vslot").agg(F.count("*").alias("n"))
    where = slot_map.to_frame(spark).select("vslot", "shard").join(counts, "vslot", "left")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    where = where.select("vslot", "shard", F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(before), F.lit(0)).alias(own("offset")))
    place = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn(own("place"), place.cast("long"))
    joined = placed.join(F.broadcast(where), "vslot")  # a row for each slot: its size is bounded by the map
    return joined.select("doc_id", "size", "text_crc32", "vslot", "shard", (F.col(own("offset")) + F.col(own("place")) - 1).alias("slot"))


def shard(documents: DataFrame, shards: int = SHARDS, slots: int = SLOTS, doc_id: str = "doc_id", text: str = "text", stored: SlotMap | None = None) -> tuple[DataFrame, SlotMap]:
    """The records' places and the map that they follow: a new one, or the stored one edited for today's sizes."""
    sizes = slot_sizes(documents, doc_id, text, slots)
    slot_map = first_map(sizes, shards) if stored is None else rebalanced(stored, sizes)
    return assign(documents, slot_map, doc_id, text), slot_map


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op6_sharding: all of `documents` into shards of near equal bytes."""
    rows, _ = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")
