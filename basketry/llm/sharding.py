"""Fixed virtual slots: records hash into thousands of slots, slots map to shards.

A record's slot never changes.  Only the slot-to-shard map does: it is built
from the bytes of each slot, stored as numbered versions, and rebalancing
edits it (few slots move) instead of hashing records anew.

Defined results: a null text has size 16 and checksum 0; records with null or
repeated ids are placed by id and text together; rows equal in both share a
slot; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import cut, row_key

#: Slots are fixed for the life of a data set; a map has one entry each.
SLOTS = 4096


@dataclass
class SlotMap:
    """Slot to shard, with the version it was stored as (at most ``SLOTS`` entries)."""

    shards: int
    shard_of: list[int]
    version: int = 0
    moved: list[int] = field(default_factory=list)

    @classmethod
    def balanced(cls, loads: dict[int, int], shards: int, slots: int = SLOTS) -> "SlotMap":
        """Heaviest slot first, each to the lightest shard so far."""
        heap = [(0, s) for s in range(shards)]
        shard_of = [0] * slots
        for slot in sorted(range(slots), key=lambda s: (-loads.get(s, 0), s)):
            load, shard = heapq.heappop(heap)
            shard_of[slot] = shard
            heapq.heappush(heap, (load + loads.get(slot, 0), shard))
        return cls(shards, shard_of)

    def rebalanced(self, loads: dict[int, int], shards: int | None = None) -> "SlotMap":
        """A next version whose shards are near equal again, moving slots only while it helps.

        Slots go from the heaviest to the lightest shard; with more shards the
        new ones start empty, with fewer the slots of the dropped ones move.
        """
        shards = shards or self.shards
        own: dict[int, set[int]] = {s: set() for s in range(shards)}
        loose, total = [], [0] * shards
        for slot, shard in enumerate(self.shard_of):
            if shard < shards:
                own[shard].add(slot)
                total[shard] += loads.get(slot, 0)
            else:
                loose.append(slot)
        shard_of = list(self.shard_of)
        for slot in sorted(loose, key=lambda s: (-loads.get(s, 0), s)):
            to = min(range(shards), key=lambda s: (total[s], s))
            shard_of[slot] = to
            own[to].add(slot)
            total[to] += loads.get(slot, 0)
        for _ in range(len(shard_of)):
            high = max(range(shards), key=lambda s: (total[s], -s))
            low = min(range(shards), key=lambda s: (total[s], s))
            gap = total[high] - total[low]
            fits = [s for s in own[high] if 0 < loads.get(s, 0) < gap]
            if not fits:
                break
            slot = min(fits, key=lambda s: (abs(loads[s] - gap / 2), s))
            own[high].remove(slot)
            own[low].add(slot)
            total[high] -= loads[slot]
            total[low] += loads[slot]
            shard_of[slot] = low
        moved = [s for s, (a, b) in enumerate(zip(self.shard_of, shard_of)) if a != b]
        return SlotMap(shards, shard_of, self.version + 1, moved)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(s, x, self.shards, self.version) for s, x in enumerate(self.shard_of)],
            "vslot int, shard int, shards int, version int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Store this version beside the earlier ones; a stored version is never rewritten."""
        self.frame(spark).drop("version").coalesce(1).write.parquet(
            f"{path}/version={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> "SlotMap":
        rows = spark.read.parquet(f"{path}/version={version}").orderBy("vslot").collect()
        return cls(rows[0].shards, [r.shard for r in rows], version)


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 16), text_crc32 and the record's virtual slot."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                    F.crc32(text).alias("text_crc32"))
    key = row_key(F.col("doc_id"), F.col("text_crc32"))
    return d.withColumn("vslot", F.pmod(key, F.lit(slots)).cast("int"))


def slot_loads(records: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each slot: one row per slot reaches the driver."""
    rows = records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    return {r.vslot: (r.b, r.n) for r in rows.collect()}


def shard_documents(docs: DataFrame, shards: int = 40, slots: int = SLOTS,
                    slot_map: SlotMap | None = None) -> tuple[DataFrame, SlotMap]:
    """Records with ``shard`` and their ``place`` in it (gapless from 0), and the map used.

    Places are numbered per virtual slot, whose start within the shard comes
    from the slots' row counts, so no shard is ordered in one task.
    """
    spark = docs.sparkSession
    records = cut(slotted(docs, slots), "slotted")
    loads = slot_loads(records)
    slot_map = slot_map or SlotMap.balanced({s: b for s, (b, _) in loads.items()}, shards, slots)
    at, starts = [0] * slot_map.shards, []
    for slot, shard in enumerate(slot_map.shard_of):
        starts.append((slot, shard, at[shard]))
        at[shard] += loads.get(slot, (0, 0))[1]
    table = F.broadcast(  # one row per slot: at most SLOTS
        spark.createDataFrame(starts, "vslot int, shard int, __start long"))
    within = W.partitionBy("vslot").orderBy("doc_id", "text_crc32")
    placed = (records.withColumn("__k", F.row_number().over(within))
              .join(table, "vslot")
              .withColumn("place", F.col("__start") + F.col("__k") - 1)
              .drop("__k", "__start"))
    return placed, slot_map
