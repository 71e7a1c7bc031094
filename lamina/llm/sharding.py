"""Shards by fixed virtual slots.

A record's key is hashed into one of a fixed number of virtual slots.  A small table,
the slot map, says which shard holds which slot.  Rebalancing aggregates bytes per slot
and edits the map: it moves whole slots from heavy to light shards, under a new version;
records never change their slot.  The map has one row per slot, so its size is fixed by
a parameter, whatever the data.

Rows with a null key are placed by the checksum and size of their text.  Repeated rows
share a slot and get places one after the other; ties are interchangeable rows.  A null
text counts as empty, an empty table gives no rows, and other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import store, text_bytes
from lamina.sources.shared import shared_path

SLOTS = 8192
# Added to each text's bytes: what a record costs beside its text.
OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    """Slot ``i`` is held by shard ``shard_of[i]``."""

    shard_of: tuple[int, ...]
    shards: int
    version: int = 0
    moved: tuple[int, ...] = field(default=(), compare=False)

    @staticmethod
    def dealt(shards: int, slots: int = SLOTS) -> SlotMap:
        return SlotMap(tuple(i % shards for i in range(slots)), shards)

    def rebalanced(self, weights: dict[int, int], rounds: int = 100_000) -> SlotMap:
        """A new version with loads near equal; only the slots that it lists have moved.

        Each round looks at the heaviest and the lightest shard, and makes the move of a
        slot, or else the exchange of two, that comes closest to halving their difference.
        """
        held: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        for slot, shard in enumerate(self.shard_of):
            insort(held[shard], (weights.get(slot, 0), slot))
        load = [sum(w for w, _ in h) for h in held]
        for _ in range(rounds):
            high = max(range(self.shards), key=lambda s: (load[s], -s))
            low = min(range(self.shards), key=lambda s: (load[s], s))
            gap = load[high] - load[low]
            best = self._best(held[high], held[low], gap)
            if best is None:
                break
            out, back = best
            held[high].remove(out)
            insort(held[low], out)
            load[high] -= out[0]
            load[low] += out[0]
            if back is not None:
                held[low].remove(back)
                insort(held[high], back)
                load[low] -= back[0]
                load[high] += back[0]
        return self._edited({slot: shard for shard, h in enumerate(held) for _, slot in h}, self.shards)

    @staticmethod
    def _best(high, low, gap):
        """The (slot out, slot back or None) whose net weight is nearest to half the gap and below it all."""
        best, least = None, gap
        for back in [None, *low]:
            base = back[0] if back else 0
            at = bisect_left(high, (base + gap / 2, -1))
            for out in high[max(0, at - 1) : at + 1]:
                net = out[0] - base
                if 0 < net < gap and abs(gap - 2 * net) < least:
                    best, least = (out, back), abs(gap - 2 * net)
            if back is None and best is not None and least <= gap / 2:
                return best
        return best

    def grown(self, weights: dict[int, int] | None = None) -> SlotMap:
        """One more shard: it takes a fair share of every old shard's slots, nothing else moves."""
        new, weights = self.shards, weights or {}
        total = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            total[shard] += weights.get(slot, 1)
        taken, moves = [0] * self.shards, {}
        for slot, shard in enumerate(self.shard_of):
            w = weights.get(slot, 1)
            if taken[shard] + w <= total[shard] / (self.shards + 1):
                taken[shard] += w
                moves[slot] = new
        return self._edited(dict(enumerate(self.shard_of)) | moves, self.shards + 1)

    def _edited(self, now: dict[int, int], shards: int) -> SlotMap:
        shard_of = tuple(now[i] for i in range(len(self.shard_of)))
        moved = tuple(i for i, (a, b) in enumerate(zip(self.shard_of, shard_of)) if a != b)
        return SlotMap(shard_of, shards, self.version + 1, moved)

    def table(self, spark: SparkSession) -> DataFrame:
        listed = F.split(F.lit(",".join(map(str, self.shard_of))), ",")
        return spark.range(1).select(F.posexplode(listed).alias("virtual_slot", "shard")).select(
            "virtual_slot", F.col("shard").cast("int").alias("shard"), F.lit(self.version).alias("version")
        )

    def save(self, spark: SparkSession, folder: str) -> DataFrame:
        """Adds this version to the stored map; older versions stay readable."""
        path = f"{folder}/version={self.version}"
        self.table(spark).drop("version").write.mode("overwrite").parquet(path)
        return spark.read.parquet(path).withColumn("version", F.lit(self.version))

    @staticmethod
    def load(spark: SparkSession, folder: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{folder}/version={version}").orderBy("virtual_slot").collect()
        shard_of = tuple(r["shard"] for r in rows)
        return SlotMap(shard_of, max(shard_of) + 1, version)


def virtual_slot(key: Column, content: list[Column], slots: int) -> Column:
    return F.pmod(F.when(key.isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(*content)), F.lit(slots)).cast("int")


def place(docs: DataFrame, slots: int = SLOTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum and virtual slot of each record; texts are read once."""
    data = text_bytes(text)
    narrow = docs.select(
        F.col(key), (F.length(data) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    return narrow.withColumn("virtual_slot", virtual_slot(F.col(key), [F.col("size"), F.col("text_crc32")], slots))


def slot_loads(placed: DataFrame) -> DataFrame:
    """Bytes and rows of each slot: at most one row per slot."""
    return placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def assign(placed: DataFrame, slot_table: DataFrame, loads: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds ``shard`` and ``slot``, the record's place in it, gapless from 0.

    A slot's first place is the number of rows in the shard's earlier slots; inside a slot,
    rows are numbered by key.  So no window spans a whole shard's rows.
    """
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    starts = slot_table.join(loads, "virtual_slot").select(
        "virtual_slot", "shard", "version", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_place")
    )
    inside = W.partitionBy("virtual_slot").orderBy(key, "size", "text_crc32")
    return (
        placed.withColumn("in_slot", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual_slot")  # a row per virtual slot at most
        .withColumn("slot", F.col("first_place") + F.col("in_slot") - 1)
        .drop("first_place", "in_slot")
    )


def shard_by_bytes(
    docs: DataFrame, shards: int, slots: int = SLOTS, key: str = "doc_id", text: str = "text", folder: str | None = None
) -> DataFrame:
    """All records with their shard; shards hold nearly equal bytes.

    The dealt map is version 0; version 1 is its edit after the bytes per slot are known.
    Both are kept in ``folder`` (a fresh shared one unless given).
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "slot-map")
    placed = store(place(docs, slots, key, text), "placed")
    loads = store(slot_loads(placed), "slot-loads")
    weights = {r["virtual_slot"]: r["bytes"] for r in loads.select("virtual_slot", "bytes").collect()}  # fixed number of slots
    first = SlotMap.dealt(shards, slots)
    first.save(spark, folder)
    return assign(placed, first.rebalanced(weights).save(spark, folder), loads, key)
