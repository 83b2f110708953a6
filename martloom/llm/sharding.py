"""Sharding by fixed virtual slots.

A hash of its id and text puts each row into one of `slots` virtual slots, for good. A map says
which shard holds which slot. Balancing sums bytes per slot and edits the map, so that only the
slots it names move; every edit is a further version in the stored map. The map has one row per
slot, whatever the data, and only it passes through the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martloom.llm.tables import text_key
from martloom.shared import fresh_path, written

SLOTS = 4096


def byte_size(text: Column) -> Column:
    """UTF-8 bytes and one for the end of the record; NULL has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def virtual_slot(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(doc_id, text), F.lit(slots)).cast("int")


def first_map(slots: int, shards: int) -> list[int]:
    return [slot % shards for slot in range(slots)]


def rebalanced(owners: Sequence[int], loads: Sequence[int], shards: int) -> list[int]:
    """`owners` edited until no move of a slot from the fullest to the emptiest shard makes the
    two more equal. The slot that comes nearest to halving their difference moves."""
    owners = list(owners)
    total = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, owner in enumerate(owners):
        total[owner] += loads[slot]
        held[owner].add(slot)
    while True:
        full = max(range(shards), key=lambda s: (total[s], s))
        low = min(range(shards), key=lambda s: (total[s], s))
        gap = total[full] - total[low]
        movable = [s for s in held[full] if 0 < loads[s] < gap]
        if not movable:
            return owners
        slot = min(movable, key=lambda s: (abs(gap - 2 * loads[s]), s))
        held[full].remove(slot)
        held[low].add(slot)
        owners[slot] = low
        total[full] -= loads[slot]
        total[low] += loads[slot]


def grown(owners: Sequence[int], loads: Sequence[int], shards: int) -> list[int]:
    """`owners` edited for one shard more, number `shards`: slots move into it only, each time
    from the fullest shard, until it holds its part."""
    owners = list(owners)
    fair, moved = sum(loads) / (shards + 1), 0
    total = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, owner in enumerate(owners):
        total[owner] += loads[slot]
        heapq.heappush(held[owner], (-loads[slot], slot))
    while True:
        full = max(range(shards), key=lambda s: (total[s], s))
        while held[full] and moved - held[full][0][0] > fair:
            heapq.heappop(held[full])  # too large for what is left
        if not held[full] or held[full][0][0] == 0:
            if not any(held[s] and held[s][0][0] for s in range(shards) if s != full):
                return owners
            total[full] = -1
            continue
        load, slot = heapq.heappop(held[full])
        owners[slot] = shards
        total[full] += load
        moved -= load


class SlotMap:
    """The versions of a slot-to-shard map, a folder of (version, slot, shard) in parquet."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "slot-map")

    def store(self, version: int, owners: Sequence[int]) -> None:
        """Each version is a folder of its own; storing it again replaces it."""
        rows = [(slot, shard) for slot, shard in enumerate(owners)]
        self.spark.createDataFrame(rows, "slot int, shard int").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/version={version}")

    def load(self, version: int) -> DataFrame:
        return self.spark.read.schema("slot int, shard int").parquet(
            f"{self.path}/version={version}"
        )

    def owners(self, version: int) -> list[int]:
        return [r.shard for r in self.load(version).orderBy("slot").collect()]


def slot_loads(placed: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot of `placed(virtual_slot, size)`."""
    loads, rows = [0] * slots, [0] * slots
    sums = placed.groupBy("virtual_slot").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    for r in sums.collect():
        loads[r.virtual_slot], rows[r.virtual_slot] = r.s, r.n
    return loads, rows


def balanced_map(
    placed: DataFrame, shards: int, slots: int = SLOTS, store: SlotMap | None = None
) -> tuple[SlotMap, list[int]]:
    """Version 1 deals the slots in turn, version 2 is its edit by the bytes of
    `placed(virtual_slot, size)`. Gives the stored map and the rows per slot."""
    loads, rows = slot_loads(placed, slots)
    store = store or SlotMap(placed.sparkSession)
    store.store(1, first_map(slots, shards))
    store.store(2, rebalanced(store.owners(1), loads, shards))
    return store, rows


def with_shards(docs: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """`docs` with columns size, virtual_slot and shard (which replace columns of those names).

    One row per row. NULL ids and texts have their own hash; rows equal in id and text share a
    slot. An empty table gives no rows. The map that is joined has `slots` rows.
    """
    doc_id, text = F.col("doc_id"), F.col("text")
    placed = docs.drop("size", "virtual_slot", "shard").withColumns(
        {"size": byte_size(text), "virtual_slot": virtual_slot(doc_id, text, slots)}
    )
    store, _ = balanced_map(placed, shards, slots)
    owners = store.load(2).withColumnRenamed("slot", "virtual_slot")
    return placed.join(F.broadcast(owners), "virtual_slot")


def shard_positions(docs: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot), one row per row of
    `docs(doc_id, text)`; slot numbers the rows of a shard from 0 without gaps.

    Rows are numbered within their virtual slot, ordered by id (NULL first) and a hash of the text,
    after the rows of the shard's earlier slots: no task sees a whole shard. Rows that are equal in id
    and text are dealt over all slots, so that a third of the table may be one row repeated; which of
    them goes where is all the same. Equal texts of different ids are different rows.
    """
    text = F.col("text")
    placed = written(
        docs.select(
            "doc_id",
            byte_size(text).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
            virtual_slot(F.col("doc_id"), text, slots).alias("virtual_slot"),
            *text_key("doc_id", "text"),
            F.monotonically_increasing_id().alias("mark"),
        ),
        "unplaced",
    )
    repeated = placed.groupBy("k1", "k2").count().where("count > 1")
    salted = F.pmod(F.xxhash64("k1", "k2", "mark"), F.lit(slots)).cast("int")
    placed = written(
        placed.join(repeated, ["k1", "k2"], "left").withColumn(
            "virtual_slot", F.when(F.col("count") > 1, salted).otherwise(F.col("virtual_slot"))
        ),
        "placed",
    )
    store, rows = balanced_map(placed, shards, slots)
    starts, full = [], [0] * shards
    for slot, owner in enumerate(store.owners(2)):
        starts.append((slot, owner, full[owner]))
        full[owner] += rows[slot]
    places = docs.sparkSession.createDataFrame(
        starts, "virtual_slot int, shard int, first long"
    )
    within = W.partitionBy("virtual_slot").orderBy("doc_id", "k1", "k2", "mark")
    return placed.withColumn("nth", F.row_number().over(within)).join(
        F.broadcast(places), "virtual_slot"
    ).select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"),
    )
