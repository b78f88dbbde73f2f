"""Fixed virtual slots: records hash into thousands of slots, and a versioned map gives each slot a shard.

A map is edited, never drawn anew: a rebalancing moves as few slots as it needs, so only their records move.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattledger.session import exists

from .common import stage

#: Virtual slots. The number never changes over the life of a data set.
SLOTS = 4096
#: Shards may differ by this part of their mean before a rebalancing moves anything more.
TOLERANCE = 1e-4
MAP_SCHEMA = "version int, slot int, shard int"
_RECORD = ("doc_id", "size", "text_crc32")


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: tuple[int, ...]  # by slot

    @property
    def n_shards(self) -> int:
        return max(self.shards) + 1


def initial_map(shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 0: slots dealt round, before anything is known of their sizes."""
    return SlotMap(0, tuple(s % shards for s in range(slots)))


def save_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Append a version to the stored map; earlier versions stay readable."""
    rows = [(slot_map.version, slot, shard) for slot, shard in enumerate(slot_map.shards)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """The version asked for, or else the latest. A map has one row per slot, so it is small at any data size."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = sorted((r.slot, r.shard) for r in stored.where(F.col("version") == version).collect())
    return SlotMap(version, tuple(shard for _, shard in rows))


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """`doc_id`, `size`, `text_crc32` and `virtual_slot` of each record, as a table.

    The whole record is hashed, so that rows without an id spread too. A record that is repeated more often than a
    quarter of a slot's share of the rows is spread by a row number as well, or its slot could not be levelled;
    all others depend on the record alone.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )

    def slot(*more: str) -> Column:
        return F.pmod(F.xxhash64(*_RECORD, *more), F.lit(slots)).cast("int")

    recs = stage(sized.withColumn("virtual_slot", slot()), "slots")
    counts = recs.groupBy(*_RECORD).agg(F.count(F.lit(1)).alias("copies"))
    most = recs.count() / (4 * slots)
    repeated = stage(counts.where((F.col("copies") > most) & (F.col("copies") > 1)).drop("copies"), "repeated")
    if repeated.isEmpty():
        return recs.drop("row")
    # At most four for each slot, by their number of copies.
    listed = F.broadcast(repeated.select(*[F.col(c).alias(f"_{c}") for c in _RECORD], F.lit(True).alias("_listed")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _RECORD]
    spread = F.when(F.col("_listed"), slot("row")).otherwise(F.col("virtual_slot"))
    recs = recs.join(listed, same, "left").withColumn("virtual_slot", spread)
    return stage(recs.select(*_RECORD, "virtual_slot"), "slots")


def slot_loads(recs: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows by slot: one number each for a fixed number of slots, whatever the size of the data."""
    found = recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    size, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in found:
        size[r.virtual_slot], rows[r.virtual_slot] = r.bytes, r.rows
    return size, rows


def rebalance(slot_map: SlotMap, size: np.ndarray, shards: int | None = None) -> SlotMap:
    """The next version: slots move from the fullest to the emptiest shard, by moves and swaps, until they are level.

    Each step takes the move or swap that comes nearest to levelling the two shards; it ends when none helps.
    `shards` may be larger than before (new shards start empty); shards beyond it give all their slots away.
    """
    shards = shards or slot_map.n_shards
    at = np.array(slot_map.shards)
    load = np.bincount(at, weights=size, minlength=max(shards, at.max() + 1))[:shards]
    for slot in sorted(np.flatnonzero(at >= shards), key=lambda s: -size[s]):
        at[slot] = load.argmin()
        load[at[slot]] += size[slot]
    mean = size.sum() / shards
    for _ in range(len(at) * 4):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        if gap <= TOLERANCE * mean:
            break
        mine, theirs = np.flatnonzero(at == high), np.flatnonzero(at == low)
        back = np.append(size[theirs], 0)  # the last stands for a move without a return
        left = gap - 2 * (size[mine][:, None] - back[None, :])
        step = np.abs(left)
        i, j = np.unravel_index(step.argmin(), step.shape)
        if step[i, j] >= gap:
            break
        moved = size[mine[i]] - back[j]
        at[mine[i]] = low
        if j < len(theirs):
            at[theirs[j]] = high
        load[high] -= moved
        load[low] += moved
    return SlotMap(slot_map.version + 1, tuple(at.tolist()))


def assign(recs: DataFrame, slot_map: SlotMap, rows: np.ndarray) -> DataFrame:
    """Add `shard` and `slot`, the place of a record in its shard, gapless from 0.

    A shard lays its virtual slots one after another, so a place is the record's number in its virtual slot plus
    the rows of the slots before it: no task holds more than one of thousands of slots.
    """
    base, filled = [0] * len(rows), [0] * slot_map.n_shards
    for slot, shard in enumerate(slot_map.shards):
        base[slot] = filled[shard]
        filled[shard] += int(rows[slot])
    places = recs.sparkSession.createDataFrame(
        [(slot, shard, base[slot]) for slot, shard in enumerate(slot_map.shards)],
        "virtual_slot int, shard int, base long",
    )
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (
        recs.withColumn("number", F.row_number().over(order))
        .join(F.broadcast(places), "virtual_slot")  # one row per virtual slot: a fixed number
        .withColumn("slot", F.col("base") + F.col("number") - 1)
        .drop("base", "number")
    )


def shard_documents(docs: DataFrame, shards: int = 16, map_path: str | None = None) -> DataFrame:
    """Every record with its shard, under the law `bytes`: the sizes of shards are near equal.

    Size is the UTF-8 bytes of the text plus 1. A null text counts as empty, with the CRC of no bytes; null ids,
    repeated rows and empty tables are fine; other columns are not looked at. The first run stores version 0 of the
    map and the rebalanced version 1; a run over a stored map edits its latest version.
    """
    spark = docs.sparkSession
    recs = records(docs)
    size, rows = slot_loads(recs)
    stored = map_path is not None and exists(spark, map_path)
    before = load_map(spark, map_path) if stored else initial_map(shards)
    after = rebalance(before, size, shards)
    if map_path is not None:
        for version in (after,) if stored else (before, after):
            save_map(spark, version, map_path)
    return assign(recs, after, rows).withColumn("map_version", F.lit(after.version))
