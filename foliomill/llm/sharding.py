"""Rendezvous hashing of stable record keys over weighted shards.

A record goes to the shard with the least ``-ln(u) / weight``, where u in (0, 1)
is a hash of the key and the shard's number.  The numbers of the other shards
don't enter, so one more shard takes records only into itself, and losing one
moves only its own records.  Only DataFrame functions are used.

A null key hashes as a key of its own (its rows keep together); null and empty
texts have no bytes, and long ones are only measured and hashed.  Equal keys
share a shard; slots within one go by cells of a hash, then key, size and text
hash, and rows equal in all three take slots next to each other.  No rows give no
rows.  Extra columns aren't in the manifest, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cost(key: Column, shard: int, weight: float) -> Column:
    # 52 bits of the hash and a half keep u inside (0, 1)
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 52)) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 ..) of a key among weighted shards; a weight of 0 takes nothing."""
    costs = [F.struct(_cost(key, i, w).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    if not costs:
        raise ValueError("no shard has a weight")
    return (F.least(*costs) if len(costs) > 1 else costs[0])["shard"]


def number_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot", cells: int = 512) -> DataFrame:
    """Add gapless positions from 0 within each shard, without sorting a shard in one task.

    Each shard is dealt into cells by a hash of the ordering columns; equal rows
    are counted before the shuffle, so many repeats of one row meet as one.  A
    cell's rows are numbered by a window and moved by the counts of the cells
    before it (at most shards x cells rows).  ``df`` must hold nothing but
    shard, order and columns that these decide.
    """
    columns = df.columns
    counted = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int")).groupBy("_cell", *columns).agg(F.count("*").alias("_n"))
    sizes = counted.groupBy(shard, "_cell").agg(F.sum("_n").alias("_size"))
    cells_before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(shard, "_cell", F.coalesce(F.sum("_size").over(cells_before), F.lit(0)).alias("_offset"))
    rows_before = Window.partitionBy(shard, "_cell").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    first = counted.withColumn("_first", F.coalesce(F.sum("_n").over(rows_before), F.lit(0)))
    placed = first.join(F.broadcast(offsets), [shard, "_cell"])
    # repeats unfold in two steps: no array holds more than 65,536 or n / 65,536 numbers
    block = 1 << 16
    blocks = placed.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {block}"))))
    inside = F.sequence(F.col("_block") * block, F.least(F.col("_n"), (F.col("_block") + 1) * block) - 1)
    return blocks.withColumn("_k", F.explode(inside)).select(*columns, (F.col("_offset") + F.col("_first") + F.col("_k")).cast("long").alias(slot))


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", weights: Sequence[float] | None = None) -> DataFrame:
    """A manifest: key, size, text_crc32, law, shard, slot and grown_shard (the shard among one more of mean weight)."""
    weights = list(weights or [1.0] * shards)
    data = F.col(text).cast("binary")
    keyed = docs.select(
        F.col(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"),
    )
    grown = [*weights, sum(weights) / len(weights)]
    placed = keyed.select(
        "*",
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights).cast("int").alias("shard"),
        rendezvous(F.col(key), grown).cast("int").alias("grown_shard"),
    )
    return number_slots(placed, "shard", [key, "size", "text_crc32"])
