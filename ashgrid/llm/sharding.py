"""Sharding by jump consistent hashing.

A key walks 0 -> j1 -> j2 ... where each jump is the next shard count at which
the key would move, drawn from numbers that only the key and the step decide;
the last stop below the shard count is its shard.  No ring or table is kept,
and with one more shard a key either stays or moves into the new one.

Defined results: a null key hashes as the empty text; repeated keys share a
shard and get different slots; a null text has size ``overhead`` and the
checksum of an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import draw32, id_text, positions, text_or_empty

SLOT_BUCKETS = 1024


def jump_walk(key_text: Column, shards: int) -> Column:
    """struct(b, j): the last stop below ``shards`` and the next one, >= shards.

    Every step moves at least one shard on, so ``shards`` steps are enough;
    steps after the walk has ended are skipped.  About ln(shards) + 1 draws."""

    def step(s: Column, i: Column) -> Column:
        r = (draw32(key_text, i.cast("string")) + 1) / F.lit(4294967296.0)
        nxt = F.floor((s["j"] + 1) / r).cast("long")
        return F.when(s["j"] < shards, F.struct(s["j"].alias("b"), nxt.alias("j"))).otherwise(s)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def shard(docs: DataFrame, key: Column, text: Column, shards: int = 24, overhead: int = 8) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, slot (gapless from 0
    in its shard) and grown_shard (its shard with one shard more)."""
    t = text_or_empty(text)
    d = docs.select(
        key.alias("key"), (F.octet_length(t) + overhead).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        jump_walk(id_text(key), shards).alias("walk"),
        (draw32(F.lit("slot"), id_text(key)) % SLOT_BUCKETS).alias("bucket"),
    ).select("key", "size", "text_crc32", "bucket", F.col("walk.b").cast("int").alias("shard"),
             F.when(F.col("walk.j") == shards, shards).otherwise(F.col("walk.b")).cast("int").alias("grown_shard"))
    ranked = positions(d, ["shard"], "bucket", [F.col("key"), F.col("text_crc32"), F.col("size")], "slot")
    return ranked.select("key", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
