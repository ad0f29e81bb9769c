"""Placement on shards by a permutation-filled lookup table, with DataFrame functions only."""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shards, and slots of the table: a prime, some 64 slots a shard, so shards differ by one slot at most.
SHARDS, SLOTS = 64, 4099


def _number(text: str, at: int) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[at:at + 8], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard of each slot. A shard prefers slots in the order of its own permutation, start + k * step; shards take
    turns, each claiming its next preferred slot that is free. When a shard goes, others' slots mostly stay.

    The table has a fixed size, so it is filled on the driver. Needs a prime number of slots, at least one a shard.
    """
    if not 0 < len(names) <= slots:
        raise ValueError("at least one shard, and no more shards than slots")
    table = [-1] * slots
    at = [_number(name, 0) % slots for name in names]
    step = [_number(name, 8) % (slots - 1) + 1 for name in names]
    for turn in range(slots):
        shard = turn % len(names)
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + step[shard]) % slots
        table[at[shard]] = shard
    return table


def table_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard)."""
    listed = F.split(F.lit(",".join(map(str, table))), ",")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "shard")).select("slot", F.col("shard").cast("int").alias("shard"))


def place(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The rows of docs(doc_id, ...) with slot and shard: the slot is a hash of the id, its shard is looked up in the
    broadcast table. Nothing but the table moves. Rows with equal ids share a shard, null ids that of the empty text.
    Extra columns are kept; those named slot or shard are replaced."""
    code = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    slot = F.pmod(F.conv(F.substring(code, 1, 8), 16, 10).cast("long"), F.lit(slots)).cast("int")
    known = table_frame(docs.sparkSession, lookup_table([f"shard {k}" for k in range(shards)], slots))
    kept = [c for c in docs.columns if c not in ("slot", "shard")]
    return docs.select(*kept).withColumn("slot", slot).join(F.broadcast(known), "slot", "left").select(*kept, "slot", "shard")


SQL = f"""
WITH RECURSIVE names AS (
  SELECT k, ('0x' || substr(md5('shard ' || k), 1, 8))::BIGINT % {SLOTS} AS start,
         ('0x' || substr(md5('shard ' || k), 9, 8))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({SHARDS}) t(k)),
lists AS (SELECT list(start ORDER BY k) AS starts, list(step ORDER BY k) AS steps FROM names),
claims AS (
  SELECT 0 AS turn, [-1 for x in range({SLOTS})] AS filled FROM lists
  UNION ALL
  SELECT turn + 1, filled[1:won] || [turn % {SHARDS}] || filled[won + 2:]
  FROM (
    SELECT turn, filled, [s for s in order_ if filled[1 + s] < 0][1] AS won
    FROM (SELECT turn, filled, [(starts[1 + turn % {SHARDS}] + k * steps[1 + turn % {SHARDS}]) % {SLOTS} for k in range({SLOTS})] AS order_
          FROM claims, lists WHERE turn < {SLOTS}))),
slots AS (
  SELECT unnest(range({SLOTS})) AS slot, unnest(filled) AS shard FROM claims WHERE turn = {SLOTS}),
placed AS (
  SELECT doc_id, n_chars, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT % {SLOTS} AS slot
  FROM documents)
SELECT doc_id, n_chars, CAST(slot AS INTEGER) AS slot, CAST(shard AS INTEGER) AS shard FROM placed JOIN slots USING (slot)
"""
