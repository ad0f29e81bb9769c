"""Reference codes: sequential assignment in order of first appearance."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.keys import code_number, reference_code
from ..session import broadcast_if_small, cut_lineage

BLOCK = 1 << 20


def code_base(registry: DataFrame) -> DataFrame:
    """One row: the number new codes start after."""
    return registry.agg(F.greatest(
        F.count("*"), F.coalesce(F.max(code_number(F.col("ref_code"))), F.lit(0))).alias("base"))


def assign_codes(notes: DataFrame, registry: DataFrame) -> DataFrame:
    """(client_id, ref_code, pos) of clients not in the registry.

    Ranks are taken inside blocks of at most ``BLOCK`` row positions, and the
    block sizes are summed up: no task sorts more than one block, even when one
    file holds most of the rows.
    """
    seen = notes.groupBy("client_id").agg(F.min(F.struct("src_file", "src_row")).alias("at"))
    new = cut_lineage(seen.join(registry.select("client_id"), "client_id", "left_anti").select(
        "client_id", "at.src_file", "at.src_row", F.floor(F.col("at.src_row") / BLOCK).alias("block")))
    offsets = running_offsets(new.groupBy("src_file", "block").agg(F.count("*").alias("n")), "src_file", "block")
    ranked = new.withColumn("rank", F.row_number().over(W.partitionBy("src_file", "block").orderBy("src_row")))
    numbered = ranked.join(broadcast_if_small(offsets), ["src_file", "block"])
    number = code_base(registry).scalar() + F.col("offset") + F.col("rank")
    return numbered.select("client_id", number.cast("long").alias("pos")).select(
        "client_id", reference_code(F.col("pos")).alias("ref_code"), "pos")


def running_offsets(sizes: DataFrame, *order: str) -> DataFrame:
    """(order..., offset) of sizes(order..., n): the sum of all sizes before, in order.

    Two levels: rows are dealt to ranges of the order, sums run within a range,
    and the ranges' totals, one for each partition, are added up on the driver.
    """
    dealt = cut_lineage(sizes.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before, total = [], 0
    for r in dealt.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():      # as many as partitions
        before.append((r["range"], total))
        total += r.n
    starts = F.broadcast(dealt.sparkSession.createDataFrame(before, "range int, start long"))
    within = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return dealt.join(starts, "range").select(
        *order, (F.col("start") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("offset"))


def registry_entries(assigned: DataFrame, clients: DataFrame) -> DataFrame:
    """Full registry rows of newly coded clients."""
    name = F.trim(F.concat_ws(" ", "first_name", "last_name"))
    return assigned.join(clients, "client_id", "left").select(
        "ref_code", "client_id", name.alias("full_name"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in (
            "ndis_number", "date_of_birth", "address", "phone", "email", "first_name", "last_name")],
        F.current_timestamp().alias("date_first_assigned"), "pos")


def with_codes(notes: DataFrame, registry: DataFrame) -> DataFrame:
    """Add each note's code; a small registry is broadcast, a large one shuffled."""
    return notes.join(broadcast_if_small(registry.select("client_id", "ref_code")), "client_id", "left")
