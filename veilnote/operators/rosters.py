"""Client and staff rosters out of note rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import split_once
from ..session import broadcast_if_small

CLIENT_FIELDS = ("first_name", "last_name", "ndis_number", "date_of_birth")


def client_roster(notes: DataFrame) -> DataFrame:
    """Per client: the first row of a file wins, a later file replaces.

    Aggregated on the map side, so one client with a third of all rows costs
    one row per task.
    """
    order = F.struct(F.col("src_file"), (-F.col("src_row")).alias("r"))
    return notes.groupBy("client_id").agg(
        F.max_by(F.struct(*CLIENT_FIELDS), order).alias("r")).select(
        "client_id", "r.*", *[F.lit("").alias(c) for c in ("address", "phone", "email")])


def staff_roster(notes: DataFrame) -> DataFrame:
    """Staff members by any-case name: first spelling in a file, last file wins."""
    in_file = notes.where(F.col("staff") != "").groupBy("src_file", F.lower("staff").alias("k")).agg(
        F.min_by("staff", "src_row").alias("staff"), F.min("src_row").alias("src_row"))
    parts = split_once(F.col("staff"))
    named = in_file.select(
        "src_file", "src_row", F.get(parts, F.lit(0)).alias("first_name"),
        F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("last_name"))
    key = F.lower(F.concat("first_name", F.lit(" "), "last_name"))
    return named.groupBy(key.alias("k")).agg(
        F.max_by(F.struct("first_name", "last_name"), F.struct("src_file", "src_row")).alias("r")).select("r.*")


def with_clients(notes: DataFrame, clients: DataFrame, *columns: str) -> DataFrame:
    """Notes with columns of their client, empty where the client is unknown; a small client table is broadcast."""
    known = broadcast_if_small(clients.select("client_id", *columns))
    return notes.join(known, "client_id", "left").select(
        *[c for c in notes.columns], *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
