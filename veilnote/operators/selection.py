"""Which notes still have to be processed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import py_strip
from ..session import broadcast_if_small


def position() -> Column:
    return F.struct("src_file", "src_row")


def drop_blank_notes(notes: DataFrame) -> DataFrame:
    return notes.where(py_strip(F.coalesce(F.col("note"), F.lit(""))) != "")


def skip_processed(notes: DataFrame, log: DataFrame) -> DataFrame:
    """Notes whose id is not in the processed log; run before any text work."""
    return notes.join(broadcast_if_small(log.select("note_id")), "note_id", "left_anti")


def already_processed(notes: DataFrame, log: DataFrame) -> DataFrame:
    return notes.join(broadcast_if_small(log.select("note_id")), "note_id", "left_semi")


def first_positions(notes: DataFrame) -> DataFrame:
    """Per note id: first position and number of copies."""
    return notes.groupBy("note_id").agg(F.min(position()).alias("first"), F.count("*").alias("copies"))


def dedup_notes(notes: DataFrame) -> DataFrame:
    """The first copy of each note id, in file and row order; notes without id are left out.

    First positions are one aggregate with map-side combine.  Notes are joined
    to them by id and position, so the copies of one id, however many, spread
    over all tasks.
    """
    firsts = notes.groupBy("note_id").agg(F.min(position()).alias("first")).select(
        F.col("note_id").alias("first_id"), "first.src_file", "first.src_row")
    return notes.alias("n").join(
        firsts.alias("f"), (F.col("n.note_id") == F.col("f.first_id")) & F.col("n.src_file").eqNullSafe(F.col("f.src_file"))
        & F.col("n.src_row").eqNullSafe(F.col("f.src_row")), "left_semi")


def file_order(notes: DataFrame, column: str) -> DataFrame:
    """(src_file, first, last): a column at the first and last row of each file, in file order.

    Rows are taken by position, with map-side combine, so no task sorts a file.
    """
    return notes.groupBy("src_file").agg(
        F.min_by(column, "src_row").alias("first"), F.max_by(column, "src_row").alias("last")).orderBy("src_file")


def id_collisions(notes: DataFrame) -> DataFrame:
    """Ids shared by different bodies."""
    return notes.groupBy("note_id").agg(
        (F.min(F.xxhash64("note")) != F.max(F.xxhash64("note"))).alias("differ"),
        F.count("*").alias("copies")).where("differ").drop("differ")


def note_date_or_target(created: Column, target: Column) -> Column:
    return F.substring(F.coalesce(created, target), 1, 10)


def isolate_errors(notes: DataFrame) -> DataFrame:
    """Add ``error``: why a note cannot be processed, null when it can."""
    return notes.withColumn("error", F.coalesce(
        F.when(F.col("note_id").isNull(), F.lit("missing note id")),
        F.when(~F.is_valid_utf8("note"), F.lit("text is not valid UTF-8"))))


def already_ran(requested: DataFrame, archived: DataFrame) -> DataFrame:
    """Requested dates without archived input."""
    return requested.join(broadcast_if_small(archived.select("run_date")), "run_date", "left_anti")


def export_worklist(participants: DataFrame, inventory: DataFrame) -> DataFrame:
    """(ref_code, run_date) still to be exported."""
    return participants.join(inventory.select("ref_code", "run_date"), ["ref_code", "run_date"], "left_anti")
