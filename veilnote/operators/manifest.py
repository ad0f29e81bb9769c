"""What has become of every row of every input file, and of the notes that failed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import NOTE_FILE_PATTERN
from ..functions.keys import note_key, parse_note_date
from ..functions.text import py_strip
from ..sources.notes_csv import date_ok, split_person_name
from ..session import broadcast_if_small

MAX_ATTEMPTS = 5


def row_states(rows: DataFrame, target_date) -> DataFrame:
    """(src_file, note_id, due, blank, unreadable) of export rows.

    ``note_id`` is the one a row has, or will have, in the run of its own date, so a file with rows of several dates is
    done when each of them was processed on its day.
    """
    due = date_ok(target_date)
    own = parse_note_date(F.col("date"))
    day = F.when(due, F.lit(str(target_date))).otherwise(F.date_format(own, "yyyy-MM-dd"))
    named = split_person_name(rows.select(
        "src_file", "first_name", "last_name", "full_name", "note", due.alias("due"), day.alias("day"), (F.col("note") == "").alias("blank")))
    return named.select(
        "src_file", note_key(F.col("client_id"), F.col("day"), F.col("note")).alias("note_id"), "due", "blank",
        (F.col("day").isNull() & ~F.col("blank")).alias("unreadable"))


def document_states(files: DataFrame) -> DataFrame:
    """As ``row_states``, one row a document.  A document whose name tells no date and code is nobody's, and stays."""
    part = lambda n: F.regexp_extract("file_name", NOTE_FILE_PATTERN, n)
    named = F.coalesce(F.try_to_date(F.when(part(1) != "", part(1)), "yyyy-MM-dd").isNotNull(), F.lit(False))
    return files.select(
        F.col("file_name").alias("src_file"), F.regexp_replace("file_name", r"(?i)\.txt$", "").alias("note_id"), named.alias("due"),
        (named & (py_strip(F.col("text")) == "")).alias("blank"), F.lit(False).alias("unreadable"))


def consumed_files(states: DataFrame, finished: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The manifest: (src_file, rows, due, logged, left_out, waiting, complete) per file.

    ``finished`` holds the note ids that were logged or given up.  ``left_out`` rows have no body or a date that can't
    be read; ``waiting`` rows belong to another date or failed.  A file is complete when nothing waits.  ``files`` adds
    files without any row.
    """
    done = finished.select("note_id").distinct().withColumn("done", F.lit(True))
    left_out = F.col("blank") | F.col("unreadable")
    marked = states.withColumn("note_id", F.when(~left_out, F.col("note_id"))).join(done, "note_id", "left")
    counts = marked.groupBy("src_file").agg(
        F.count("*").alias("rows"), F.count_if("due").alias("due"), F.count("done").alias("logged"), F.count_if(left_out).alias("left_out"))
    if files is not None:
        none = [F.lit(0).cast("long").alias(c) for c in ("rows", "due", "logged", "left_out")]
        counts = counts.unionByName(files.select("src_file", *none)).groupBy("src_file").agg(
            *[F.sum(c).alias(c) for c in ("rows", "due", "logged", "left_out")])
    waiting = F.col("rows") - F.col("logged") - F.col("left_out")
    return counts.withColumn("waiting", waiting).withColumn("complete", F.col("waiting") == 0)


def letter_key(note_id: Column) -> Column:
    """What a failed note is known by: its id, or its place where it has none."""
    return F.coalesce(F.concat(F.lit("id "), note_id), F.concat_ws(" ", F.lit("row"), "src_file", F.col("src_row").cast("string")))


def with_letters(given: DataFrame, letters: DataFrame) -> DataFrame:
    """Given notes, with the attempts that each of them had, and the open dead letters that are not among them."""
    columns = ["src_file", "src_row", "note_id", "ref_code", "created_at", "note"]
    key = letter_key(F.col("note_id").cast("string")).alias("letter")
    known = letters.select(*columns, "attempt", key)
    mine = given.select(*[F.col(c).cast("long" if c == "src_row" else "string").alias(c) for c in columns]).withColumn("letter", key)
    before = known.groupBy("letter").agg(F.max("attempt").alias("attempt"))
    again = known.where(F.col("attempt") < MAX_ATTEMPTS).join(mine.select("letter"), "letter", "left_anti")
    return mine.join(broadcast_if_small(before), "letter", "left").withColumn(
        "attempt", F.coalesce("attempt", F.lit(0))).unionByName(again).drop("letter")


def failed_again(checked: DataFrame, letters: DataFrame) -> DataFrame:
    """The dead letters after a run: notes of ``checked`` with an ``error``, one attempt more; given-up ones stay as they are."""
    failed = checked.where(F.col("error").isNotNull()).select(
        "src_file", "src_row", "note_id", "ref_code", "created_at", "note", F.col("error").alias("reason"),
        (F.col("attempt") + 1).cast("int").alias("attempt"))
    key = letter_key(F.col("note_id")).alias("letter")
    tried = checked.select(key)
    rest = letters.where(F.col("attempt") >= MAX_ATTEMPTS).withColumn("letter", key).join(tried, "letter", "left_anti").drop("letter")
    return failed.unionByName(rest.select(failed.columns))


def given_up(letters: DataFrame) -> DataFrame:
    return letters.where(F.col("attempt") >= MAX_ATTEMPTS).select("note_id")


__all__ = ["MAX_ATTEMPTS", "row_states", "document_states", "consumed_files", "with_letters", "failed_again", "given_up"]
