"""The daily run: notes in, routed outputs, state and counters out."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.codes import assign_codes, registry_entries, with_codes
from ..operators.deidentify import deidentify
from ..operators.rosters import client_roster, staff_roster
from ..operators.manifest import MAX_ATTEMPTS, consumed_files, document_states, failed_again, given_up, row_states, with_letters
from ..operators.selection import already_ran, dedup_notes, drop_blank_notes, isolate_errors, skip_processed
from ..operators.stats import report_errors, report_metrics, report_quarantined, run_ledger_row, run_stats
from ..session import Staging, broadcast_if_small, cut_lineage, folder_of, move
from ..sources.notes_csv import csv_files, notes_from_rows, scan_notes_csv
from ..sources.note_files import choose_source_mode, notes_from_files, scan_note_files
from ..sources.outputs import rendered, route_outputs
from ..sources.state import (
    append_state, init_state, logged_among, publish_ledger, read_letters, read_state, replace_letters,
)


@dataclass
class Run:
    """Where a run keeps its state, and what it is called.

    ``inputs``: what the ledger says of the input; if empty, its number of files.
    ``archive``: consumed inputs move to its folder of the run's date, and a date
    that is there isn't run again.  ``published``: where a copy of the ledger goes.
    """
    base: str
    run_id: str
    target_date: str
    inputs: str = ""
    archive: str = ""
    published: str = ""


def write_report(table: DataFrame, run: Run, name: str) -> None:
    """A report table of the run; a repeated run replaces it."""
    table.write.mode("overwrite").parquet(f"{run.base}/reports/{name}/run_id={run.run_id}")


def code_notes(spark: SparkSession, notes: DataFrame, run: Run) -> DataFrame:
    """Give every client a code and store new codes before anything uses them."""
    registry = read_state(spark, run.base, "registry")
    entries = registry_entries(assign_codes(notes, registry), client_roster(notes))
    append_state(entries, run.base, "registry", run.run_id)
    return with_codes(notes, read_state(spark, run.base, "registry"))


def process(spark: SparkSession, notes: DataFrame, run: Run, staff: DataFrame | None,
            surfaces: DataFrame | None) -> DataFrame:
    """Coded notes to outputs, log rows, dead letters, one ledger row; gives the run counters.

    Open dead letters are further input.  The registry is written first, then
    outputs, then the log, then the dead letters, so a lost run can be repeated:
    codes stay, and only unlogged notes are taken again.
    """
    letters = read_letters(spark, run.base)
    checked = cut_lineage(isolate_errors(with_letters(notes, letters)))
    roster = read_state(spark, run.base, "registry")
    usable = checked.where(F.col("error").isNull()).drop("error")
    fresh = dedup_notes(skip_processed(drop_blank_notes(usable), logged_among(spark, run.base, checked)))
    work = cut_lineage(fresh.select("note_id", "ref_code", "created_at", "note"))
    if not work.isEmpty():
        outputs = rendered(deidentify(work, roster, staff, surfaces, cut=True), run.target_date)
        done = spark.read.parquet(route_outputs(outputs, run.base, run.run_id))
        append_state(done.select(
            "note_id", F.current_timestamp().alias("processed_at"), "output_path",
            F.when(F.col("disposition") == "pending", "success").otherwise("quarantine").alias("status"),
            "ref_code"), run.base, "processed_log", run.run_id)
        write_report(report_quarantined(done.withColumn("is_quarantined", F.col("disposition") == "quarantine")),
                     run, "quarantined")
    stats = cut_lineage(counters(checked, read_state(spark, run.base, "processed_log", run.run_id)))
    write_report(report_metrics(stats), run, "metrics")
    write_report(report_errors(checked), run, "errors")
    replace_letters(failed_again(checked, letters), run.base)
    inputs = run.inputs or f"{notes.agg(F.count_distinct('src_file')).first()[0]} file(s)"
    append_state(run_ledger_row(stats, run.target_date, dt.datetime.now(dt.timezone.utc).isoformat(), inputs),
                 run.base, "run_ledger", run.run_id)
    if run.published:
        publish_ledger(spark, run.base, run.published)
    return spark.createDataFrame([stats.first()], stats.schema)       # one row; the staged tables go


def counters(checked: DataFrame, logged: DataFrame) -> DataFrame:
    """Run counters; everything neither finished nor failed was skipped.

    What was finished is taken from the run's log rows for its input, so a run
    that is repeated after it was cut short counts the same.
    """
    finished = logged.join(checked.select("note_id"), "note_id", "left_semi").select(
        F.when(F.col("status") == "success", "pending").otherwise("quarantine").alias("disposition"))
    done = run_stats(finished).select(F.struct("uploaded", "quarantined")).scalar()
    seen = checked.agg(F.count("*").alias("total"), F.count("error").alias("errors"), done.alias("done"))
    return seen.select("total", "errors", "done.*").select(
        "total", "uploaded", "quarantined",
        (F.col("total") - F.col("errors") - F.col("uploaded") - F.col("quarantined")).alias("skipped"), "errors")


def archived_dates(spark: SparkSession, archive: str) -> DataFrame:
    """(run_date) of the dates whose inputs were archived, by folder names."""
    system, path = folder_of(spark, archive)
    days = [f.getPath().getName() for f in system.listStatus(path) if f.isDirectory()] if system.exists(path) else []
    return spark.createDataFrame([(d,) for d in days], "run_date string")


def input_files(spark: SparkSession, input_path: str) -> list[str]:
    """Names of the files of a folder, without those of folders in it."""
    system, path = folder_of(spark, input_path)
    return sorted(f.getPath().getName() for f in system.listStatus(path) if f.isFile()) if system.exists(path) else []


def archive_files(spark: SparkSession, input_path: str, names: list[str], run: Run) -> None:
    """Move consumed inputs to the archive folder of the run's date; only names pass the driver."""
    for name in names:
        move(spark, f"{input_path.rstrip('/')}/{name}", f"{run.archive.rstrip('/')}/{run.target_date}/{name}")


def account(spark: SparkSession, states: DataFrame, files: DataFrame | None, run: Run) -> DataFrame:
    """The run's manifest of its input files, written after the log; with the alerts of files without a row of the day."""
    ids = cut_lineage(states)
    finished = logged_among(spark, run.base, ids).select("note_id").unionByName(given_up(read_letters(spark, run.base)))
    path = f"{run.base}/manifest/run_id={run.run_id}"
    table = consumed_files(ids, finished, files)
    table.write.mode("overwrite").parquet(path)
    manifest = spark.read.schema(table.schema).parquet(path)
    if files is not None:
        write_report(manifest.where("due = 0").select("src_file", F.col("due").alias("matched_rows"), F.lit(True).alias("alert")), run, "alerts")
    return manifest


def run_documents(spark: SparkSession, files: DataFrame, run: Run, surfaces: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """A run over documents(file_name, text); gives counters and manifest."""
    files = cut_lineage(files)
    notes = notes_from_files(files).select("*", F.col("note_id").alias("src_file"), F.lit(0).cast("long").alias("src_row"))
    stats = process(spark, cut_lineage(notes), run, None, surfaces)
    return stats, account(spark, document_states(files), None, run)


def run_exports(spark: SparkSession, source: DataFrame, files: DataFrame, run: Run,
                surfaces: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """A run over export rows of the files; gives counters and manifest."""
    notes = cut_lineage(notes_from_rows(source, run.target_date))
    stats = process(spark, code_notes(spark, notes, run), run, staff_roster(notes), surfaces)
    return stats, account(spark, row_states(source, run.target_date), files, run)


def daily_run(spark: SparkSession, input_path: str, run: Run, surfaces: DataFrame | None = None) -> DataFrame | None:
    """One run over a folder: documents if there are any, else note exports.

    Gives the counters; none if there is no input, or if the date was archived
    already and no note of its failed ones is to be tried again.  Outputs, log,
    reports, alerts, ledger and its copy are written before inputs are archived,
    so a lost run is repeated as a whole.  A file is archived once each of its
    rows was logged or given up, so one with rows of another date stays for the
    run of that date.
    """
    init_state(spark, run.base)
    wanted = spark.createDataFrame([(run.target_date,)], "run_date string")
    again = bool(run.archive) and already_ran(wanted, archived_dates(spark, run.archive)).isEmpty()
    letters = read_letters(spark, run.base).where(F.col("attempt") < MAX_ATTEMPTS)
    if again and letters.isEmpty():
        return None
    there = set(input_files(spark, input_path)) if run.archive else set()    # files that land later stay for the next run
    with Staging(spark):
        mode, source = choose_source_mode(scan_note_files(spark, input_path), lambda: scan_notes_csv(spark, input_path))
        if mode == "none":
            return None
        if mode == "documents":
            if again:       # only documents that failed before
                stem = F.regexp_replace("file_name", r"(?i)\.txt$", "")
                source = source.join(broadcast_if_small(letters.select("note_id").distinct()), stem == F.col("note_id"), "left_semi")
            stats, manifest = run_documents(spark, source, run, surfaces)
        else:
            files = csv_files(spark, input_path)
            if again:
                failed = broadcast_if_small(letters.select("src_file").distinct())
                source, files = (x.join(failed, "src_file", "left_semi") for x in (source, files))
            stats, manifest = run_exports(spark, source, files, run, surfaces)
    archive_files(spark, input_path, [r.src_file for r in manifest.where("complete").select("src_file").toLocalIterator() if r.src_file in there], run)
    return stats
