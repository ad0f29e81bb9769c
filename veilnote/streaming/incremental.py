"""Incremental runs: a file stream that takes each input once."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.rosters import staff_roster
from ..plans.daily_run import Run, archive_files, code_notes, process, run_documents, run_exports
from ..session import Staging, cut_lineage, exists, folder_of
from ..sources.note_files import scan_note_files
from ..sources.notes_csv import csv_files, scan_notes_csv
from ..sources.state import init_state


def note_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", archive: str | None = None,
                **options) -> DataFrame:
    """Stream of note rows from files landing in a folder.

    With ``archive`` consumed files are moved there once a later batch commits.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def stream_run(spark: SparkSession, base: str, name: str, batch_id: int, target_date: str, archive: str = "") -> Run:
    """The run of a batch: the same when the batch is replayed, another one under a new checkpoint."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    return Run(base, f"{name}-{stream}-{batch_id}", target_date, archive=archive)


def run_paths(spark: SparkSession, folder: str, paths: list[str], run: Run, kind: str, surfaces: DataFrame | None) -> None:
    """One run over listed files of a folder: outputs, alerts, manifest; files of which nothing waits are archived.

    Files that an earlier try of the batch has archived are passed over: all their rows are logged.
    """
    paths = [p for p in paths if exists(spark, p)]
    if not paths:
        return
    with Staging(spark):
        if kind == "txt":
            _, manifest = run_documents(spark, scan_note_files(spark, paths), run, surfaces)
        else:
            _, manifest = run_exports(spark, scan_notes_csv(spark, paths), csv_files(spark, paths), run, surfaces)
    if run.archive:
        archive_files(spark, folder, [r.src_file for r in manifest.where("complete").select("src_file").toLocalIterator()], run)


def waiting_paths(spark: SparkSession, folder: str, base: str, kind: str) -> list[str]:
    """Files still in the folder of which an earlier run left rows: of another date, or failed."""
    system, path = folder_of(spark, f"{base}/manifest")
    if not system.exists(path):
        return []
    seen = spark.read.parquet(f"{base}/manifest").where("waiting > 0").select("src_file").distinct()
    names = [r.src_file for r in seen.toLocalIterator() if r.src_file.lower().endswith(f".{kind}")]
    return [p for p in (f"{folder.rstrip('/')}/{name}" for name in sorted(names)) if exists(spark, p)]


def incremental_folder(spark: SparkSession, folder: str, base: str, checkpoint: str, target_date: str, kind: str = "csv",
                       surfaces: DataFrame | None = None, max_files: int = 1000, archive: str = "") -> StreamingQuery:
    """Exports (``csv``) or documents (``txt``) that have landed in a folder since the last run, from raw files to outputs.

    The stream is of file names; each batch scans its files as a daily run does:
    headers resolved per layout, date filter, name split and keys, alerts for
    files without a row of the day, a manifest, and with ``archive`` consumed
    files move to the date's folder there.  At most ``max_files`` names a batch
    pass the driver, the rest follow in further batches.  A stream gives a file
    once, so files in which earlier runs left rows are taken first.
    """
    init_state(spark, base)
    left = waiting_paths(spark, folder, base, kind)
    for k in range(0, len(left), max_files):
        run = Run(base, f"{kind}-left-{target_date}-{uuid.uuid4().hex}", target_date, archive=archive)
        run_paths(spark, folder, left[k:k + max_files], run, kind, surfaces)
    schema = "path string, modificationTime timestamp, length long, content binary"
    landed = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", f"*.{kind}")
              .option("maxFilesPerTrigger", max_files).load(folder).select("path"))

    def batch(files: DataFrame, batch_id: int) -> None:
        session = files.sparkSession
        run = stream_run(session, base, f"{kind}-files", batch_id, target_date, archive)
        run_paths(session, folder, [r.path for r in files.toLocalIterator()], run, kind, surfaces)

    return (landed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def incremental_run(notes: DataFrame, base: str, checkpoint: str, target_date: str, name: str = "stream",
                    staff: DataFrame | None = None, surfaces: DataFrame | None = None) -> StreamingQuery:
    """Process everything that has landed since the last run, then stop.

    The stream checkpoint remembers consumed files; the processed log keeps
    single notes from being taken twice even under a new checkpoint.  Staff are
    those of ``staff``, if given, else those that the batch's notes name.
    """
    init_state(notes.sparkSession, base)

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        with Staging(spark):
            rows = cut_lineage(rows)        # the files of a batch are read once
            run = stream_run(spark, base, name, batch_id, target_date)
            process(spark, code_notes(spark, rows, run), run, staff_roster(rows) if staff is None else staff, surfaces)

    return (notes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
