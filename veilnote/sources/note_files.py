"""Per-participant text documents and page text."""
from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import NOTE_FILE_PATTERN
from ..functions.text import py_strip
from ..session import cut_lineage, folder_of

READ_BYTES = 128 * 1024 * 1024      # of files that a task reads,
FILE_BYTES = 64 * 1024              # and what opening one counts as
BATCH_BYTES = 4 * 1024 * 1024
#: Characters that Spark escapes in ``_metadata.file_name``: those that a URI's path can't have.
ESCAPED = re.compile("[^A-Za-z0-9_.!~'()*,;:$&+=/@\\-\u00a1-\U0010ffff]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def scan_note_files(spark: SparkSession, path: str | list[str], name: Column | None = None) -> DataFrame:
    """One row per ``*.txt`` file of a folder, not of the folders in it: name and whole text.

    ``name`` gives the file's name where that isn't its own (``stored_name``), from ``_metadata.file_name``. Files of
    local folders are listed and read by tasks; Spark's reader would hold all of them on the driver.
    """
    files = list_note_files(spark, [path] if isinstance(path, str) else path)
    texts = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True) if files is None else read_note_files(files)
    return texts.select(
        (F.col("_metadata.file_name") if name is None else name.cast("string")).alias("file_name"), F.col("value").alias("text"))


def list_note_files(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """(folder, file, size) of what a scan of local folders reads, listed once, by tasks, which see the same folders.

    None for paths that are left to Spark's reader: of other file systems, which tasks can't open in Hadoop's way, single
    files, patterns, missing folders, and folders that have partition folders (``key=value``) in them.
    """
    folders = []
    for path in paths:
        system, target = folder_of(spark, path)
        if system.getUri().getScheme() != "file" or set(path) & set("{}[]*?\\") or not system.isDirectory(target):
            return None
        folders.append((system.makeQualified(target).toUri().getPath(),))
    if not folders:
        return None

    def rows_of(folder: str) -> Iterator[tuple[str, str, int]]:
        ahead = [folder]
        while ahead:
            at = ahead.pop()
            with os.scandir(at) as entries:
                for entry in entries:
                    if entry.name.startswith(".") or entry.name.startswith("_") and "=" not in entry.name:
                        continue                                # hidden
                    if entry.is_dir():
                        ahead.append(entry.path)
                        if "=" in entry.name:
                            yield folder, entry.name, -1
                    elif at == folder and entry.name.endswith(".txt") and entry.is_file() and entry.stat().st_size > 0:
                        yield folder, entry.name, entry.stat().st_size

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for row in rows_of(folder):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["folder", "file", "size"])
                        rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["folder", "file", "size"])

    tasks = min(len(folders), spark.sparkContext.defaultParallelism)
    files = cut_lineage(spark.createDataFrame(folders, "folder string").repartition(tasks).mapInArrow(
        listed, "folder string, file string, size long"))
    return files if files.where("size < 0").isEmpty() else None


def read_note_files(files: DataFrame) -> DataFrame:
    """Whole texts of the files of ``list_note_files``, as Spark's reader gives them: ``value`` and ``_metadata.file_name``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, texts, held = [], [], 0
        for batch in batches:
            for folder, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open(f"{folder}/{name}", "rb") as source:
                    texts.append(source.read())
                names.append(ESCAPED.sub(lambda m: quote(m[0], safe=""), name))
                held += len(texts[-1])
                if held >= BATCH_BYTES or len(names) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(texts, pa.binary())], ["name", "value"])
                    names, texts, held = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(texts, pa.binary())], ["name", "value"])

    count, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(count, max(cores, -(-(size + count * FILE_BYTES) // READ_BYTES))))
    return files.select("folder", "file").repartition(tasks).mapInArrow(read, "name string, value binary").select(
        F.struct(F.col("name").alias("file_name")).alias("_metadata"), F.col("value").cast("string").alias("value"))


def write_note_files(files: DataFrame, folder: str) -> list[str]:
    """Files of (file_name, text) rows, ``name=<name>.txt`` each, a line break after each text; gives the folders they are in.

    A task writes its files to a folder of its own, and only those of tasks that succeeded are given. Rows of one name
    and task share a file. Files are opened by the tasks themselves: Spark's writer starts several processes for
    each file of a local folder, to set its mode, and makes a folder of each name. The folder must be one that all executors share.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)
        part, last, out = uuid.uuid4().hex, None, None
        try:
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    name = "nameless" if name is None else f"name={name}"      # none is hidden, whatever the first character
                    if out is None:
                        system.create_dir(f"{root}/{part}", recursive=True)
                    if name != last:
                        if out is not None:
                            out.close()
                        last, out = name, system.open_output_stream(f"{root}/{part}/{name}.txt")
                    if text.is_valid:
                        out.write(text.as_buffer())
                    out.write(b"\n")
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part])], ["part"])

    ready = files.select("file_name", "text").sortWithinPartitions("file_name")
    parts = [f"{folder}/{r.part}" for r in ready.mapInArrow(write, "part string").collect()]      # one row a task
    if not parts:
        system, target = folder_of(files.sparkSession, folder)
        system.mkdirs(target)
    return parts or [folder]


def stored_name() -> Column:
    """The name under which ``write_note_files`` was given a file."""
    file = F.col("_metadata.file_name")
    return F.when(file.startswith("name="), F.regexp_extract(file, r"(?s)^name=(.*)\.txt$", 1))


def notes_from_files(files: DataFrame) -> DataFrame:
    """Date and code from the file name; bad names and empty bodies are left out."""
    part = lambda n: F.regexp_extract("file_name", NOTE_FILE_PATTERN, n)
    named = files.select(
        F.regexp_replace("file_name", r"(?i)\.txt$", "").alias("note_id"), F.upper(part(2)).alias("ref_code"),
        F.try_to_date(F.when(part(1) != "", part(1)), "yyyy-MM-dd").alias("day"), F.col("text").alias("note"))
    return named.where(F.col("day").isNotNull() & (py_strip(F.col("note")) != "")).select(
        "note_id", "ref_code", "note", F.date_format("day", "yyyy-MM-dd").alias("created_at"))


def skipped_files(files: DataFrame) -> DataFrame:
    """How many files are usable and how many are left out."""
    usable = notes_from_files(files).agg(F.count("*")).scalar()
    total = files.agg(F.count("*").alias("total"), usable.alias("usable"))
    return total.withColumn("skipped", F.col("total") - F.col("usable"))


def join_document_pages(pages: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    """Non-empty page texts of a document joined by line breaks in page order."""
    return pages.where(F.coalesce(F.col(text), F.lit("")) != "").groupBy(doc).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t")))),
            lambda x: x["t"]), "\n").alias("text"))


def choose_source_mode(documents: DataFrame, exports: DataFrame | Callable[[], DataFrame]) -> tuple[str, DataFrame | None]:
    """Documents if there are any, else exports, else nothing.  Exports given as a function are only planned if needed."""
    if not documents.isEmpty():
        return "documents", documents
    exports = exports() if callable(exports) else exports
    if not exports.isEmpty():
        return "exports", exports
    return "none", None


def file_inventory(spark: SparkSession, path: str | list[str], name: Column | None = None) -> DataFrame:
    """Files of a folder without reading their content; ``name`` as for ``scan_note_files``."""
    own = F.element_at(F.split("path", "/"), -1) if name is None else name.cast("string")
    return spark.read.format("binaryFile").load(path).select(own.alias("file_name"), "path", "modificationTime", "length")


def files_of_date(files: DataFrame, day: Column, suffix: str = "pdf") -> DataFrame:
    """Files named ``DATE-PART-*.<suffix>`` of a day."""
    name = F.col("file_name")
    return files.where(name.startswith(F.concat(day, F.lit("-PART-"))) & name.endswith("." + suffix))
