"""State tables: code registry, processed log, run ledger.

Every run appends under its own ``run_id=...`` folder.  Known clients and
processed notes are never selected again, so a repeated run adds nothing.  The
processed log is also partitioned by a prefix of its ids, so a batch reads only
the parts that its own notes fall into.  Dead letters are one table that each
run replaces: notes that could not be processed, with reason and attempts.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..fixed_values import LEDGER_COLUMNS
from ..functions.names import full_name
from ..functions.text import blank_to_empty, py_strip, py_words
from ..session import folder_of, move, remove

REGISTRY_SCHEMA = (
    "ref_code string, client_id string, full_name string, ndis_number string, date_of_birth string, "
    "address string, phone string, email string, first_name string, last_name string, "
    "date_first_assigned timestamp, pos long")
LOG_SCHEMA = "note_id string, processed_at timestamp, output_path string, status string, ref_code string"
LEDGER_SCHEMA = ", ".join(
    f"`{c}` {'long' if c.startswith('Notes') else 'string'}" for c in LEDGER_COLUMNS)
LETTER_SCHEMA = ("src_file string, src_row long, note_id string, ref_code string, created_at string, note string, "
                 "reason string, attempt int")
LOG_DIGITS = 2      # of the hash of a note id, so 256 parts
SCHEMAS = {"registry": REGISTRY_SCHEMA, "processed_log": LOG_SCHEMA, "run_ledger": LEDGER_SCHEMA}


def init_state(spark: SparkSession, base: str) -> None:
    """Create missing state tables, empty."""
    for name, schema in SCHEMAS.items():
        empty = spark.createDataFrame([], schema + (", prefix string" if name == "processed_log" else ""))
        parts = ["prefix"] if name == "processed_log" else []
        empty.write.mode("ignore").partitionBy(*parts).parquet(f"{base}/{name}/run_id=init")


def read_state(spark: SparkSession, base: str, name: str, run_id: str | None = None) -> DataFrame:
    """A state table, or what one run wrote to it; an absent one is empty.

    Any other failure is raised: an unreadable registry must not restart codes.
    """
    rows = _partitioned(spark, f"{base}/{name}", SCHEMAS[name] + ", run_id string" + (
        ", prefix string" if name == "processed_log" else ""))
    return (rows if run_id is None else rows.where(F.col("run_id") == run_id)).drop("run_id", "prefix")


def _partitioned(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def id_prefix(note_id: Column) -> Column:
    return F.substring(F.md5(note_id), 1, LOG_DIGITS)


def logged_among(spark: SparkSession, base: str, notes: DataFrame) -> DataFrame:
    """(note_id, status) rows of the processed log in the parts that the ids of ``notes`` fall into.

    Only prefixes reach the driver (256 at most); all other partitions of the log are pruned.
    """
    prefixes = [r.prefix for r in notes.where("note_id is not null").select(id_prefix(F.col("note_id")).alias("prefix")).distinct().collect()]
    rows = _partitioned(spark, f"{base}/processed_log", LOG_SCHEMA + ", run_id string, prefix string")
    return rows.where(F.col("prefix").isin(prefixes)).select("note_id", "status")


def read_letters(spark: SparkSession, base: str) -> DataFrame:
    """The dead letters after the last run that replaced them; none before the first."""
    versions = _letter_versions(spark, base)
    if not versions:
        return spark.createDataFrame([], LETTER_SCHEMA)
    return spark.read.schema(LETTER_SCHEMA).parquet(f"{base}/dead_letters/version={versions[-1]}")


def replace_letters(letters: DataFrame, base: str) -> None:
    """Write the dead letters as a new version; a complete one replaces those before it, whose texts are removed."""
    spark = letters.sparkSession
    old = _letter_versions(spark, base, complete=False)
    new = f"{base}/dead_letters/version={(old[-1] if old else 0) + 1}"
    letters.select([F.col(f.name) for f in spark.createDataFrame([], LETTER_SCHEMA).schema]).write.parquet(new)
    for version in old:
        remove(spark, f"{base}/dead_letters/version={version}")


def _letter_versions(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    system, path = folder_of(spark, f"{base}/dead_letters")
    if not system.exists(path):
        return []
    found = [f.getPath() for f in system.listStatus(path)]
    done = [p for p in found if not complete or system.exists(folder_of(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def append_state(rows: DataFrame, base: str, name: str, run_id: str) -> None:
    """Add rows under the folder of the run.  The ledger has one row per run: a repeated run replaces its own."""
    columns = [f.name for f in rows.sparkSession.createDataFrame([], SCHEMAS[name]).schema]
    mode = "overwrite" if name == "run_ledger" else "append"
    rows, parts = rows.select(*[F.col(f"`{c}`") for c in columns]), []
    if name == "processed_log":
        rows, parts = rows.withColumn("prefix", id_prefix(F.col("note_id"))).repartition("prefix"), ["prefix"]
    rows.write.mode(mode).partitionBy(*parts).parquet(f"{base}/{name}/run_id={run_id}")


def publish_ledger(spark: SparkSession, base: str, target: str) -> None:
    """Replace the published copy of the run ledger, one CSV file of a row per run.

    The copy is written aside and swapped in, so readers never see a part of it
    and a failed write leaves the earlier copy.
    """
    target = target.rstrip("/")
    mark = uuid.uuid4().hex
    fresh, old = f"{target}.new-{mark}", f"{target}.old-{mark}"
    read_state(spark, base, "run_ledger").coalesce(1).write.option("header", "true").csv(fresh)
    system, path = folder_of(spark, target)
    if system.exists(path):
        move(spark, target, old)
    move(spark, fresh, target)
    remove(spark, old)


def scan_registry(rows: DataFrame) -> DataFrame:
    """Seven positional text cells A..G plus ``row``; later rows win per client.

    Rows without code or client are dropped, short rows are padded.
    """
    cells = [blank_to_empty(F.col(c)) for c in "abcdefg"]
    padded = rows.select("row", *[cell.alias(n) for cell, n in zip(cells, "abcdefg")]).select(
        "row", py_strip(F.col("a")).alias("ref_code"), py_strip(F.col("b")).alias("client_id"),
        F.col("c").alias("full_name"), F.col("d").alias("ndis_number"), F.col("e").alias("date_of_birth"),
        F.col("f").alias("address"), F.col("g").alias("date_first_assigned"))
    fields = [c for c in padded.columns if c not in ("row", "client_id")]
    last = padded.where((F.col("ref_code") != "") & (F.col("client_id") != "")).groupBy("client_id").agg(
        F.max_by(F.struct(*fields), "row").alias("r"))
    return registry_name_split(last.select("client_id", "r.*"))


def registry_name_split(rows: DataFrame) -> DataFrame:
    """First and last word of the stored full name."""
    words = py_words(F.col("full_name"))
    return rows.select(
        "*", F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("first_name"),
        F.when(F.size(words) > 1, F.element_at(words, -1)).otherwise("").alias("last_name"))


def scan_processed_log(log: DataFrame) -> DataFrame:
    """Distinct trimmed note ids."""
    return log.select(py_strip(F.col("note_id").cast("string")).alias("note_id")).distinct()


__all__ = ["init_state", "read_state", "append_state", "logged_among", "read_letters", "replace_letters", "publish_ledger", "scan_registry",
           "registry_name_split", "scan_processed_log", "full_name"]
