"""Note exports: CSV files whose layouts may differ from file to file."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed_values import HEADER_ALIASES
from ..functions.keys import client_key, date_passes, note_key
from ..functions.names import full_name
from ..functions.text import blank_to_empty, py_strip, split_once
from ..session import broadcast_if_small, cut_lineage

FIELDS = ("date", "first_name", "last_name", "full_name", "note", "staff", "ndis", "dob")
WIDTH = 128         # cells of a line that are read
CSV_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def resolve_columns(headers, aliases=None) -> dict[str, int | None]:
    """Position of each logical field: first alias found, exact before any-case."""
    exact = {h: i for i, h in enumerate(headers)}
    folded = {h.lower(): i for i, h in enumerate(headers)}
    out = {}
    for field, names in {**HEADER_ALIASES, **(aliases or {})}.items():
        spots = (exact.get(n, folded.get(n.lower())) for n in names)
        out[field] = next((s for s in spots if s is not None), None)
    return out


def logical_rows(df: DataFrame, headers, aliases=None) -> DataFrame:
    """Project a raw layout to the logical fields; absent fields are ''.

    ``has_note`` and ``has_date`` tell whether the layout has the column.
    """
    spots = resolve_columns(headers, aliases)
    keep = [c for c in ("src_file", "src_row") if c in df.columns]
    data = [c for c in df.columns if c not in keep]

    def cell(field: str) -> Column:
        spot = spots[field]
        return F.lit("") if spot is None else py_strip(blank_to_empty(F.col(f"`{data[spot]}`")))

    return df.select(
        *keep, *[cell(f).alias(f) for f in FIELDS],
        F.lit(spots["note"] is not None).alias("has_note"),
        F.lit(spots["full_name"] is not None).alias("has_full_name"))


def header_spots(header: Column, aliases=None) -> Column:
    """``resolve_columns`` for a column of header cells: a struct of positions from 0, null for absent fields.

    Of equal cells the last one counts.
    """
    folded = F.transform(header, F.lower)

    def spot(cells: Column, name: str) -> Column:
        at = F.array_position(F.reverse(cells), F.lit(name))
        return F.when(at > 0, F.size(cells) - at)

    return F.struct(*[F.coalesce(*[s for n in names for s in (spot(header, n), spot(folded, n.lower()))]).cast("int").alias(field)
                      for field, names in {**HEADER_ALIASES, **(aliases or {})}.items()])


def raw_cells(spark: SparkSession, path: str | list[str], width: int = WIDTH) -> DataFrame:
    """(src_file, src_row, cells) of every line of the files of a folder, or of listed files, headers too.

    ``src_row`` orders lines within a file: a multi-line file is one split.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    reader = spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", "*.csv").schema(schema)
    return reader.csv(path).select(
        F.col("_metadata.file_name").alias("src_file"), F.monotonically_increasing_id().alias("src_row"),
        F.array(*[f"c{i}" for i in range(width)]).alias("cells"))


def header_width(spark: SparkSession, path: str | list[str]) -> int:
    """At least the cells of the widest header, ``WIDTH`` at most.

    A line costs by the cells that are asked for, so a first pass asks for one and the line as it is written, which
    Spark gives of lines of other than one cell.  Commas are counted, also quoted ones; a header without that line or
    without a first cell counts as ``WIDTH``.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", "*.csv").option("columnNameOfCorruptRecord", "raw")
    lines = reader.schema("c0 string, raw string").csv(path).select(
        F.col("_metadata.file_path").alias("src_file"), F.monotonically_increasing_id().alias("src_row"),
        F.when(F.col("c0").isNull() | F.col("raw").isNull(), WIDTH).otherwise(F.regexp_count("raw", F.lit(",")) + 1).alias("cells"))
    first = lines.groupBy("src_file").agg(F.min_by("cells", "src_row").alias("cells"))
    return min(WIDTH, first.agg(F.max("cells")).first()[0] or 1)


def scan_notes_csv(spark: SparkSession, path: str | list[str], aliases=None) -> DataFrame:
    """All rows of all files (of a folder, or listed) under the logical fields, with file and row order.

    Files are read without header: once for the width of their headers, and once
    up to it.  Their first lines give a small table of positions by file and
    field, so any number of layouts is one plan, and no file name or header
    passes the driver.  ``src_row`` orders rows within a
    file.  A header of ``WIDTH`` cells or more is an error, so no cell is lost.
    """
    lines = cut_lineage(raw_cells(spark, path, header_width(spark, path)))
    heads = lines.groupBy("src_file").agg(F.min_by("cells", "src_row").alias("header"), F.min("src_row").alias("first"))
    wide = F.raise_error(F.concat(F.lit("too many columns in "), F.col("src_file")))
    known = F.transform(F.col("header"), lambda c, i: F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", ""))
    heads = heads.select("src_file", "first", F.when(F.get("header", F.lit(WIDTH - 1)).isNotNull(), wide).otherwise(F.lit(None)).alias("_wide"),
                         header_spots(known, aliases).alias("at")).where("_wide is null").drop("_wide")
    rows = lines.join(broadcast_if_small(cut_lineage(heads)), "src_file").where(F.col("src_row") > F.col("first"))

    def cell(field: str) -> Column:
        return py_strip(blank_to_empty(F.get(F.col("cells"), F.col("at")[field])))

    return rows.select(
        "src_file", "src_row", *[cell(f).alias(f) for f in FIELDS],
        F.col("at.note").isNotNull().alias("has_note"), F.col("at.full_name").isNotNull().alias("has_full_name"))


def date_ok(target_date) -> Column:
    return date_passes(F.col("date"), F.lit(target_date).cast("date"))


def person_parts(first: Column, last: Column, full: Column) -> tuple[Column, Column]:
    """First and last name; the full name is split once when both are blank."""
    both_blank = (first == "") & (last == "")
    parts = split_once(full)
    return (F.when(both_blank, F.coalesce(F.get(parts, F.lit(0)), F.lit(""))).otherwise(first),
            F.when(both_blank, F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).otherwise(last))


def split_person_name(rows: DataFrame) -> DataFrame:
    """Name parts, the display name ('Unknown' when blank) and the client id."""
    first, last = person_parts(F.col("first_name"), F.col("last_name"), F.col("full_name"))
    named = rows.select("*", first.alias("f"), last.alias("l")).drop("first_name", "last_name", "full_name")
    named = named.withColumnsRenamed({"f": "first_name", "l": "last_name"})
    name = full_name(F.col("first_name"), F.col("last_name"))
    named = named.withColumn("client_name", F.when(name == "", F.lit("Unknown")).otherwise(name))
    return named.withColumn("client_id", client_key(F.col("client_name")))


def notes_from_rows(rows: DataFrame, target_date) -> DataFrame:
    """Rows of the target day with a body, keyed; dated by the target day."""
    kept = rows.where(date_ok(target_date) & (F.col("note") != ""))
    day = F.lit(str(target_date))
    return split_person_name(kept).select(
        "src_file", "src_row", note_key(F.col("client_id"), day, F.col("note")).alias("note_id"),
        "client_id", "first_name", "last_name", F.col("ndis").alias("ndis_number"),
        F.col("dob").alias("date_of_birth"), "staff", "note", day.alias("created_at"))


def csv_files(spark: SparkSession, path) -> DataFrame:
    """(src_file) of every export, also of those with nothing but a header; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select(
        F.col("_metadata.file_name").alias("src_file"))


def _of_every_file(counts: DataFrame, files: DataFrame | None, column: str) -> DataFrame:
    """Counts with a zero for files without any row."""
    if files is None:
        return counts
    none = files.select("src_file", F.lit(0).cast("long").alias(column))
    return counts.unionByName(none).groupBy("src_file").agg(F.sum(column).alias(column))


def no_match_alert(rows: DataFrame, target_date, files: DataFrame | None = None) -> DataFrame:
    """Per file: rows that passed the date test, and whether none did.  ``files`` adds those without a row."""
    counts = rows.groupBy("src_file").agg(F.count_if(date_ok(target_date)).alias("matched_rows"))
    return _of_every_file(counts, files, "matched_rows").withColumn("alert", F.col("matched_rows") == 0)


def count_note_rows(rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per file: rows with a body, all rows where there is no body column.  ``files`` adds those without a row."""
    counts = rows.groupBy("src_file").agg(
        F.count_if(~F.col("has_note") | (F.col("note") != "")).alias("note_rows"))
    return _of_every_file(counts, files, "note_rows")
