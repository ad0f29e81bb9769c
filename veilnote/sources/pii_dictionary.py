"""``Type,Name`` dictionary files."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from ..functions.text import blank_to_empty, py_strip
from ..operators.surfaces import dictionary_surfaces
from .notes_csv import CSV_OPTIONS

SURFACE_SCHEMA = "type string, surface string"


def header_contains(headers, required=("Type", "Name")) -> bool:
    return set(required) <= {(h or "").strip() for h in headers}


def dictionary_rows(df: DataFrame) -> DataFrame | None:
    """(type, name) rows, or None when the header lacks a required column."""
    if not header_contains(df.columns):
        return None
    by_name = {c.strip(): c for c in df.columns}
    cell = lambda n: py_strip(blank_to_empty(F.col(f"`{by_name[n]}`")))
    return df.select(cell("Type").alias("type"), cell("Name").alias("name"))


def empty_surfaces(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SURFACE_SCHEMA)


def scan_pii_dictionary(spark: SparkSession, path: str | None) -> DataFrame:
    """(type, surface) set; a missing or mis-headed file gives none, an unreadable one is an error."""
    if not path:
        return empty_surfaces(spark)
    try:
        rows = dictionary_rows(spark.read.options(**CSV_OPTIONS).option("header", "true").csv(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = None
    return empty_surfaces(spark) if rows is None else dictionary_surfaces(rows)


def dictionary_counts(surfaces: DataFrame) -> DataFrame:
    return surfaces.groupBy("type").agg(F.count_distinct("surface").alias("surfaces"))
