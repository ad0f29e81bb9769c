"""Hash ids, dates, codes and output names."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import CODE_FORMAT
from .text import py_strip


def client_key(full_name: Column) -> Column:
    return F.concat(F.lit("csv_"), F.substring(F.md5(F.lower(full_name)), 1, 8))


def note_key(client_id: Column, date_text: Column, note: Column) -> Column:
    payload = F.concat(client_id, F.lit("|"), date_text, F.lit("|"), F.substring(note, 1, 100))
    return F.substring(F.sha2(payload, 256), 1, 16)


def parse_note_date(raw: Column) -> Column:
    """Day-first, ISO, two-digit-year day-first, then month-first; else null.

    The layout is checked by a pattern before parsing, so a cell is never read
    by a format it does not have.  Two-digit years 69-99 belong to 19xx.
    """
    s = py_strip(raw)

    def parsed(pattern: str, fmt: str, text: Column = s) -> Column:
        return F.when(s.rlike(pattern), F.try_to_date(text, fmt))

    four = r"^\d{1,2}/\d{1,2}/\d{4}$"
    short = r"^\d{1,2}/\d{1,2}/\d{2}$"
    parts = F.split(s, "/")
    year = F.get(parts, F.lit(2))
    century = F.when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
    long_year = F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.concat(century, year))
    return F.coalesce(
        parsed(four, "d/M/yyyy"),
        parsed(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        parsed(r"^\d{8}$", "yyyyMMdd"),
        parsed(short, "d/M/yyyy", long_year),
        parsed(four, "M/d/yyyy"),
    )


def date_passes(raw: Column, target: Column) -> Column:
    """Target-day predicate; a blank date cell always passes."""
    return (py_strip(raw) == "") | F.coalesce(parse_note_date(raw) == target, F.lit(False))


def local_yesterday(utc_now: Column, zone: str) -> Column:
    """The day before 'now' on the wall clock of a zone."""
    return F.date_sub(F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_now)), 1)


def reference_code(number: Column) -> Column:
    return F.format_string(CODE_FORMAT, number)


def code_number(code: Column) -> Column:
    """Trailing number of a code, 0 when there is none."""
    return F.coalesce(F.regexp_extract(code, r"(\d+)$", 1).try_cast("bigint"), F.lit(0))


def output_name(created: Column, code: Column, note_id: Column, quarantined: Column) -> Column:
    suffix = F.when(quarantined, F.lit("_QUARANTINE.txt")).otherwise(F.lit(".txt"))
    return F.concat(F.substring(created, 1, 10), F.lit("_"), code, F.lit("_note_"), note_id, suffix)
