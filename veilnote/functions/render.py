"""Rendered note bodies."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import CLEAN_MARKER, QUARANTINE_BANNER, QUARANTINE_MARKER
from .verify import shown_counts


def render_clean_note(target_date: Column, code: Column, counts: Column, text: Column) -> Column:
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Reference: "), code),
        F.concat(F.lit("Date: "), target_date.cast("string")),
        F.concat(F.lit("Substitutions: "), shown_counts(counts)),
        F.lit(""), F.lit(CLEAN_MARKER), F.lit(""), text)


def render_quarantine_note(note_id: Column, code: Column, reason: Column, text: Column) -> Column:
    return F.concat_ws(
        "\n",
        F.lit(QUARANTINE_BANNER),
        F.concat(F.lit("Note ID: "), note_id),
        F.concat(F.lit("Reference: "), code),
        F.concat(F.lit("Quarantine reason: "), reason),
        F.lit(""), F.lit(QUARANTINE_MARKER), F.lit(""), text)
