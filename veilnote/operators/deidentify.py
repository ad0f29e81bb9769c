"""The de-identification passes, composed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.spans import find_spans, merge_spans, span_hits, splice_spans
from ..functions.verify import quarantine_reason, total_hits
from ..session import cut_lineage
from .known_values import KINDS, known_value_steps, shared_ids
from .matching import apply_forms, value_forms, value_keys, with_context, word_forms, word_keys
from .surfaces import dictionary_steps, word_steps


def start(notes: DataFrame, text: str = "note") -> DataFrame:
    """The working frame: the text column is edited in place from here on."""
    return notes.withColumnRenamed(text, "text")


def redact_words(work: DataFrame, roster: DataFrame | None = None, staff: DataFrame | None = None) -> DataFrame:
    """Participant names to codes, then staff names to the staff tag."""
    steps = word_steps(roster, staff)
    return work if steps is None else apply_forms(work, word_forms(steps, codes=True), word_keys)


def redact_known_values(work: DataFrame, roster: DataFrame, kinds=tuple(KINDS), normalise_dob: bool = False) -> DataFrame:
    """Known id numbers, birth dates, phones, e-mails and streets to tags."""
    forms = value_forms(known_value_steps(roster, kinds, normalise_dob))
    if "ndis" in kinds and len(kinds) > 1:
        forms.shared = shared_ids(roster)
    return apply_forms(work, forms, value_keys)


def redact_dictionary(work: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Dictionary surfaces (carers, providers, people, organisations, places) to tags."""
    return apply_forms(work, word_forms(dictionary_steps(surfaces), codes=False), word_keys)


def pattern_pass(text: Column, locations: Column) -> Column:
    """``struct(text, hits)`` after replacing every detected span."""
    return F.transform(
        F.array(merge_spans(find_spans(text, locations))),
        lambda spans: F.struct(splice_spans(text, spans).alias("text"), span_hits(spans).alias("hits")))[0]


def redact_patterns(work: DataFrame) -> DataFrame:
    done = with_context(work).withColumn("spliced", pattern_pass(F.col("text"), F.col("locations")))
    return done.withColumn("text", F.col("spliced.text")).withColumn(
        "hits", F.concat("hits", "spliced.hits")).drop("spliced")


def verify_residuals(work: DataFrame) -> DataFrame:
    """Re-run the id, phone and e-mail detectors; the first kind left quarantines."""
    checked = work.withColumn("quarantine_reason", quarantine_reason(F.col("text")))
    return checked.withColumn("is_quarantined", F.col("quarantine_reason").isNotNull())


def finish(work: DataFrame) -> DataFrame:
    """Working columns to result columns, counts both as map and in order."""
    out = verify_residuals(with_context(work)).withColumn("counts", total_hits(F.col("hits")))
    return out.withColumn("substitutions", F.map_from_entries("counts")).withColumnRenamed(
        "text", "deidentified_text").drop("hits", "locations")


def deidentify(
    notes: DataFrame,
    roster: DataFrame,
    staff: DataFrame | None = None,
    surfaces: DataFrame | None = None,
    *,
    text: str = "note",
    normalise_dob: bool = False,
    cut: bool = False,
) -> DataFrame:
    """De-identify notes (unique ``note_id`` and a text column).

    The text column is replaced by ``deidentified_text``; adds
    ``is_quarantined``, ``quarantine_reason``, ``counts`` (ordered) and
    ``substitutions`` (map).  Places are those of the unedited text; a later
    phase searches the text an earlier one produced.  With ``cut`` the text is checkpointed
    between phases, so it is produced once instead of once for finding the next
    candidates and once for editing; use it for long-running jobs.
    """
    between = cut_lineage if cut else (lambda df: df)
    work = redact_words(start(notes, text), roster, staff)
    work = redact_known_values(between(work), roster, normalise_dob=normalise_dob)
    if surfaces is not None:
        work = redact_dictionary(between(work), surfaces)
    return finish(redact_patterns(work))
