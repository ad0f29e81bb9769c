"""Search dictionaries: which surface forms stand for which replacement."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import DICTIONARY_TYPES, NAME_LABEL_PREFIX, STAFF_LABEL, STAFF_TAG
from ..functions.keys import code_number
from ..functions.names import full_name, name_variations, surface_ok
from ..functions.text import blank_to_empty, lit_map

# pass numbers give the order in which the passes edit a note
PASS_PARTICIPANT, PASS_STAFF, PASS_KNOWN = 1, 2, 3
PASS_DICTIONARY = {t: 40 + i for i, t in enumerate(DICTIONARY_TYPES)}


def roster_filter(roster: DataFrame) -> DataFrame:
    """Participants with a usable full name and a code."""
    named = roster.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))
    return named.where((F.col("full_name") != "") & (blank_to_empty(F.col("ref_code")) != ""))


def roster_position(roster: DataFrame) -> Column:
    """Registry order of a participant: its own column, else the code number."""
    return F.col("pos").cast("long") if "pos" in roster.columns else code_number(F.col("ref_code"))


def participant_forms(roster: DataFrame) -> DataFrame:
    """(form, ref_code, pos) for every searchable surface form."""
    usable = roster_filter(roster)
    return usable.select(
        F.explode(name_variations(F.col("full_name"))).alias("form"),
        "ref_code", roster_position(roster).alias("pos"),
    ).where(surface_ok(F.col("form")))


def name_dictionary(roster: DataFrame) -> DataFrame:
    """One row per surface form; on shared forms the last participant wins.

    ``first_pos`` is the position of the form's first holder, by which forms of
    equal length are ordered.  ``max_by`` aggregates on the map side first, so a surname held by a third
    of the roster shuffles one row per task.
    """
    return participant_forms(roster).groupBy("form").agg(
        F.max_by("ref_code", F.struct("pos", "ref_code")).alias("ref_code"),
        (F.min("ref_code") != F.max("ref_code")).alias("ambiguous"),
        F.min("pos").alias("first_pos"),
    )


def staff_forms(staff: DataFrame) -> DataFrame:
    """(form, first_pos); without a ``pos`` column all staff hold the same position."""
    name = full_name(F.col("first_name"), F.col("last_name"))
    pos = F.col("pos").cast("long") if "pos" in staff.columns else F.lit(0).cast("long")
    return staff.select(F.explode(name_variations(name)).alias("form"), pos.alias("pos")).where(
        surface_ok(F.col("form"))).groupBy("form").agg(F.min("pos").alias("first_pos"))


def dictionary_surfaces(rows: DataFrame) -> DataFrame:
    """(type, surface) set of a ``Type, Name`` table; people also get variants."""
    people = [t for t, (_, _, person) in DICTIONARY_TYPES.items() if person]
    typed = rows.where((F.col("name") != "") & F.col("type").isin(*DICTIONARY_TYPES))
    variants = F.when(
        F.col("type").isin(*people),
        F.array_union(F.array("name"), name_variations(F.col("name"))),
    ).otherwise(F.array("name"))
    return typed.select("type", F.explode(variants).alias("surface")).distinct()


def dictionary_forms(surfaces: DataFrame) -> DataFrame:
    """Surfaces that are searched for; organisations skip the plain-word test."""
    c = F.col("surface")
    return surfaces.where(F.when(F.col("type") == "Organization", surface_ok(c, False)).otherwise(surface_ok(c)))


def word_steps(roster: DataFrame | None, staff: DataFrame | None) -> DataFrame | None:
    """Ordered word-replacement steps of the participant and staff passes."""
    parts = []
    if roster is not None:
        parts.append(name_dictionary(roster).select(
            F.lit(PASS_PARTICIPANT).alias("pass_no"), "form",
            F.col("ref_code").alias("tag"),
            F.concat(F.lit(NAME_LABEL_PREFIX), "ref_code").alias("label"), "first_pos"))
    if staff is not None:
        parts.append(staff_forms(staff).select(
            F.lit(PASS_STAFF).alias("pass_no"), "form",
            F.lit(STAFF_TAG).alias("tag"), F.lit(STAFF_LABEL).alias("label"), "first_pos"))
    return _union(parts)


def dictionary_steps(surfaces: DataFrame) -> DataFrame:
    """Ordered word-replacement steps of the dictionary passes."""
    columns = {
        "pass_no": PASS_DICTIONARY, "tag": {t: v[0] for t, v in DICTIONARY_TYPES.items()},
        "label": {t: v[1] for t, v in DICTIONARY_TYPES.items()}}
    spec = {n: F.element_at(lit_map(table), F.col("type")) for n, table in columns.items()}
    return dictionary_forms(surfaces).select(
        spec["pass_no"].cast("int").alias("pass_no"), F.col("surface").alias("form"),
        spec["tag"].alias("tag"), spec["label"].alias("label"), F.lit(0).cast("long").alias("first_pos"))


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out
