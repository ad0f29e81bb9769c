"""Known values of participants: id number, birth date, phone, e-mail, street."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import any_case_pattern, blank_to_empty, quote_literal
from ..functions.values import dob_variants, normalise_phone, street_part
from .surfaces import PASS_KNOWN, roster_position

NDIS, DOB, PHONE, EMAIL, ADDRESS = range(1, 6)
KINDS = {"ndis": NDIS, "dob": DOB, "phone": PHONE, "email": EMAIL, "address": ADDRESS}
_TAGS = ["[ndis_redacted]", "[dob]", "[phone]", "[email]", "[address]"]


def _entry(kind: int, variant: Column, value: Column, tag: str, label: str, pattern: Column, once: bool) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), variant.cast("int").alias("variant"), value.alias("form"),
        F.lit(tag).alias("tag"), F.lit(label).alias("label"), pattern.alias("pattern"),
        F.lit(once).alias("once"))


def known_value_steps(roster: DataFrame, kinds=tuple(KINDS), normalise_dob: bool = False) -> DataFrame:
    """Ordered replacement steps: participants in registry order, then kind.

    Id numbers match as whole words and count once per participant; birth
    dates and phones match anywhere and count once per written form; e-mails
    and streets match anywhere in any case and count every occurrence.
    """
    return _first_of_equal(_value_rows(roster, kinds, normalise_dob))


def _value_rows(roster: DataFrame, kinds, normalise_dob: bool) -> DataFrame:
    ndis, dob, phone, email, address = (blank_to_empty(F.col(c)) for c in (
        "ndis_number", "date_of_birth", "phone", "email", "address"))
    zero = F.lit(0)
    entries = {
        "ndis": F.array(_entry(NDIS, zero, ndis, "[NDIS_REDACTED]", "NDIS", F.concat(
            F.lit(r"(?U)\b"), quote_literal(ndis), F.lit(r"\b")), True)),
        "dob": F.transform(dob_variants(dob, normalise_dob), lambda v, i: _entry(
            DOB, i, v, "[DOB]", "DOB", quote_literal(v), True)),
        "phone": F.transform(F.array(phone, normalise_phone(phone)), lambda v, i: _entry(
            PHONE, i, v, "[PHONE]", "PHONE", quote_literal(v), True)),
        "email": F.array(_entry(EMAIL, zero, email, "[EMAIL]", "EMAIL", any_case_pattern(email), False)),
        "address": F.transform(F.array(street_part(address)), lambda v: _entry(
            ADDRESS, zero, v, "[ADDRESS]", "ADDRESS", any_case_pattern(v), False)),
    }
    return roster.select(
        roster_position(roster).alias("major"),
        F.explode(F.concat(*[entries[k] for k in KINDS if k in kinds])).alias("e"),
    ).where(F.col("e.form") != "").select(F.lit(PASS_KNOWN).alias("pass_no"), "major", "e.*")


def shared_ids(roster: DataFrame) -> DataFrame | None:
    """(pattern, major) of the id numbers that several participants hold, at each later holder; None if there are none.

    Such a number must stand alone, and edits for other participants may set
    one free after its first holder's turn.
    """
    rows = _value_rows(roster, ("ndis",), False).where(~_in_tag(F.col("form")))
    firsts = rows.groupBy("pattern").agg(F.min("major").alias("first"), F.max("major").alias("last")).where(
        "first < last").select("pattern", "first")
    if firsts.isEmpty():
        return None
    return rows.join(firsts, "pattern").where(F.col("major") > F.col("first")).select("pattern", "major").distinct()


def _in_tag(form: Column) -> Column:
    """Whether a value may occur in what another step puts in."""
    low = F.lower(form)
    found = low.contains("[") | low.contains("]")
    for tag in _TAGS:
        found = found | F.contains(F.lit(tag), low)
    return found


def _first_of_equal(rows: DataFrame) -> DataFrame:
    """Keep the first step of each pattern.

    Once a value was replaced nothing is left for a second participant with the
    same value (a shared phone, ``N/A``), unless it can occur in a tag, or is an
    id number that an edit in between sets free (see ``shared_ids``).
    Aggregated on the map side, so a value shared by a third of the roster
    costs one row per task.
    """
    keep_apart = F.when(_in_tag(F.col("form")), F.struct("major", "kind", "variant"))
    entry = F.struct("pass_no", "major", "kind", "variant", "form", "tag", "label", "once")
    return rows.groupBy("pattern", keep_apart.alias("apart")).agg(F.min(entry).alias("f")).select("f.*", "pattern")
