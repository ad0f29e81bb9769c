"""Pattern detectors: text column -> array of distinct matched strings.

Each detector is guarded by a cheap test that every match passes (without word
boundaries, which are slow to find in Unicode text), so most rows never run the
regular expression.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from ..fixed_values import (
    ADDRESS_PATTERN, ADDRESS_STOP_WORDS, DOB_PATTERN, EMAIL_PATTERN, NDIS_PATTERN,
    PHONE_PATTERNS, POSTCODE_RANGE, POSTCODE_YEAR_LIKE, STATES, SUBURB_POSTCODE_PATTERN,
)
from .names import is_generic_term
from .text import empty_strings, lit_words

_U = "(?U)"
_CI = "(?iuU)"


def _find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _guarded(test: Column, value: Column) -> Column:
    return F.when(test, value).otherwise(empty_strings())


def detect_ndis(text: Column) -> Column:
    """Standalone nine-digit runs."""
    return _guarded(text.rlike(r"(?U)\d{9}"), F.array_distinct(_find_all(text, _U + NDIS_PATTERN)))


def union_phone_matches(text: Column) -> Column:
    """Union of the four phone patterns, without guard."""
    return F.array_distinct(F.concat(*[_find_all(text, _U + p) for p in PHONE_PATTERNS]))


def detect_phones(text: Column) -> Column:
    test = r"(?U)\+61|0[2-478]\)?[\s-]?\d{4}|04\d{2}[\s-]?\d{3}"
    return _guarded((text.contains("+61") | text.contains("0")) & text.rlike(test), union_phone_matches(text))


def detect_emails(text: Column) -> Column:
    return _guarded(text.contains("@"), F.array_distinct(_find_all(text, _U + EMAIL_PATTERN)))


def dob_matches(text: Column) -> Column:
    """All birth-date mentions with their keyword, in text order (not distinct)."""
    return _guarded(text.rlike(r"(?U)[:\s]\d{1,2}[/.\-]\d{1,2}[/.\-]\d{2}"), _find_all(text, _CI + DOB_PATTERN))


def detect_dob(text: Column) -> Column:
    return F.array_distinct(dob_matches(text))


def detect_addresses(text: Column) -> Column:
    stop = "|".join(ADDRESS_STOP_WORDS)
    found = F.filter(_find_all(text, _U + ADDRESS_PATTERN), lambda m: ~F.lower(m).rlike(stop))
    return _guarded(text.rlike(r"(?U)[\d/.\-]\s+[A-Z][a-z]"), F.array_distinct(found))


def detect_states(text: Column) -> Column:
    """State codes and names present as whole words, case-sensitive."""
    any_state = reduce(or_, [text.contains(s) for s in STATES])
    hits = F.filter(lit_words(STATES), lambda s: F.contains(text, s) & F.rlike(
        text, F.concat(F.lit(_U + r"\b"), s, F.lit(r"\b"))))
    return _guarded(any_state, hits)


def detect_suburb_postcode(text: Column) -> Column:
    """``Suburb, [STATE] dddd``: the postcode, and the suburb unless generic."""
    pairs = F.arrays_zip(
        _find_all(text, _U + SUBURB_POSTCODE_PATTERN, 1).alias("suburb"),
        _find_all(text, _U + SUBURB_POSTCODE_PATTERN, 2).alias("postcode"),
    )
    code = lambda p: F.coalesce(p["postcode"].try_cast("int"), F.lit(0))
    kept = F.filter(pairs, lambda p: code(p).between(*POSTCODE_RANGE)
                    & ~code(p).between(*POSTCODE_YEAR_LIKE))
    parts = F.flatten(F.transform(kept, lambda p: F.when(
        is_generic_term(p["suburb"]), F.array(p["postcode"])
    ).otherwise(F.array(p["suburb"], p["postcode"]))))
    return _guarded(text.contains(",") & text.rlike(r"(?U),\s+[A-Z]{0,3}\s*\d{4}"), F.array_distinct(parts))


def detect_locations(text: Column) -> Column:
    return F.array_distinct(F.concat(
        detect_addresses(text), detect_states(text), detect_suburb_postcode(text)))

