"""Residual check of de-identified text, and counters."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import RESIDUAL_REASONS
from .detectors import detect_emails, detect_ndis, detect_phones
from .text import bind, py_quoted_list

HITS_TYPE = "array<struct<label:string,n:bigint>>"


def no_hits() -> Column:
    return F.array().cast(HITS_TYPE)


def residual_sort(values: Column) -> Column:
    return F.array_sort(F.array_distinct(values))


def quarantine_reason(text: Column) -> Column:
    """First kind of identifier still present, with its sorted values; else null."""
    kinds = (detect_ndis, detect_phones, detect_emails)

    def reason(detect, words: str) -> Column:
        return bind(detect(text), lambda found: F.when(
            F.size(found) > 0, F.concat(F.lit(words), py_quoted_list(found))))

    return F.coalesce(*[reason(d, w) for d, w in zip(kinds, RESIDUAL_REASONS)])


def total_hits(hits: Column) -> Column:
    """Hits summed per label, labels in order of first appearance."""
    def summed(found: Column) -> Column:
        return F.transform(
            F.array_distinct(F.transform(found, lambda h: h["label"])),
            lambda name: F.struct(
                name.alias("label"),
                F.aggregate(F.filter(found, lambda h: h["label"] == name), F.lit(0).cast("long"),
                            lambda acc, h: acc + h["n"]).alias("n")))

    return bind(hits, summed)


def shown_counts(counts: Column) -> Column:
    """Ordered counts as ``{'LABEL': 2, ...}``."""
    return F.concat(F.lit("{"), F.array_join(F.transform(counts, lambda c: F.concat(
        F.lit("'"), c["label"], F.lit("': "), c["n"].cast("string"))), ", "), F.lit("}"))
