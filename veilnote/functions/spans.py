"""Spans: find literals, resolve overlaps, splice tags into the text.

A span is ``struct(start, priority, neg_end, rank, label)``: the natural order
of that struct is start, then priority, then longest first, then the order in
which labels are searched, so a plain ``sort_array`` gives the merge order.
Offsets count characters from 0; ``end`` is exclusive and kept negated.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import DOB_PATTERN, SPAN_PRIORITY, SPAN_TAG
from .detectors import detect_emails, detect_ndis, detect_phones, dob_matches
from .text import any_case_pattern, bind, lit_map, quote_literal, word_pattern

SPAN_TYPE = "struct<start:int,priority:int,neg_end:int,rank:int,label:string>"
SPANS_TYPE = f"array<{SPAN_TYPE}>"
_LABELS = list(SPAN_TAG)
_BLOCK = 64         # spans that are closed together, so that no list of all of them is copied for each


def no_spans() -> Column:
    return F.array().cast(SPANS_TYPE)


def make_span(start: Column, end: Column, label: str) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(SPAN_PRIORITY[label]).alias("priority"),
        (-end).cast("int").alias("neg_end"),
        F.lit(_LABELS.index(label)).alias("rank"),
        F.lit(label).alias("label"),
    )


def _spans_between(pieces: Column, lengths, label: str) -> Column:
    """Spans of the gaps between consecutive pieces of a split text.

    ``lengths(i)`` is the length of the i-th gap.  One pass with a running
    position.
    """
    steps = bind(pieces, lambda p: F.transform(
        F.slice(p, F.lit(1), F.size(p) - 1),
        lambda piece, i: F.struct(F.length(piece).alias("gap"), lengths(i).alias("len"))))
    start = F.struct(F.lit(0).alias("pos"), no_spans().alias("spans"))
    return F.aggregate(
        steps, start,
        lambda acc, s: F.struct(
            (acc["pos"] + s["gap"] + s["len"]).alias("pos"),
            F.array_append(
                acc["spans"],
                make_span(acc["pos"] + s["gap"], acc["pos"] + s["gap"] + s["len"], label),
            ).cast(SPANS_TYPE).alias("spans")),
        lambda acc: acc["spans"])


def literal_spans(text: Column, literal: Column, pattern: Column, label: str) -> Column:
    """Every non-overlapping occurrence of one literal under its pattern."""
    return _spans_between(F.split(text, pattern, -1), lambda i: F.length(literal), label)


def _sweep(text: Column, literals: Column, pattern_of, label: str) -> Column:
    return F.flatten(F.transform(literals, lambda v: literal_spans(text, v, pattern_of(v), label)))


def dob_spans(text: Column) -> Column:
    pieces = lambda: F.split(text, "(?iuU)" + DOB_PATTERN, -1)
    return bind(dob_matches(text), lambda found: F.when(
        F.size(found) > 0, _spans_between(pieces(), lambda i: F.length(F.get(found, i)), "DOB"),
    ).otherwise(no_spans()))


def find_spans(text: Column, locations: Column) -> Column:
    """All spans of detected ids, phones, e-mails, birth dates and places.

    A value detected once is swept through the whole text: ids, phones and
    e-mails anywhere (e-mails in any case), places as whole words in any case.
    """
    return F.concat(
        _sweep(text, detect_ndis(text), quote_literal, "NDIS"),
        _sweep(text, detect_phones(text), quote_literal, "PHONE"),
        _sweep(text, detect_emails(text), any_case_pattern, "EMAIL"),
        dob_spans(text),
        _sweep(text, locations, word_pattern, "LOCATION"),
    )


def merge_spans(spans: Column) -> Column:
    """Overlap resolution, left to right; only the last span is open, closed ones are not looked at again.

    An overlapping span of higher priority replaces the last one, an equal and
    longer one extends it (the last one's label stays), a lower one is dropped.
    """
    def resolve(acc: Column, cur: Column) -> Column:
        last = acc["last"]
        extended = F.struct(
            last["start"].alias("start"), last["priority"].alias("priority"),
            cur["neg_end"].alias("neg_end"), last["rank"].alias("rank"), last["label"].alias("label"))
        apart = cur["start"] >= -last["neg_end"]
        longer = (cur["priority"] == last["priority"]) & (cur["neg_end"] < last["neg_end"])
        return F.struct(
            F.when(apart, F.array_append(acc["closed"], last)).otherwise(acc["closed"]).alias("closed"),
            F.when(last.isNull() | apart | (cur["priority"] < last["priority"]), cur).when(longer, extended).otherwise(last).alias("last"))

    def block(acc: Column, some: Column) -> Column:
        start = F.struct(no_spans().alias("closed"), acc["last"].alias("last"))
        return bind(F.aggregate(some, start, resolve), lambda r: F.struct(
            F.array_append(acc["closed"], r["closed"]).alias("closed"), r["last"].alias("last")))

    def swept(sorted_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sorted_) - 1) / _BLOCK).cast("int")),
                             lambda k: F.slice(sorted_, k * _BLOCK + 1, F.lit(_BLOCK)))
        start = F.struct(F.array().cast(f"array<{SPANS_TYPE}>").alias("closed"), F.lit(None).cast(SPAN_TYPE).alias("last"))
        return F.aggregate(blocks, start, block, lambda acc: F.array_append(F.flatten(acc["closed"]), acc["last"]))

    return bind(F.sort_array(spans), lambda s: F.when(F.size(s) > 0, swept(s)).otherwise(no_spans()))


def splice_spans(text: Column, spans: Column) -> Column:
    """Text with every (merged, ordered) span replaced by its tag."""
    tags = lit_map(SPAN_TAG)

    def splice(found: Column) -> Column:
        def piece(s: Column, i: Column) -> Column:
            kept_from = F.coalesce(-F.get(found, i - 1)["neg_end"], F.lit(0))
            return F.concat(F.substring(text, kept_from + 1, s["start"] - kept_from),
                            F.element_at(tags, s["label"]))
        tail = F.substring(text, -F.try_element_at(found, F.lit(-1))["neg_end"] + 1, F.length(text))
        return F.when(F.size(found) > 0, F.concat(F.array_join(F.transform(found, piece), ""), tail)
                      ).otherwise(text)

    return bind(spans, splice)


def span_hits(spans: Column) -> Column:
    """One hit per span, in splice order (right to left)."""
    return F.transform(F.reverse(spans), lambda s: F.struct(
        s["label"].alias("label"), F.lit(1).cast("long").alias("n")))
