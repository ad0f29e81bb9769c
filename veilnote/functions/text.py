"""Text column helpers shared by every operator.

All of them are built-in Spark expressions.  Patterns use ``(?U)`` so that
``\\b \\d \\s \\w`` follow Unicode, and ``(?iuU)`` where case is ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

WS = r"[\s\x1c-\x1f]"


def bind(value: Column, use) -> Column:
    """Evaluate a value once per row and use it many times.

    A column used inside a lambda is otherwise evaluated again for every
    element; binding it to a lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lit_words(values) -> Column:
    """Constant array of plain words, built from one literal."""
    return F.split(F.lit("|".join(values)), r"\|")


def lit_map(table: dict) -> Column:
    """Constant string map, built from one literal."""
    return F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in table.items())))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def blank_to_empty(c: Column) -> Column:
    """Missing cells count as the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def py_strip(c: Column) -> Column:
    """Strip every kind of Unicode white space, not only the space character."""
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def py_words(c: Column) -> Column:
    """Split on runs of white space; blank text gives an empty array."""
    return F.filter(F.split(py_strip(c), rf"(?U){WS}+"), lambda w: w != "")


def split_once(c: Column) -> Column:
    """Split on the first run of white space into at most two pieces."""
    return F.split(py_strip(c), rf"(?U){WS}+", 2)


def fold_case(c: Column) -> Column:
    """Case-insensitive comparison form.

    Upper then lower, with dotted capital I and final sigma levelled, so that
    any two strings equal under the ignore-case regex flags fold to one value.
    """
    def level(low: Column) -> Column:
        odd = F.contains(low, F.lit("i̇")) | F.contains(low, F.lit("ς"))
        return F.when(odd, F.translate(F.replace(low, F.lit("i̇"), F.lit("i")), "ς", "σ")).otherwise(low)

    return bind(F.lower(F.upper(c)), level)


def word_tokens(c: Column) -> Column:
    """Folded word runs, cut exactly where ``\\b`` may match."""
    return F.array_remove(F.split(fold_case(c), r"(?U)\W+"), "")


def quote_literal(c: Column) -> Column:
    """Escape regex metacharacters of a value."""
    return F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def quote_replacement(c: Column) -> Column:
    """Escape the two characters that are special in a replacement string."""
    return F.regexp_replace(c, r"([\\$])", r"\\$1")


def word_pattern(c: Column) -> Column:
    """Any-case, word-bounded pattern of a literal."""
    return F.concat(F.lit(r"(?iuU)\b"), quote_literal(c), F.lit(r"\b"))


def any_case_pattern(c: Column) -> Column:
    return F.concat(F.lit("(?iuU)"), quote_literal(c))


def ngrams(tokens: Column, sizes) -> Column:
    """Distinct space-joined token runs of the given sizes.

    Runs of n words are the runs of n - 1 words zipped with the words n - 1
    places further on.
    """
    def all_runs(words: Column) -> Column:
        kept, run = [], words
        for n in range(1, max(sizes) + 1):
            if n > 1:
                run = F.zip_with(run, F.slice(words, F.lit(n), F.size(words)),
                                 lambda head, word: F.concat(head, F.lit(" "), word))
            if n in sizes:
                kept.append(run)
        return F.array_compact(F.array_distinct(F.concat(*kept)))

    return bind(tokens, all_runs) if sizes else empty_strings()


#: White space other than the plain blank, and how a quoted list writes it.
_ESCAPES = [(c, repr(c)[1:-1]) for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def _escaped(value: Column) -> Column:
    for plain, shown in _ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(shown))
    return value


def py_quoted_list(values: Column) -> Column:
    """Sorted distinct strings, written as ``['a', 'b']``."""
    shown = F.transform(F.array_sort(F.array_distinct(values)), lambda v: F.concat(
        F.lit("'"), F.when(v.rlike(r"(?U)[\s&&[^ ]]|[\x1c-\x1f]"), _escaped(v)).otherwise(v), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
