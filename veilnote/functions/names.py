"""Person-name column functions: surface forms of a full name."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import GENERIC_TERMS, NICKNAMES, TITLES
from .text import bind, empty_strings, lit_map, lit_words, py_strip, py_words

_TITLE = "^(?:" + "|".join(TITLES) + r")\.? "
_TITLE_ALONE = "^(?:" + "|".join(TITLES) + r")\.?$"


def strip_title(name: Column) -> Column:
    """Drop one leading title."""
    stripped = py_strip(name)
    return F.when(stripped.rlike(_TITLE), py_strip(F.regexp_replace(stripped, _TITLE, ""))).otherwise(stripped)


def nickname_expand(first: Column) -> Column:
    """Formal first name to short form and short form to formal, exact case."""
    inverse = {short: formal for formal, short in NICKNAMES.items()}
    return F.array_compact(F.array(F.try_element_at(lit_map(NICKNAMES), first),
                                   F.try_element_at(lit_map(inverse), first)))


def name_variations(full_name: Column) -> Column:
    """Distinct surface forms of a full name, each also as a possessive."""
    def forms(clean: Column) -> Column:
        def from_words(words: Column) -> Column:
            first, last = F.get(words, F.lit(0)), F.get(words, F.size(words) - 1)
            single = F.filter(F.array(clean), lambda v: F.length(v) > 2)
            several = F.concat(
                F.array(full_name, clean),
                F.filter(F.array(first), lambda v: (F.length(v) > 2) & ~v.rlike(_TITLE_ALONE)),
                F.filter(F.array(last), lambda v: F.length(v) > 2),
                nickname_expand(first))
            return F.when(F.size(words) >= 2, several).otherwise(single)
        return bind(py_words(clean), from_words)

    both = F.flatten(F.transform(bind(strip_title(full_name), forms),
                                 lambda v: F.array(v, F.concat(v, F.lit("'s")))))
    usable = full_name.isNotNull() & (py_strip(full_name) != "")
    return F.when(usable, F.array_distinct(both)).otherwise(empty_strings())


def is_generic_term(c: Column) -> Column:
    return F.array_contains(lit_words(GENERIC_TERMS), F.lower(c))


def surface_ok(form: Column, check_generic: bool = True) -> Column:
    """A form may be searched for: long enough and not a plain word."""
    ok = F.length(form) > 2
    return ok & ~is_generic_term(form) if check_generic else ok


def full_name(first: Column, last: Column) -> Column:
    """First and last name joined by one space, missing parts left out."""
    first, last = F.coalesce(first, F.lit("")), F.coalesce(last, F.lit(""))
    return py_strip(F.concat(first, F.lit(" "), last))

