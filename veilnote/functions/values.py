"""Known-value column functions: birth dates, phones, street parts."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..fixed_values import STREET_PART_PATTERN
from .keys import parse_note_date
from .text import empty_strings


def dob_variants(dob: Column, normalise: bool = False) -> Column:
    """Nine written forms of an ISO birth date, in search order.

    Text that does not have three dash-separated parts gives no forms.  With
    ``normalise`` the cell is first parsed by the note-date rules, so
    day-first cells also give forms.
    """
    if normalise:
        dob = F.coalesce(F.date_format(parse_note_date(dob), "yyyy-MM-dd"), dob)
    parts = F.split(dob, "-")
    y, m, d = (F.get(parts, F.lit(i)) for i in range(3))
    yy = F.substring(y, F.lit(3), F.length(y))
    forms = F.flatten(F.array(*[
        F.array(F.concat_ws(sep, d, m, y), F.concat_ws(sep, d, m, yy), F.concat_ws(sep, m, d, y))
        for sep in ("/", "-", ".")]))
    return F.when((dob != "") & (F.size(parts) == 3), forms).otherwise(empty_strings())


def normalise_phone(phone: Column) -> Column:
    return F.regexp_replace(phone, r"(?U)[\s\-()]", "")


def street_part(address: Column) -> Column:
    """Leading street fragment of an address longer than 8 characters, else ''."""
    found = F.regexp_extract(address, "(?iuUd)^" + STREET_PART_PATTERN, 1)
    return F.when(F.length(address) > 8, found).otherwise(F.lit(""))
