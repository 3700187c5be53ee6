"""Attributes of a party: person label, full name, role."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyfold import fixed
from partyfold.functions.text import text_or_empty


def person_type(code: Column) -> Column:
    """Label of a person code. The code is trimmed but its case counts.

    Null, unknown and unmatched codes all get the label of a legal person.
    """
    is_natural = F.trim(code) == fixed.NATURAL_PERSON_CODE
    return F.when(is_natural, fixed.NATURAL_PERSON_LABEL).otherwise(fixed.LEGAL_PERSON_LABEL)


def full_name(code: Column, given: Column, first: Column, second: Column) -> Column:
    """One line out of three cleaned name parts, never null.

    Natural persons start with the given name, all others end with it. Unlike
    `person_type`, this test ignores case and does not trim; published tables rely on the
    difference. A missing middle part leaves two spaces.
    """
    given, first, second = (text_or_empty(part) for part in (given, first, second))
    space = F.lit(" ")
    given_first = F.concat(given, space, first, space, second)
    given_last = F.concat(first, space, second, space, given)
    is_natural = F.upper(code) == fixed.NATURAL_PERSON_CODE
    return F.trim(F.when(is_natural, given_first).otherwise(given_last))


def role() -> Column:
    return F.lit(fixed.INSURED_ROLE)
