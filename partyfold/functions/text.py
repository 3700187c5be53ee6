"""Text helpers, Column in and Column out. All of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partyfold import fixed

TAB = "\t"


def clean_text(text: Column) -> Column:
    """Tabs become spaces, broken marks become the letter they stood for, ends are trimmed.

    Null stays null. Tabs at the ends disappear because they are spaces by the time of
    the trim. The replaced texts are plain, so no regular expression is needed.
    """
    no_tabs = F.replace(text, F.lit(TAB), F.lit(" "))
    repaired = F.replace(no_tabs, F.lit(fixed.BROKEN_MARK), F.lit(fixed.REPAIRED_LETTER))
    return F.trim(repaired)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def usable_key(key: Column) -> Column:
    """True for a key that is neither null nor made of spaces only (a tab does count)."""
    return key.isNotNull() & (F.trim(key) != "")
