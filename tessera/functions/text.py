"""Text predicates and derivations used by the report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The original server compares strings with trailing-blank padding, so
# `x = ''` holds for any all-blank value; the blank tests below follow that.

def is_blank(col: Column | str) -> Column:
    """``col IS NULL OR col = ''`` (an all-blank value counts as blank)."""
    return F.coalesce(F.rtrim(_c(col)), F.lit("")) == F.lit("")


def not_blank(col: Column | str) -> Column:
    """``col IS NOT NULL AND col != ''`` (the ``!=`` alone already rejects NULL)."""
    return F.rtrim(_c(col)) != F.lit("")


def blank_to_null(col: Column | str) -> Column:
    """``NULLIF(col, '')``: NULL for blank values, else the value unchanged."""
    c = _c(col)
    return F.when(F.rtrim(c) == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def first_nonblank(*cols: Column | str) -> Column:
    """``COALESCE(NULLIF(a, ''), NULLIF(b, ''), ..., last)``.

    Every column but the last is blank-to-NULL'ed; the last is taken as is.
    """
    if not cols:
        raise ValueError("first_nonblank needs at least one column")
    parts = [blank_to_null(c) for c in cols[:-1]] + [_c(cols[-1])]
    return F.coalesce(*parts)


def classify_like(col: Column | str, classes: Sequence[tuple[str, str]]) -> Column:
    """Ordered classification: the label of the first pattern ``col`` contains.

    ``classes`` is ``[(pattern, label), ...]``; no match gives NULL.
    """
    c = _c(col)
    out = None
    for pattern, label in classes:
        out = (F.when(c.contains(pattern), F.lit(label)) if out is None
               else out.when(c.contains(pattern), F.lit(label)))
    return out if out is not None else F.lit(None).cast("string")


def split_first_word(col: Column | str) -> tuple[Column, Column]:
    """Split a full name at its first blank: ``(first word, rest)``.

    ``first``: text before the first blank (the whole text if none).
    ``rest``: text after the first blank, ``''`` for a single word. Its
    length is capped at the length of the text without trailing blanks,
    the rule of the original report's length function.
    """
    c = _c(col)
    first = F.substring_index(c, " ", 1)
    pos = F.instr(F.concat(c, F.lit(" ")), " ")
    rest = c.substr(pos + F.lit(1), F.length(F.rtrim(c)))
    return first, rest


def yes_no(condition: Column) -> Column:
    """``'Yes'`` when the condition is true, otherwise (false or NULL) ``'No'``."""
    return F.when(condition, F.lit("Yes")).otherwise(F.lit("No"))


def yes_or_null(condition: Column) -> Column:
    """``'Yes'`` when the condition is true, otherwise NULL."""
    return F.when(condition, F.lit("Yes"))
