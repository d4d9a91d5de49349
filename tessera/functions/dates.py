"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_span_label(col: Column | str, days: int = 2) -> Column:
    """Label of a multi-day event starting at ``col``: ``'August 11-13 2026'``.

    Month and year are those of the start; a span that crosses a month
    reads ``'August 30-01 2026'``. NULL start gives NULL.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(
        F.date_format(c, "MMMM dd"),
        F.lit("-"),
        F.date_format(F.date_add(F.to_date(c), days), "dd"),
        F.lit(" "),
        F.date_format(c, "yyyy"),
    )


def date_lit(value: str | _dt.date) -> Column:
    """A typed DATE literal (never rely on implicit text -> date casts)."""
    d = _dt.date.fromisoformat(value) if isinstance(value, str) else value
    return F.lit(d)


def on_or_after(col: Column | str, cutoff: str | _dt.date) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c >= date_lit(cutoff)


def on_or_after_or_null(col: Column | str, cutoff: str | _dt.date) -> Column:
    """``col >= cutoff OR col IS NULL`` (keeps unscheduled rows)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= date_lit(cutoff)) | c.isNull()
