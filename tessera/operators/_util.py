from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_list(x: str | Column | Sequence[str | Column] | None) -> list:
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def as_col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def quote_ident(name: str) -> str:
    """Backtick-quote a column name for use inside a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A SQL string literal (single quotes doubled, backslashes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def names(cols: Iterable[str | Column]) -> list[str]:
    out = []
    for c in cols:
        if not isinstance(c, str):
            raise TypeError("this operator takes column names, not expressions")
        out.append(c)
    return out
