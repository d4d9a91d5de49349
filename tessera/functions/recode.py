"""Recodes by table: ``CASE x WHEN a THEN b ... ELSE x | NULL END``.

Two traps are handled here:

- codes that must become NULL are tested by *membership*, not by looking
  up a value and coalescing it (that brings the raw code back);
- unknown codes either pass through (``default="pass"``) or become NULL
  (``default="null"``).

The mapping is a literal map, so the lookup is one codegen'd expression,
evaluated JVM-side in the scan's stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pairs(mapping: Mapping[str, str] | Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    seen: dict[str, str] = {}
    for k, v in items:
        seen.setdefault(k, v)        # first WHEN wins, as in a CASE
    return list(seen.items())


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: Iterable[tuple[str, str]]) -> Column:
    """A ``map(k1, v1, ...)`` literal built in one expression."""
    body = ", ".join(f"{_sql_text(k)}, {_sql_text(v)}" for k, v in pairs)
    return F.expr(f"map({body})")


def recode(
    col: Column | str,
    mapping: Mapping[str, str] | Iterable[tuple[str, str]],
    null_codes: Iterable[str] = (),
    default: str = "pass",
    collated: bool = False,
) -> Column:
    """Map ``col`` through ``mapping``.

    ``null_codes`` are codes whose result is NULL; ``default`` is
    ``"pass"`` (unknown -> the input) or ``"null"`` (unknown -> NULL). With
    ``collated``, codes are compared under the collation of ``col`` (a map
    takes plain strings only); the result is a plain string either way.
    """
    if default not in ("pass", "null"):
        raise ValueError("default must be 'pass' or 'null'")
    c = F.col(col) if isinstance(col, str) else col
    pairs = _pairs(mapping)
    nulls = [k for k in null_codes if k not in dict(pairs)]
    fallback = c if default == "pass" else F.lit(None).cast("string")
    if collated:
        fallback = fallback.cast("string")
    if not pairs:
        out = fallback
    elif collated:
        out = F.when(c == pairs[0][0], F.lit(pairs[0][1]))
        for code, text in pairs[1:]:
            out = out.when(c == code, F.lit(text))
        out = out.otherwise(fallback)
    else:
        lookup = literal_map(pairs)
        out = F.when(F.map_contains_key(lookup, c), F.try_element_at(lookup, c)).otherwise(fallback)
    if nulls:
        out = F.when(c.isin(*nulls), F.lit(None).cast("string")).otherwise(out)
    return out
