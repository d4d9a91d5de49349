"""Ordered text aggregation per key (``STRING_AGG``).

The original aggregates without ``WITHIN GROUP``, so its text order is
undefined; we always fix an order. ``listagg`` skips NULLs and yields
NULL when every value is NULL, like the original; a prefix is glued on
with a NULL-propagating ``concat`` so an all-NULL group stays NULL
(``concat_ws`` over ``collect_list`` would give the bare prefix).

Rows that are equal in key, order and value stand side by side in the text.
So they are counted first, with a partial + final aggregate, and a value's
copies are written when the text is put together (one copy for
``distinct=True``): what reaches one task per key is bounded by the number of
its distinct rows, not of its rows.

A key with very many distinct values is joined in two levels where
``segments`` is given: the rows are split and sorted by range of (key, order,
value), so that a hot key's rows lie in several tasks in order; runs of
``RUN_ROWS`` rows are joined first, so no task lists a whole segment, and one
task per key joins the runs in order. A text that would be longer than
``max_bytes`` is an error that names the size; without a bound from the
caller, that is a text that no cell of Spark can hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators._util import as_list, names, quote_ident, sql_string


# longest text of one key, in bytes of UTF-8, unless the caller says otherwise: what a cell can hold
MAX_TEXT_BYTES = (2 << 30) - 16
RUN_ROWS = 1024        # rows of a sorted segment that are joined at a time, as a power of two


def _order_sql(order: Sequence[str | tuple[str, bool]]) -> str:
    parts = []
    for o in order:
        name, asc = (o, True) if isinstance(o, str) else o
        parts.append(f"{quote_ident(name)} {'ASC NULLS FIRST' if asc else 'DESC NULLS LAST'}")
    return ", ".join(parts)


def ordered_listagg(value: str, sep: str, order: Sequence[str | tuple[str, bool]] | None = None) -> Column:
    """``listagg(value, sep) WITHIN GROUP (ORDER BY ...)`` as a Column."""
    order = list(order) if order else [value]
    return F.expr(
        f"listagg({quote_ident(value)}, {sql_string(sep)}) WITHIN GROUP (ORDER BY {_order_sql(order)})"
    )


def _bounded(text: Column, size: Column, max_bytes: int) -> Column:
    """``text``, or an error where ``size`` is above the bound."""
    message = F.concat(F.lit("joined text of "), size.cast("string"), F.lit(f" bytes: more than {max_bytes}"))
    return F.when(size > max_bytes, F.raise_error(message).cast("string")).otherwise(text)


def joined_text(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    sep: str,
    alias: str,
    order: Sequence[str | tuple[str, bool]] | None = None,
    distinct: bool = False,
    prefix: str | None = None,
    segments: int = 0,
    max_bytes: int = MAX_TEXT_BYTES,
) -> DataFrame:
    """One row per ``keys`` with the values of ``value`` joined by ``sep``.

    ``order`` lists the ordering columns (name, or (name, ascending)), rows
    that are equal there are ordered by the value; default is the value
    itself, as with ``distinct``. With ``prefix``, the result is ``prefix +
    text`` and NULL when all values are NULL.

    ``segments`` above 0 splits the rows by range into that many tasks first
    (for keys of very many distinct values; it costs a sample, a sort and a
    shuffle more). ``max_bytes`` bounds the text of a key.
    """
    key_names = names(as_list(keys))
    order = [] if distinct or not order else list(order)
    order_names = [o if isinstance(o, str) else o[0] for o in order]
    order = [*order, *([] if value in order_names else [value])]
    src = df.where(F.col(value).isNotNull()) if distinct else df
    grouped = list(dict.fromkeys([*key_names, *order_names, value]))
    src = src.groupBy(*[quote_ident(c) for c in grouped]).agg(F.count("*").alias("__copies"))
    copies = F.lit(1).cast("long") if distinct else F.col("__copies")
    own = F.col(quote_ident(value)).cast("string")
    size = F.when(own.isNotNull(), copies * F.octet_length(F.concat(own, F.lit(sep))))
    piece = F.when(own.isNotNull(), F.array_join(F.array_repeat(own, copies.cast("int")), sep))
    # checked before the copies are written
    src = src.withColumn("__bytes", size).withColumn("__text", _bounded(piece, F.col("__bytes"), max_bytes))
    text = ordered_listagg("__text", sep, order)
    if segments:
        by = [F.col(quote_ident(k)) for k in key_names]
        for o in order:
            name, ascending = (o, True) if isinstance(o, str) else o
            by.append(F.col(quote_ident(name)).asc_nulls_first() if ascending else F.col(quote_ident(name)).desc_nulls_last())
        # ids rise along the sorted rows of a segment, and from segment to segment
        dealt = (src.repartitionByRange(segments, *by).sortWithinPartitions(*by)
                 .withColumn("__run", F.shiftright(F.monotonically_increasing_id(), RUN_ROWS.bit_length() - 1)))
        src = dealt.groupBy(*key_names, "__run").agg(
            _bounded(text, F.sum("__bytes"), max_bytes).alias("__text"), F.sum("__bytes").alias("__bytes"))
        text = ordered_listagg("__text", sep, ["__run"])
    text = _bounded(text, F.sum("__bytes"), max_bytes)
    if prefix is not None:
        text = F.concat(F.lit(prefix), text)
    return src.groupBy(*key_names).agg(text.alias(alias))
