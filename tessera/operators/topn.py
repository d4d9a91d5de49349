"""Top-1 row per key (``ROW_NUMBER() OVER (...) = 1``).

NULL ordering follows the original report's server: NULL is the lowest
value, so ascending puts NULLs first and descending puts them last -
Spark's defaults. The original has no tie-break; we always append one so
results are deterministic.

Catalyst plans ``row_number() ... = 1`` with a partial
``WindowGroupLimit`` *before* the shuffle, so each map task forwards at
most one row per key: a key holding a third of the rows does not land
whole on one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators._util import as_col, as_list

_RN = "__rn"


def _sort_key(c: str | Column, ascending: bool) -> Column:
    col = as_col(c)
    return col.asc_nulls_first() if ascending else col.desc_nulls_last()


def latest_per_key(
    df: DataFrame,
    keys: str | Column | Sequence[str | Column],
    order: str | Column | Sequence[str | Column],
    tiebreak: str | Column | Sequence[str | Column] = (),
    ascending: bool = False,
) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` (descending by default).

    ``tiebreak`` columns are ordered in the same direction after ``order``.
    """
    order_cols = [_sort_key(c, ascending) for c in as_list(order)]
    order_cols += [_sort_key(c, ascending) for c in as_list(tiebreak)]
    w = Window.partitionBy(*[as_col(k) for k in as_list(keys)]).orderBy(*order_cols)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def first_per_key(df, keys, order, tiebreak=()):
    """Ascending variant of :func:`latest_per_key`."""
    return latest_per_key(df, keys, order, tiebreak, ascending=True)
