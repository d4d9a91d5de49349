"""Flag pivots and presence flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators._util import as_col, as_list


def flag_pivot(
    df: DataFrame,
    keys: str | Sequence[str],
    text: str | Column,
    flags: Sequence[tuple[str, str | Column]],
    value: str = "Yes",
) -> DataFrame:
    """``MAX(CASE WHEN text LIKE '%p%' THEN 'Yes' END)`` per flag, per key.

    ``flags`` is ``[(output column, pattern or boolean Column), ...]``.
    One hash aggregate with map-side partial aggregation: a hot key is
    reduced to one row per map task before the shuffle.
    """
    t = as_col(text)
    aggs = []
    for out, cond in flags:
        c = t.contains(cond) if isinstance(cond, str) else cond
        aggs.append(F.max(F.when(c, F.lit(value))).alias(out))
    return df.groupBy(*as_list(keys)).agg(*aggs)


def presence_flag(
    df: DataFrame,
    keys_df: DataFrame,
    on: str,
    name: str,
    keys_on: str | None = None,
) -> DataFrame:
    """Add boolean ``name``: does ``df[on]`` occur in ``keys_df[keys_on]``?

    Equivalent to ``LEFT JOIN (SELECT DISTINCT k ...) x ON ... `` followed
    by ``x.k IS NOT NULL``; the key list is deduplicated before the join
    so the left side never fans out.
    """
    k = keys_on or on
    marker = f"__has_{name}"
    distinct_keys = (keys_df.select(F.col(k).alias(on)).where(F.col(on).isNotNull())
                     .distinct().withColumn(marker, F.lit(True)))
    return (df.join(distinct_keys, on, "left")
              .withColumn(name, F.coalesce(F.col(marker), F.lit(False)))
              .drop(marker))
