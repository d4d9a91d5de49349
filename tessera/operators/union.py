"""Positional conforming and the history + live union.

The original report unions three branches positionally with the names
of the first (a materialised history table). We conform every branch to
one declared ``StructType`` by position - names and types - before a
plain ``union``, so no branch relies on implicit casts.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.dates import date_lit


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast and rename ``df``'s columns, by position, to ``schema``."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(
            f"branch has {len(df.columns)} columns, schema has {len(schema.fields)}")
    return df.selectExpr(*[
        f"CAST({_q(src)} AS {field.dataType.simpleString()}) AS {_q(field.name)}"
        for src, field in zip(df.columns, schema.fields)
    ])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def hybrid_union(
    history: DataFrame,
    live: Sequence[DataFrame],
    schema: StructType,
    cutoff: str | _dt.date,
    history_date_col: str,
) -> DataFrame:
    """History rows dated before ``cutoff`` followed by the live branches.

    The history filter is a typed date comparison on a plain column, so
    it is pushed into the Parquet scan (and prunes partitions when the
    history table is partitioned by that date's month). The live
    branches are expected to be restricted to ``>= cutoff`` (or NULL)
    already; NULL history dates are excluded by the comparison.
    """
    hist = history.where(F.col(history_date_col) < date_lit(cutoff))
    return union_all([conform(hist, schema)] + [conform(b, schema) for b in live])
