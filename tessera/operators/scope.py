"""Scoping a table to the keys another table uses (semi-joins).

The original report restricts dimension reads to the keys of the tickets
(and of the no-show resets) before joining them. In Spark that is a
``left_semi`` join against a distinct key pool: the pool is deduplicated
with a partial + final aggregate before it is shuffled or broadcast, so
one hot key repeated in a third of the rows costs one pool row.

A scoped table is large and the pool keeps few of its rows, so most of what
the join would shuffle is thrown away. Spark can test a Bloom filter of the
pool's keys while it scans the table, before the shuffle, and does so by
itself where the scan is above
``spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold``
(10 GB) and the pool, a written table, below ``...creationSideThreshold``. It
takes only a side with a comparison for one that may be selective; so the
pool is given one that holds for every key. The exact semi-join follows
either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType

from tessera.operators._util import as_col

POOL_KEY = "__pool_key"


def key_pool(*sources: tuple[DataFrame, str | Column]) -> DataFrame:
    """Distinct non-NULL union of keys: ``SELECT k FROM a UNION SELECT k FROM b``.

    ``sources`` are ``(df, key)`` pairs; the key may be an expression
    (e.g. a prefixed id). Result has one column ``__pool_key``.
    """
    if not sources:
        raise ValueError("key_pool needs at least one source")
    parts = [df.select(as_col(k).alias(POOL_KEY)) for df, k in sources]
    pool = parts[0]
    for p in parts[1:]:
        pool = pool.unionAll(p)
    return pool.where(F.col(POOL_KEY).isNotNull()).distinct()


def _least(kind: DataType) -> str | int | None:
    """The least value of a key's type, for a comparison that holds for every key."""
    if isinstance(kind, StringType):
        return ""
    return -(1 << 63) if isinstance(kind, LongType) else None


def scope_by_keys(df: DataFrame, key: str | Column, pool: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``pool`` (``key IN (SELECT ...)``).

    ``pool`` is a one-column DataFrame such as :func:`key_pool` returns.
    A NULL key never matches.
    """
    pool_col = pool.columns[0]
    p = pool.select(F.col(pool_col).alias(POOL_KEY))
    least = _least(p.schema[POOL_KEY].dataType)
    if least is not None:
        p = p.where(F.col(POOL_KEY) >= F.lit(least))
    return df.join(p, as_col(key) == p[POOL_KEY], "left_semi")
