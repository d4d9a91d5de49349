"""Dimension lookups (left joins) on keys that are often missing, hot, or not unique.

No broadcast hint is given for a dimension: adaptive execution measures the
shuffled dimension at runtime and turns the join into a broadcast hash join
only when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above
it the sort-merge join stays, with skewed partitions split.

Skew does not wait for that. Missing keys (NULL, blank) are always spread
over the partitions. Other hot values are found by a frequency sketch
(:func:`hot_keys`, one pass over the key columns) and spread, too; only their
dimension rows are repeated.

A key that occurs twice in a dimension multiplies rows. :func:`lookup` either
refuses such keys while the join runs, or counts the rows before and after
the join; neither reads the dimension again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.functions.keys import is_collated
from tessera.operators._util import quote_ident

SPREAD = "__spread_key"
_DIM_KEY = "__dim_key"
_SALTS = "__salts"

# a value is hot if it alone has this share of a partition's even part of the rows ...
HOT_SHARE = 0.5
# ... and is dealt out in pieces of this part of it, so that no partition gets much more than another
PIECES = 8
# most items that a sketch keeps (the limit of Spark's sketch)
_MOST_TRACKED = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """Hot values of one column, each with the number of salts that it is dealt to."""

    values: tuple[tuple[object, int], ...]
    row_type: StructType

    def table(self, df: DataFrame) -> DataFrame:
        """As a relation; of bounded size, as at most ``partitions / HOT_SHARE`` values can be hot."""
        return df.sparkSession.createDataFrame([tuple(v) for v in self.values], self.row_type)


def hot_keys(df: DataFrame, *columns: str, partitions: int | None = None) -> dict[str, HotKeys]:
    """The hot values of each column, from one pass over ``df`` (a frequent-items sketch per column).

    ``partitions`` is the shuffle's (default: the session's setting). A value
    counts as hot from ``HOT_SHARE`` of an even partition's rows. The sketch
    tracks so many items that its error (3.5 rows in as many as it tracks) is
    below half of that. NULL is never hot: it has its own spread.
    """
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = math.ceil(partitions / HOT_SHARE)
    tracked = min(_MOST_TRACKED, max(1000, 8 * most))
    wanted = min(most, tracked)
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.expr(f"approx_top_k({quote_ident(c)}, {wanted}, {tracked})").alias(f"top{k}")
                   for k, c in enumerate(columns)]).first()
    found = {}
    for k, c in enumerate(columns):
        share = [(item["item"], item["count"] / row["rows"]) for item in row[f"top{k}"] or []]
        values = tuple((value, math.ceil(part * partitions * PIECES)) for value, part in share
                       if value is not None and part * partitions > HOT_SHARE)
        fields = [StructField(_DIM_KEY, df.schema[c].dataType), StructField(_SALTS, IntegerType())]
        found[c] = HotKeys(values, StructType(fields))
    return found


def duplicate_keys(dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``count`` (they multiply the rows of a lookup)."""
    keys = [on] if isinstance(on, str) else list(on)
    return dim.groupBy(*keys).count().where(F.col("count") > 1)


def left_join_spread(df: DataFrame, dim: DataFrame, key: str, spread_by: str | Column,
                     dim_key: str | None = None, buckets: int | None = None,
                     hot: HotKeys | None = None) -> DataFrame:
    """``df LEFT JOIN dim ON key = dim_key`` with NULL, blank and hot keys spread over partitions.

    A NULL key never matches and a blank one matches at most the dimension's
    blank rows, but each would hash to one shuffle partition, as a hot value
    would. The join adds a second key. For NULL and ``''`` keys of ``df`` it is
    one of ``buckets`` names drawn by ``spread_by``, for the values of ``hot``
    one of as many names as the value has salts, else the key itself; the
    dimension's blank and hot rows are repeated for each name. It is computed
    from a column on both sides, so the optimizer cannot fold it away, and it
    partitions the shuffle. Rows and matches are unchanged, as the plain key
    equality stays in the condition.

    ``dim_key`` (default: ``key``) does not appear in the result. ``buckets``
    defaults to the session's shuffle partition count.
    """
    dim_key = dim_key or key
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.col(spread_by) if isinstance(spread_by, str) else spread_by
    bucket = F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("string")
    kind = df.schema[key].dataType
    text = isinstance(kind, StringType)

    def named(column: Column) -> Column:
        # equal values of a collated key may be spelled differently: only the key itself tells them apart
        return F.lit("") if is_collated(kind) else column.cast("string")

    own = F.when(F.col(key).isNull(), F.concat(F.lit("null-"), bucket))
    if text:
        own = own.when(F.col(key) == "", F.concat(F.lit("blank-"), bucket))
    other = dim.withColumnRenamed(dim_key, _DIM_KEY).where(F.col(_DIM_KEY).isNotNull())
    names = F.array(named(F.col(_DIM_KEY)))
    columns = df.columns
    if hot is not None and hot.values:
        listed = F.broadcast(hot.table(df))
        df = df.join(listed.withColumnRenamed(_DIM_KEY, "__hot"), F.col(key) == F.col("__hot"), "left").drop("__hot")
        salt = F.pmod(F.xxhash64(spread), F.col(_SALTS)).cast("string")
        own = own.when(F.col(_SALTS).isNotNull(), F.concat(F.lit("hot-"), salt, F.lit("-"), named(F.col(key))))
        other = other.join(listed.withColumnRenamed(_DIM_KEY, "__hot"), F.col(_DIM_KEY) == F.col("__hot"), "left").drop("__hot")
        salted = F.transform(F.sequence(F.lit(0), F.col(_SALTS) - 1),
                             lambda i: F.concat(F.lit("hot-"), i.cast("string"), F.lit("-"), named(F.col(_DIM_KEY))))
        names = F.when(F.col(_SALTS).isNotNull(), salted).otherwise(names)
    left = df.select(*[F.col(quote_ident(c)) for c in columns],
                     own.otherwise(named(F.col(key))).alias(SPREAD))
    if text:
        blank = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)),
                            lambda i: F.concat(F.lit("blank-"), i.cast("string")))
        names = F.when(F.col(_DIM_KEY) == "", blank).otherwise(names)
    right = other.withColumn(SPREAD, F.explode(names)).drop(_SALTS)
    return (left.join(right, (left[SPREAD] == right[SPREAD]) & (left[key] == right[_DIM_KEY]), "left")
                .drop(left[SPREAD]).drop(right[SPREAD]).drop(_DIM_KEY))


class LookupCounts:
    """Rows before and after lookups, counted while the query that holds them runs.

    Each lookup that is given a ``LookupCounts`` is watched by Spark's
    observed metrics, in the first action that runs it; its tasks count what
    passes, so nothing is read for it.
    """

    def __init__(self) -> None:
        self._watched: dict[str, tuple[Observation, Observation]] = {}

    def before(self, name: str, df: DataFrame) -> DataFrame:
        if name in self._watched:
            raise ValueError(f"lookup {name!r} is counted already")
        self._watched[name] = (Observation(), Observation())
        return self._observe(df, self._watched[name][0])

    def after(self, name: str, df: DataFrame) -> DataFrame:
        return self._observe(df, self._watched[name][1])

    @staticmethod
    def _observe(df: DataFrame, observation: Observation) -> DataFrame:
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, tuple[int, int]]:
        """Rows before and after each lookup; waits until the queries that hold them have run."""
        return {name: (before.get["rows"], after.get["rows"]) for name, (before, after) in self._watched.items()}

    def multiplied(self) -> dict[str, int]:
        """Rows that keys with several dimension rows added, by lookup; lookups that added none are left out."""
        return {name: after - before for name, (before, after) in self.rows().items() if after > before}


def unique_rows(dim: DataFrame, key: str, name: str) -> DataFrame:
    """``dim`` without its NULL keys, failing the query at a key that has several rows.

    Rows are counted per key with a partial and a final aggregate, by the key
    that a join shuffles by anyway: the dimension is read and shuffled once,
    and a key repeated a million times is reduced in the tasks that read it.
    """
    rest = [c for c in dim.columns if c != key]
    counted = dim.where(F.col(quote_ident(key)).isNotNull()).groupBy(quote_ident(key)).agg(
        F.count(F.lit(1)).alias("__rows"), F.first(F.struct(F.lit(0).alias("__"), *[F.col(quote_ident(c)) for c in rest])).alias("__row"))
    twice = F.concat(F.lit(f"lookup {name}: key "), F.col(quote_ident(key)).cast("string"),
                     F.lit(" has "), F.col("__rows").cast("string"), F.lit(" rows"))
    # a condition, not a column: it is checked whichever columns are read
    sound = counted.where(F.when(F.col("__rows") > 1, F.raise_error(twice).cast("boolean")).otherwise(F.lit(True)))
    return sound.select(*[F.col(quote_ident(c)) if c == key else F.col("__row").getField(c).alias(c) for c in dim.columns])


def lookup(df: DataFrame, dim: DataFrame, on: str, cols: Sequence[str] | None = None, unique: bool = True,
           dim_on: str | None = None, spread_by: str | Column | None = None, name: str | None = None,
           counts: LookupCounts | None = None, hot: HotKeys | None = None) -> DataFrame:
    """``df`` with the columns ``cols`` (default: all) of the ``dim`` row of its key; all rows stay.

    ``on`` is the key in ``df``, ``dim_on`` (default: the same) in ``dim``;
    the latter is not in the result. A missing key gives NULLs.

    ``unique``: a key with several rows in ``dim``, looked up or not, fails
    the query with an error that names the ``name`` of the lookup and the key
    (a query that reads no column of ``dim`` leaves out the whole lookup).
    Otherwise such a key multiplies rows, and ``counts`` tells by how many.
    ``spread_by`` and ``hot`` spread missing and hot keys
    (:func:`left_join_spread`).
    """
    dim_on = dim_on or on
    name = name or dim_on
    if cols is not None:
        dim = dim.select(*dict.fromkeys([dim_on, *cols]))
    if unique:
        dim = unique_rows(dim, dim_on, name)
    if counts is not None:
        df = counts.before(name, df)
    if spread_by is not None:
        out = left_join_spread(df, dim, on, spread_by, dim_key=dim_on, hot=hot)
    else:
        other = dim.withColumnRenamed(dim_on, _DIM_KEY)
        out = df.join(other, F.col(quote_ident(on)) == F.col(_DIM_KEY), "left").drop(_DIM_KEY)
    return counts.after(name, out) if counts is not None else out
