"""Several projections of one relation, joined by its key, from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators._util import as_col, quote_ident

# a projection's columns, and whether its rows are taken once each
Projection = tuple[Sequence[str | Column], bool]


def joined_projections(df: DataFrame, key: str, keep: Sequence[str], projections: Sequence[Projection]) -> DataFrame:
    """``SELECT key, keep FROM df`` left-joined on ``key`` with each projection of ``df`` itself.

    The plain form scans and shuffles ``df`` once for itself and once for
    each projection. As all sides are rows of the same key, one scan does:
    rows that are equal in all columns concerned are counted, a key's distinct
    rows are put together, and each side is read from them and expanded
    again. Rows without a key keep their place, with NULLs from the
    projections, as NULL matches nothing in a join.

    One task holds the distinct rows of a key, of which the joins return at
    least the product with themselves.
    """
    sides = [([F.col(quote_ident(c)) for c in keep], False), *projections]
    named = [[as_col(c).alias(f"__{n}_{k}") for k, c in enumerate(columns)] for n, (columns, _) in enumerate(sides)]
    flat = df.select(F.col(quote_ident(key)).alias("__key"), *[c for columns in named for c in columns])
    names = [df.select(*[as_col(c) for c in columns]).columns for columns, _ in sides]
    counted = flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("__copies"))
    out = counted.groupBy("__key").agg(F.collect_list(F.struct(*[c for c in counted.columns if c != "__key"])).alias("__rows"))
    for n, (columns, once) in enumerate(sides):
        own = [f"__{n}_{k}" for k in range(len(columns))]

        def fields(row: Column, own=own) -> list[Column]:
            return [row[f].alias(f) for f in own]

        if once:
            rows = F.array_distinct(F.transform(F.col("__rows"), lambda r: F.struct(*fields(r))))
        else:
            rows = F.flatten(F.transform(F.col("__rows"), lambda r: F.array_repeat(
                F.struct(*fields(r)), r["__copies"].cast("int"))))
        if n:  # nothing matches a missing key
            rows = F.when(F.col("__key").isNotNull(), rows)
        out = out.withColumn(f"__side_{n}", F.explode_outer(rows))
    return out.select(F.col("__key").alias(key), *[F.col(f"__side_{n}").getField(f"__{n}_{k}").alias(name)
                                                   for n, side in enumerate(names) for k, name in enumerate(side)])
