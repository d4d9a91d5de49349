"""Integer vectors, as the vector operators read them from a table of embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
# largest component, scaled: beyond it (scaled) scores of some thousand components could pass 64 bits
LARGEST = 1 << 20


def integer_vectors(df: DataFrame, columns: dict[str, str], vector_col: str) -> tuple[DataFrame, int, int]:
    """The ``columns`` and the vectors ``v`` (``floor(256 * x)``, longs) of the usable rows, their length,
    and a bound of their absolute components.

    Rows whose vector is null, empty, or holds a null or non-finite component
    are not usable. A table has vectors of one length: that of most rows (the
    greater one in a tie); rows of another length are not usable, either. A
    table without usable rows has the length 0. Components of 4096 and more
    raise an error, as sums of their products could pass 64 bits.
    """
    v = F.col(f"`{vector_col}`")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(usable)
    lengths = (rows.groupBy(F.size(v).alias("length"))
               .agg(F.count("*").alias("n"),
                    F.max(F.array_max(F.transform(v, lambda x: F.abs(x).cast("double")))).alias("most"))
               .orderBy(F.desc("n"), F.desc("length")).limit(1).collect())
    length, most = (lengths[0]["length"], lengths[0]["most"]) if lengths else (0, 0.0)
    if most * SCALE >= LARGEST:
        raise ValueError(f"a component of {most} is too large for exact integer scores")
    return rows.where(F.size(v) == length).select(
        *[F.col(f"`{given}`").alias(own) for own, given in columns.items()],
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE)).alias("v")), length, int(most * SCALE) + 1


def matrix(batch: pa.RecordBatch | pa.Table, column: str, width: int, dtype=np.int64) -> np.ndarray:
    """A column of equally long lists as a matrix of ``width`` columns."""
    col = batch.column(batch.schema.get_field_index(column))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width).astype(dtype, copy=False)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A matrix as a column of lists."""
    flat = pa.array(np.ascontiguousarray(rows).reshape(-1), type=kind)
    ends = np.arange(rows.shape[0] + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), flat)
