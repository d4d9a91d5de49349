"""Join-key normalisation.

The original report compares keys under a binary collation and relies on
its server's rule that trailing blanks do not count in ``=``. Spark's
default ``UTF8_BINARY`` equality is already binary; trailing blanks do
count. ``normalize_key`` picks the rule once, at the source, so every
downstream join uses a plain hash-joinable string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

KEY_MODES = ("binary", "binary_rtrim", "lcase", "ci_rtrim")
# the comparison of a server whose default collation ignores case (and trailing blanks)
CI_COLLATION = "UTF8_LCASE_RTRIM"


def normalize_key(col: Column | str, mode: str = "binary") -> Column:
    """Return the key under one comparison rule.

    - ``binary``: unchanged (byte-wise equality)
    - ``binary_rtrim``: trailing blanks removed (blank-padded equality)
    - ``lcase``: lower-cased (case-folded equality)
    - ``ci_rtrim``: a string of Spark's collation ``UTF8_LCASE_RTRIM``, whose
      value is unchanged; joins, ``GROUP BY``, ``PARTITION BY``, ``DISTINCT``,
      equality and substring tests on it ignore case and trailing blanks
    """
    c = F.col(col) if isinstance(col, str) else col
    if mode == "binary":
        return c
    if mode == "binary_rtrim":
        return F.rtrim(c)
    if mode == "lcase":
        return F.lower(c)
    if mode == "ci_rtrim":
        return F.collate(c, CI_COLLATION)
    raise ValueError(f"unknown key mode {mode!r}; expected one of {KEY_MODES}")


def padded_key(col: Column | str, width: int, pad: str = "0") -> Column:
    """``col`` as text, padded on the left to ``width``; longer keys stay whole (``lpad`` would cut them)."""
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def prefixed_key(prefix: str, col: Column | str) -> Column:
    """``prefix + col`` as a join key (NULL stays NULL, so it never matches)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit(prefix), c)


def concat_text(*cols: Column | str) -> Column:
    """``CONCAT(a, b, ...)``: NULL parts count as empty text (never NULL)."""
    return F.concat_ws("", *[F.col(c) if isinstance(c, str) else c for c in cols])


def is_collated(kind: DataType) -> bool:
    """Is it a string type that is not compared byte by byte?"""
    return isinstance(kind, StringType) and kind.collation != "UTF8_BINARY"
