"""Source registry: table name -> DataFrame.

The original report addresses 22 tables in seven databases by
three-part names. Here every source is a DataFrame in one session;
a :class:`SourceCatalog` resolves names from a Parquet folder, from
catalog tables, or from DataFrames handed in (tests).

Reads always project to the declared columns, so Parquet scans carry a
pruned ``ReadSchema`` and filters written downstream are pushed into
them.
"""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import normalize_key
from tessera.sources.schemas import KEY_COLUMNS, PATTERN_COLUMNS, SOURCE_SCHEMAS


class SourceCatalog:
    """Resolves source names to DataFrames.

    - ``frames``: explicit DataFrames by name (take precedence)
    - ``parquet_root``: ``<root>/<name>`` or ``<root>/<name>.parquet``
    - ``table_prefix``: ``spark.table(prefix + name)``
    - ``locations``: a place of its own for single sources (before the two
      above): a path, if it holds a ``/``, else a catalog table

    A source that is not there raises ``KeyError``; one that is there and
    cannot be read raises Spark's error. The stored report history (Part A)
    is ``history`` if given, else the source named ``history_table``.
    ``key_mode`` is the comparison rule of keys, codes and status values
    (:func:`tessera.functions.normalize_key`), applied by :meth:`table`.
    """

    def __init__(
        self,
        spark: SparkSession,
        frames: Mapping[str, DataFrame] | None = None,
        parquet_root: str | None = None,
        table_prefix: str | None = None,
        history: DataFrame | None = None,
        history_table: str = "report_history",
        key_mode: str = "binary",
        locations: Mapping[str, str] | None = None,
    ) -> None:
        self.key_mode = key_mode
        self.locations = dict(locations or {})
        self.spark = spark
        self.frames = dict(frames or {})
        self.parquet_root = parquet_root
        self.table_prefix = table_prefix
        self._history = history
        self.history_table = history_table
        self._resolved: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name in self.frames:
            return self.frames[name]
        if name in self._resolved:
            return self._resolved[name]
        df = None
        if name in self.locations:
            place = self.locations[name]
            # named explicitly: a place that is not there is an error
            df = self.spark.read.parquet(place) if "/" in place else self.spark.table(place)
        elif self.parquet_root:
            root = self.parquet_root.rstrip("/")
            for cand in (f"{root}/{name}", f"{root}/{name}.parquet"):
                try:
                    # resolved by Spark's filesystem layer, not the driver's local disk
                    df = self.spark.read.parquet(cand)
                    break
                except AnalysisException as missing:
                    if missing.getCondition() != "PATH_NOT_FOUND":
                        raise
        if df is None and self.table_prefix is not None:
            try:
                df = self.spark.table(self.table_prefix + name)
            except AnalysisException as missing:
                if missing.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                    raise
        if df is None:
            raise KeyError(f"no source for table {name!r}")
        self._resolved[name] = df
        return df

    def table(self, name: str) -> DataFrame:
        """The table projected and cast to its declared schema."""
        df = self.raw(name)
        schema = SOURCE_SCHEMAS.get(name)
        if schema is None:
            return df
        keys = KEY_COLUMNS.get(name, ())
        if self.key_mode == "ci_rtrim":  # case does not count in LIKE, either
            keys = (*keys, *PATTERN_COLUMNS.get(name, ()))
        return df.select(*[
            (normalize_key(F.col(f"`{f.name}`").cast(f.dataType), self.key_mode) if f.name in keys
             else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name) for f in schema.fields])

    def with_key_mode(self, mode: str) -> "SourceCatalog":
        """The same sources under another comparison rule."""
        out = copy(self)
        out.key_mode = mode
        return out

    def has(self, name: str) -> bool:
        try:
            self.raw(name)
            return True
        except KeyError:
            return False

    def history(self) -> DataFrame | None:
        """The materialised report history (Part A), if any."""
        if self._history is not None:
            return self._history
        return self.raw(self.history_table) if self.has(self.history_table) else None


def frames_from_rows(
    spark: SparkSession,
    rows_by_table: Mapping[str, list[tuple]],
    schemas: Mapping[str, object] = SOURCE_SCHEMAS,
) -> dict[str, DataFrame]:
    """Build typed DataFrames from small row lists (fixtures)."""
    return {name: spark.createDataFrame(rows, schemas[name]) for name, rows in rows_by_table.items()}

