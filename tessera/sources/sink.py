"""Writing the report, its history table and staged relations.

The history table (Part A of the report) is read with ``date < cutoff``. It
is a folder of *rolls*: each holds the rows of one date interval
``[start, end)``, split by month, so that folders after a cutoff are never
scanned. A ledger says which rolls make up the history
(:mod:`tessera.sources.ledger`): a roll counts from the moment its ledger
version is published, and intervals neither overlap nor leave gaps. Writes go
through Spark's commit protocol, so a lost executor re-runs its tasks.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir
from tessera.sources.files import SharedFiles
from tessera.sources.ledger import HistoryLedger, Roll, as_date

MONTH_COL = "report_month"


def write_history(df: DataFrame, path: str, date_col: str, roll: str | _dt.date,
                  start: str | _dt.date | None = None) -> None:
    """Write the rows of ``[start, roll)`` as a roll of the history at ``path``.

    ``start`` defaults to the end of the history so far (with none, the roll
    is open to the past). A roll must begin where the history ends: another
    ``start`` would leave a gap or hold rows twice, and is refused, as is a row
    dated before ``start``. The one exception is a roll of the same interval,
    which is replaced, so a job that runs twice leaves the same history. Rows
    dated on or after ``roll`` are not written, rows without a date are.

    A folder without a ledger that holds plain Parquet files, or rolls of an
    older layout, is adopted first (:meth:`HistoryLedger.adopt`).
    """
    spark = df.sparkSession
    ledger = HistoryLedger.open(spark, path, date_col, start=start)
    end = as_date(roll)
    start = as_date(start) if start is not None else ledger.start_of(end)
    ledger.check(start, end)
    when = F.col(f"`{date_col}`")
    if start is not None:
        early = F.concat(F.lit(f"history roll from {start}: a row is dated "), when.cast("string"))
        df = df.withColumn(date_col, F.when(when < F.lit(start), F.raise_error(early)).otherwise(when))
    folder = f"roll={end}-{uuid.uuid4().hex[:12]}"
    rows = df.where(when.isNull() | (when < F.lit(end)))
    (rows.withColumn(MONTH_COL, F.date_format(when, "yyyy-MM"))
         .write.partitionBy(MONTH_COL).parquet(f"{path.rstrip('/')}/{folder}"))
    ledger.publish(Roll(folder, start, end, df.schema.json()))


def _months_before(df: DataFrame, before: _dt.date | None) -> DataFrame:
    """Spark prunes partitions only on predicates over the partition column: state the month bound."""
    if before is None or MONTH_COL not in df.columns:
        return df
    return df.where(F.col(MONTH_COL) <= F.lit(before.strftime("%Y-%m")))


def read_history(spark: SparkSession, path: str, before: str | _dt.date | None = None,
                 date_col: str | None = None, allow_gap: bool = False) -> DataFrame:
    """Read a history folder: one of :func:`write_history`, or any plain Parquet folder.

    With ``before`` (the report's cutoff), only rolls that begin before it and
    their month folders up to the cutoff's month are read; the exact ``date <
    cutoff`` filter is the report's. A history that ends before ``before``
    would leave out the rows in between, which is an error unless
    ``allow_gap``. A missing folder is an error.

    A folder without a ledger that holds both plain files and rolls of the
    older layout is read as the rolls that :meth:`HistoryLedger.adopt` makes
    of it; this needs the ``date_col``.
    """
    root = path.rstrip("/")
    before = as_date(before) if before is not None else None
    ledger = HistoryLedger.open(spark, path, date_col)
    if ledger.is_plain:
        return _months_before(spark.read.parquet(path), before).drop(MONTH_COL)
    if before is not None and not allow_gap and ledger.end is not None and ledger.end < before:
        raise ValueError(f"the history at {path} ends before {ledger.end}, the live rows begin on {before}: "
                         "rows between would be missing")
    parts: list[DataFrame] = []
    written: dict[str, list[Roll]] = {}
    for roll in ledger.rolls:
        if before is not None and roll.start is not None and roll.start >= before:
            continue
        if roll.schema is None:
            df = _months_before(ledger.adopted_rows(roll), before)
            parts.append(roll.within(df, ledger.date_col).drop(MONTH_COL, "rolled_to"))
        else:
            written.setdefault(roll.schema, []).append(roll)
    for schema, rolls in written.items():
        df = (spark.read.option("basePath", path).schema(rolls[0].struct)
              .parquet(*[f"{root}/{r.folder}" for r in rolls]))
        parts.append(_months_before(df, before).drop(MONTH_COL, "roll"))
    if not parts:  # nothing begins before the cutoff: no rows, same columns
        return spark.createDataFrame([], ledger.rolls[-1].struct)
    return reduce(DataFrame.union, parts)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` under the session's shared checkpoint folder.

    Uses the folder named by ``spark.checkpoint.dir``; raises if the
    session has none (never a machine-local temp folder).
    """
    path = staged_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path  # for remove_staged
    return out


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path under the session's shared checkpoint folder."""
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; cannot materialize")
    return f"{root.rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession, path: str) -> None:
    """Remove a table that :func:`materialize` wrote."""
    root, _, name = path.rpartition("/")
    SharedFiles(spark, root).remove(name)
