"""Materializing relations that several steps of the report read.

The report is a DAG: the live drivers, the scoped dimensions, the ticket's
history and flags and the key profiles each have several readers. Left
inline, every reader embeds (and re-executes) the whole sub-plan. A *stage*
is computed once, when the plan that needs it is built:

- ``table``: written as Parquet to the shared folder named by
  ``spark.checkpoint.dir`` and read back. The lineage is cut, so a lost
  executor costs only its running tasks, later plans stay small, and each
  reader still prunes columns;
- ``persist``: cached in executor memory, spilling to local disk; lost
  blocks are recomputed from lineage (lazy: filled by the first reader);
- ``none``: inline, nothing runs before an action on the report.

``auto`` writes tables when the session names a checkpoint folder and
persists otherwise (a machine-local folder is never chosen here).

Written stages that do not read each other are submitted together
(:func:`run_stages`), and Spark shares the executors between their jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tessera.session import checkpoint_dir
from tessera.sources.sink import materialize, remove_staged

MODES = ("auto", "table", "persist", "none")


@dataclass(frozen=True)
class Staged:
    """A relation that holds storage until it is released."""

    name: str
    df: DataFrame

    def release(self) -> None:
        path = getattr(self.df, "staged_path", None)
        if path is None:
            self.df.unpersist()
        else:
            remove_staged(self.df.sparkSession, path)


def resolve_mode(spark: SparkSession, mode: str) -> str:
    """``mode`` with ``auto`` decided."""
    if mode not in MODES:
        raise ValueError(f"materialize mode must be one of {MODES}")
    if mode == "auto":
        return "table" if checkpoint_dir(spark) else "persist"
    return mode


def stage(df: DataFrame, mode: str = "auto", kept: list[Staged] | None = None, name: str = "stage") -> DataFrame:
    """Return ``df`` materialized according to ``mode``; what holds storage is added to ``kept``."""
    mode = resolve_mode(df.sparkSession, mode)
    if mode == "none":
        return df
    out = (materialize(df.sparkSession, df, name) if mode == "table"
           else df.persist(StorageLevel.MEMORY_AND_DISK))
    if kept is not None:
        kept.append(Staged(name, out))
    return out


def run_stages(stages: Mapping[str, tuple[Callable[[], object], Sequence[str]]],
               done: Callable[[str], None] = lambda name: None) -> None:
    """Run each stage as soon as those it reads have run; ``done(name)`` follows each.

    ``stages`` maps a name to what makes it and to the names it reads, which
    stand before it. A failed stage fails those that read it, and the call.
    """
    def after(read: list[Future], make: Callable[[], object], name: str) -> None:
        for other in read:
            other.result()
        make()
        done(name)

    futures: dict[str, Future] = {}
    with ThreadPoolExecutor(max(1, len(stages))) as pool:
        for name, (make, reads) in stages.items():
            futures[name] = pool.submit(after, [futures[r] for r in reads if r in stages], make, name)
        for future in futures.values():
            future.result()
