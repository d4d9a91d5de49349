"""tessera: a PySpark batch pipeline for a wide event-attendee report.

Layout
------
- ``tessera.functions``  Column -> Column helpers (recodes, text, dates, keys)
- ``tessera.operators``  DataFrame -> DataFrame building blocks (scoping,
  top-1 per key, ordered text aggregation, flag pivots, lookups, unions)
- ``tessera.sources``    table registry, declared schemas, readers and sinks
- ``tessera.plans``      the report's intermediate datasets, the report
  itself and the per-operator queries over the benchmark tables
- ``tessera.streaming``  intentionally empty (the report is a batch job)
"""

from tessera.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
