"""Sources and sinks."""

from tessera.sources.benchmark_tables import BENCHMARK_TABLES, BenchmarkTables
from tessera.sources.catalog import SourceCatalog, frames_from_rows
from tessera.sources.schemas import SOURCE_SCHEMAS, SOURCE_TABLES
from tessera.sources.sink import materialize, read_history, write_history, write_report

__all__ = [
    "BENCHMARK_TABLES", "BenchmarkTables", "SOURCE_SCHEMAS", "SOURCE_TABLES",
    "SourceCatalog", "frames_from_rows", "materialize", "read_history",
    "write_history", "write_report",
]
