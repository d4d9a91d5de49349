from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    scratch = tempfile.mkdtemp(prefix="tessera-tests-")
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra_conf={"spark.driver.memory": "6g"},
                    fallback_checkpoint_dir=os.path.join(scratch, "checkpoints"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_sources(spark):
    from report_fixture import SOURCES
    from tessera.sources import SourceCatalog, frames_from_rows

    return SourceCatalog(spark, frames=frames_from_rows(spark, SOURCES))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tessera.sources import BENCHMARK_TABLES

    con = duckdb.connect()
    for t in BENCHMARK_TABLES:
        p = os.path.join(SF_ORACLE, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
