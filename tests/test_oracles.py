"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_ORACLE, SF_SMALL
from tessera.plans.operator_queries import QUERIES as OPERATOR_QUERIES
from tessera.plans.report_queries import REPORT_QUERIES

QUERIES = {**OPERATOR_QUERIES, **REPORT_QUERIES}
ORACLES = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry_mod.queries())
    assert len(ORACLES) >= 77


@pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="no sf0.01 data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_ORACLE)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="no sf0.001 data")
def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert df.schema == entry_mod.entry(spark).schema


@pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="no sf0.01 data")
def test_full_report_on_benchmark_roles(spark):
    from tessera.plans.report import REPORT_SCHEMA

    df = QUERIES["attendee_report"](spark, SF_ORACLE)
    assert [f.name for f in df.schema] == [f.name for f in REPORT_SCHEMA]
    rows = df.collect()
    assert len(rows) > 10_000
    live = [r for r in rows if r["TabName"] is not None or r["DATESelectionDNT"] is None]
    assert {r["RecordType"] for r in live} == {"Active", "No Show Reset"}
    stored = [r for r in rows if (r["AttendeeFullName"] or "").startswith("Stored ")]
    assert len(stored) + len(live) == len(rows) and len(stored) > 1000
    seats = {r["SeatAttribution"] for r in live if r["RecordType"] == "Active"}
    assert {"Sales", "Comp", "Rescheduled", "Undecided"} <= seats
