"""Physical-plan properties the design relies on."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_ORACLE
from tessera.config import ReportConfig
from tessera.plans.operator_queries import QUERIES
from tessera.plans.report import Report

pytestmark = pytest.mark.skipif(not os.path.exists(SF_ORACLE), reason="no sf0.01 data")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_semi_join_scoping(spark):
    df = entry_mod.queries()["scoped_semi_union"](spark, SF_ORACLE)
    assert "LeftSemi" in optimized_of(df)


def test_top1_uses_window_group_limit(spark):
    df = entry_mod.queries()["latest_per_key"](spark, SF_ORACLE)
    assert "WindowGroupLimit" in optimized_of(df)


def test_filters_and_projection_reach_the_scan(spark):
    df = entry_mod.queries()["filter_eq"](spark, SF_ORACLE)
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_linenumber), EqualTo(l_returnflag,R)" in plan
    read_schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(read_schema.split(",")) == sorted(
        ["l_orderkey:bigint", "l_linenumber:int", "l_returnflag:string", "l_quantity:double"])


def shuffled_rows(df) -> int:
    """Rows written by the shuffles of a plan that has not run yet (without adaptive execution)."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    return total


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_key_pools_filter_large_scans(spark, kind):
    """Spark's runtime filter is put in above its size threshold; rows stay the same, fewer are shuffled."""
    import tempfile

    from pyspark.sql import functions as F
    from tessera.operators import key_pool, scope_by_keys

    root = tempfile.mkdtemp(prefix="tessera-scope-")
    spark.range(100_000).select(F.col("id").cast(kind).alias("k"), F.col("id").alias("v")).write.parquet(f"{root}/big")
    spark.range(0, 100_000, 500).select(F.col("id").cast(kind).alias("k")).write.parquet(f"{root}/used")
    big, used = spark.read.parquet(f"{root}/big"), spark.read.parquet(f"{root}/used")
    key_pool((used, "k"), (used, "k")).write.parquet(f"{root}/pool")
    pool = spark.read.parquet(f"{root}/pool")
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    # between the sizes of the two tables, as the real bounds are
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100k"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        scoped = lambda: scope_by_keys(big, "k", pool)
        plain = scoped()
        assert "might_contain" not in optimized_of(plain)       # a small scan
        spark.conf.set(threshold, "100k")
        filtered = scoped()
        assert "might_contain" in optimized_of(filtered) and "LeftSemi" in optimized_of(filtered)
        assert shuffled_rows(filtered) < shuffled_rows(plain) / 20
        assert sorted(r["v"] for r in filtered.collect()) == sorted(r["v"] for r in plain.collect()) == list(range(0, 100_000, 500))
    finally:
        spark.conf.unset(threshold)
        for c, v in before.items():
            spark.conf.set(c, v)


def inline_report(sources):
    """The whole report as one plan, so that stages are looked at, too."""
    return Report(sources, ReportConfig(materialize="none")).build()


def test_no_python_udfs_anywhere(spark, fixture_sources):
    for name, q in QUERIES.items():
        plan = plan_of(q(spark, SF_ORACLE))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
    plan = plan_of(inline_report(fixture_sources))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_left_where_is_inner(spark):
    df = entry_mod.queries()["left_where_to_inner"](spark, SF_ORACLE)
    assert "LeftOuter" not in optimized_of(df)


def test_no_cross_products(spark, fixture_sources):
    bad = ("CartesianProduct", "BroadcastNestedLoopJoin")
    for name, q in QUERIES.items():
        plan = plan_of(q(spark, SF_ORACLE))
        assert not any(b in plan for b in bad), name
    plan = plan_of(inline_report(fixture_sources))
    assert not any(b in plan for b in bad)


def test_report_spreads_missing_keys(spark, fixture_sources):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(inline_report(fixture_sources))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the fact by order, attendee, customer, dimension key and email, and the profiles' own joins
    assert plan.count("hashpartitioning(__spread_key") >= 16
