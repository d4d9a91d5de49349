"""Lookups: uniqueness refused or counted in the same pass, hot keys spread."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tessera.operators import LookupCounts, hot_keys, left_join_spread, lookup


@contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


PLAIN = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1",
         "spark__sql__shuffle__partitions": "16"}


@pytest.fixture(scope="module")
def tables(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4), ("x", 5), ("a", 6)], "k string, f int")
    dim = spark.createDataFrame([("a", 10, "p"), ("b", 20, None), ("", 30, "r"), (None, 40, "s"), (None, 41, "t"),
                                 ("unused", 50, "u")], "k string, v int, w string")
    return fact, dim


@pytest.mark.parametrize("spread_by", [None, "f"])
def test_lookup_of_a_unique_key(tables, spread_by):
    fact, dim = tables
    want = sorted(map(str, fact.join(dim, "k", "left").select("k", "f", "v", "w").collect()))
    assert sorted(map(str, lookup(fact, dim, "k", spread_by=spread_by).collect())) == want
    named = lookup(fact, dim.withColumnRenamed("k", "dk"), "k", cols=["v"], dim_on="dk", spread_by=spread_by)
    assert named.columns == ["k", "f", "v"] and named.count() == 6


def test_a_repeated_key_fails_the_query(spark, tables):
    fact, dim = tables
    twice = dim.unionAll(spark.createDataFrame([("unused", 51, "z")], dim.schema))
    out = lookup(fact, twice, "k", name="colours")
    with pytest.raises(Exception, match="lookup colours: key unused has 2 rows"):
        out.collect()
    with pytest.raises(Exception, match="lookup colours"):
        out.select("f", "w").collect()
    # no column of the dimension is read: the optimizer leaves the join out, and no row is multiplied
    assert len(out.select("f").collect()) == 6
    assert lookup(fact, twice, "k", unique=False).count() == 6


def test_the_check_reads_the_dimension_once(spark, tables):
    fact, dim = tables
    root = tempfile.mkdtemp(prefix="tessera-lookup-")
    dim.write.parquet(f"{root}/dim")
    with settings(spark, **PLAIN):
        plan = lookup(fact, spark.read.parquet(f"{root}/dim"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    # one shuffle of each side: the count is taken in the join's own partitions
    assert plan.count("Exchange hashpartitioning") == 2


def test_rows_that_repeated_keys_add_are_counted(spark, tables):
    fact, dim = tables
    more = dim.unionAll(spark.createDataFrame([("a", 11, "z"), ("a", 12, "z"), ("unused", 51, "z")], dim.schema))
    counts = LookupCounts()
    first = lookup(fact, more, "k", unique=False, name="first", counts=counts, spread_by="f")
    second = lookup(first.withColumnRenamed("v", "v1").withColumnRenamed("w", "w1"), dim, "k", unique=False,
                    name="second", counts=counts)
    assert second.count() == 10
    assert counts.rows() == {"first": (6, 10), "second": (10, 10)}
    assert counts.multiplied() == {"first": 4}
    with pytest.raises(ValueError, match="counted already"):
        lookup(fact, dim, "k", name="first", counts=counts)


def hot_tables(spark, kind):
    fact = spark.range(48_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 40 == 1, F.lit(9)).otherwise(F.col("id") % 4000)
        .cast(kind).alias("k"), F.col("id").alias("f"))
    dim = spark.range(4000).select(F.col("id").cast(kind).alias("k"), F.concat(F.lit("d"), "id").alias("v"))
    return fact, dim


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_a_valid_key_with_a_third_of_all_rows(spark, kind):
    fact, dim = hot_tables(spark, kind)
    with settings(spark, **PLAIN):
        hot = hot_keys(fact, "k", "f")
        assert [v for v, _ in hot["k"].values] == ([7] if kind == "bigint" else ["7"]) and hot["f"].values == ()
        out = left_join_spread(fact, dim, "k", "f", hot=hot["k"])
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain = left_join_spread(fact, dim, "k", "f")
        bare = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert out.columns == plain.columns == ["k", "f", "v"]
        assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    assert sum(sizes) == 48_000 and len(sizes) == 16
    assert sizes[-1] < 2 * sizes[8]       # under twice the median
    assert bare[-1] > 5 * bare[8]         # what it would be
    assert sum(r["v"] == "d7" for r in out.collect()) == 16_008


def test_only_hot_rows_of_the_dimension_are_repeated(spark):
    fact, dim = hot_tables(spark, "bigint")
    with settings(spark, **PLAIN):
        hot = hot_keys(fact, "k")["k"]
        (_, salts), = hot.values
    assert 16 * 8 / 3 <= salts < 16 * 8 / 3 + 2
    repeated = dim.join(hot.table(dim), dim["k"] == F.col("__dim_key"))
    assert repeated.count() == 1


def test_no_rows(spark, tables):
    fact, dim = tables
    assert hot_keys(fact.where("false"), "k")["k"].values == ()
    assert hot_keys(fact.where("k IS NULL"), "k")["k"].values == ()
    assert lookup(fact.where("false"), dim, "k").count() == 0
    assert lookup(fact, dim.where("false"), "k").where("v IS NOT NULL").count() == 0
