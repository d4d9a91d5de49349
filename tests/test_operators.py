"""Unit tests of the column functions and DataFrame operators."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.functions import (
    classify_like, date_span_label, first_nonblank, is_blank, normalize_key, not_blank,
    recode, split_first_word, yes_no, yes_or_null,
)
from tessera.operators import (
    conform, duplicate_keys, first_per_key, flag_pivot, joined_projections, joined_text, key_pool,
    latest_per_key, left_join_spread, presence_flag, scope_by_keys,
)


def test_split_first_word(spark):
    names = [("John Smith",), ("Cher",), ("",), (" Lead",), ("Mary Ann Smith",), ("Ann  Lee  ",), (None,),
             ("Trail ",)]
    df = spark.createDataFrame(names, "n string")
    first, rest = split_first_word("n")
    got = [tuple(r) for r in df.select(first, rest).collect()]
    assert got == [("John", "Smith"), ("Cher", ""), ("", ""), ("", "Lead"), ("Mary", "Ann Smith"),
                   ("Ann", " Lee  "), (None, None), ("Trail", "")]


def test_recode_null_codes_and_defaults(spark):
    df = spark.createDataFrame([("a",), ("b",), ("8",), ("zz",), (None,)], "x string")
    m = (("a", "A"), ("b", "B"), ("a", "ignored"))
    got = [r[0] for r in df.select(recode("x", m, null_codes=("8",))).collect()]
    assert got == ["A", "B", None, "zz", None]
    got = [r[0] for r in df.select(recode("x", m, default="null")).collect()]
    assert got == ["A", "B", None, None, None]
    with pytest.raises(ValueError):
        recode("x", m, default="other")


def test_text_predicates(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "s string")
    got = [tuple(r) for r in df.select(is_blank("s"), not_blank("s"),
                                       first_nonblank("s", F.lit("fb")),
                                       yes_no(F.col("s") == "x"), yes_or_null(F.col("s") == "x")).collect()]
    assert got == [(False, True, "x", "Yes", "Yes"), (True, False, "fb", "No", None),
                   (True, None, "fb", "No", None)]


def test_blank_tests_ignore_trailing_blanks(spark):
    from tessera.functions import blank_to_null

    df = spark.createDataFrame([("  ",), (" a ",)], "s string")
    got = [tuple(r) for r in df.select(is_blank("s"), not_blank("s"), blank_to_null("s"),
                                       first_nonblank("s", F.lit("fb"))).collect()]
    assert got == [(True, False, None, "fb"), (False, True, " a ", " a ")]


def test_classify_like_first_match_wins(spark):
    df = spark.createDataFrame([("Vertical Summit Roofing Founders",), ("Roofing Founders",), ("Lunch",)], "s string")
    cls = classify_like("s", [("Vertical Summit", "VS"), ("Roofing Founders", "RF")])
    assert [r[0] for r in df.select(cls).collect()] == ["VS", "RF", None]


def test_date_span_label(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 8, 11, 9),), (dt.datetime(2026, 8, 30),),
                                (dt.datetime(2026, 12, 31),), (None,)], "d timestamp_ntz")
    got = [r[0] for r in df.select(date_span_label("d")).collect()]
    assert got == ["August 11-13 2026", "August 30-01 2026", "December 31-02 2026", None]


def test_concat_forms(spark):
    from tessera.functions import concat_text, prefixed_key

    df = spark.createDataFrame([("1",), (None,)], "k string")
    got = [tuple(r) for r in df.select(prefixed_key("P#", "k"), concat_text(F.lit("P#"), "k")).collect()]
    assert got == [("P#1", "P#1"), (None, "P#")]       # '+' propagates NULL, CONCAT does not


def test_normalize_key(spark):
    df = spark.createDataFrame([("Ab  ",)], "k string")
    got = df.select(normalize_key("k"), normalize_key("k", "binary_rtrim"), normalize_key("k", "lcase")).first()
    assert tuple(got) == ("Ab  ", "Ab", "ab  ")
    with pytest.raises(ValueError):
        normalize_key("k", "nocase")


def test_scope_by_keys_union_pool(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, "w"), (None, "n")], "k int, v string")
    pool = key_pool((a, "k"), (b, "k"))
    assert sorted(r[0] for r in pool.collect()) == [1, 2, 3]
    got = sorted(tuple(r) for r in scope_by_keys(dim, "k", pool).collect())
    assert got == [(1, "x"), (2, "y"), (3, "z")]


def test_latest_and_first_per_key_nulls_and_ties(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 5, 3), ("b", None, 4), ("b", None, 5)], "k string, ts int, id int")
    latest = {r["k"]: r["id"] for r in latest_per_key(df, "k", "ts", tiebreak="id").collect()}
    assert latest == {"a": 3, "b": 5}                       # NULL ordered last when descending
    first = {r["k"]: r["id"] for r in first_per_key(df, "k", "ts", tiebreak="id").collect()}
    assert first == {"a": 1, "b": 4}                        # NULL ordered first when ascending


def test_joined_text(spark):
    df = spark.createDataFrame([("k", "b", 2), ("k", "a", 1), ("k", None, 3), ("n", None, 1), ("k", "b", 4)],
                               "k string, v string, o int")
    plain = {r["k"]: r["t"] for r in joined_text(df, "k", "v", "; ", alias="t", order=["o"]).collect()}
    assert plain == {"k": "a; b; b", "n": None}
    dist = {r["k"]: r["t"] for r in joined_text(df, "k", "v", ", ", alias="t", distinct=True).collect()}
    assert dist == {"k": "a, b"}
    pref = {r["k"]: r["t"] for r in joined_text(df, "k", "v", "; ", alias="t", prefix="Yes - ").collect()}
    assert pref == {"k": "Yes - a; b; b", "n": None}


def test_flag_pivot_and_presence_flag(spark):
    df = spark.createDataFrame([("t1", "Day 1 x"), ("t1", "Day 2"), ("t2", "other")], "k string, s string")
    got = {r["k"]: (r["d1"], r["d2"]) for r in flag_pivot(df, "k", "s", [("d1", "Day 1"), ("d2", "Day 2")]).collect()}
    assert got == {"t1": ("Yes", "Yes"), "t2": (None, None)}
    keys = spark.createDataFrame([("t1",), ("t1",), (None,)], "id string")
    flagged = presence_flag(df, keys, on="k", keys_on="id", name="has")
    assert flagged.count() == 3
    assert {r["k"]: r["has"] for r in flagged.collect()} == {"t1": True, "t2": False}


def test_duplicate_keys(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert [tuple(r) for r in duplicate_keys(dim, "k").collect()] == [(1, 2)]


def test_padded_key_never_cuts(spark):
    from tessera.functions import padded_key
    from tessera.plans.operator_queries import customer_name_key

    df = spark.createDataFrame([(7,), (123456789,), (1234567890,), (None,)], "k long")
    assert [r[0] for r in df.select(padded_key("k", 9)).collect()] == ["000000007", "123456789", "1234567890", None]
    assert df.select(customer_name_key("k")).collect()[2][0] == "Customer#1234567890"


def test_joined_text_counts_equal_values_before_the_shuffle(spark):
    hot = spark.range(20_000).selectExpr("'k' AS k", "concat('r', id % 3) AS v").repartition(4)
    out = joined_text(hot, "k", "v", "; ", alias="t")
    assert out.first()["t"] == "; ".join(sorted(f"r{i % 3}" for i in range(20_000)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the list is made of counted values, three rows for the key
    assert plan.count("Aggregate") == 2 and "count(1)" in plan


def test_joined_text_in_segments(spark):
    """One key of very many rows: its distinct rows are dealt to many tasks, and its text is the same."""
    hot = spark.range(200_000).selectExpr("if(id % 50 = 0, concat('c', id % 7), 'k') AS k", "concat('v', id % 30011) AS v",
                                          "id % 97 AS o", "if(id % 3 = 0, null, concat('x', id % 11)) AS x")
    for order, value, distinct in ((None, "v", True), (["o"], "v", False), ([("o", False)], "x", False), (None, "x", False)):
        plain = {r["k"]: r["t"] for r in joined_text(hot, "k", value, ";", "t", order=order, distinct=distinct).collect()}
        out = joined_text(hot, "k", value, ";", "t", order=order, distinct=distinct, segments=12)
        assert {r["k"]: r["t"] for r in out.collect()} == plain
    pairs = hot.groupBy("k", "o", "v").count()
    dealt = pairs.repartitionByRange(12, "k", "o", "v").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = sorted(r["count"] for r in dealt.collect())
    assert len(sizes) == 12 and sizes[-1] < pairs.count() / 6


def test_joined_text_of_ten_million_copies(spark):
    """Copies are counted before they are shuffled, and a text above the bound is an error."""
    hot = spark.range(0, 10_000_000, 1, 8).selectExpr("'' AS k", "concat('r', id % 3) AS v")
    out = joined_text(hot, "k", "v", "; ", alias="t")
    assert out.select(F.length("t")).first()[0] == 10_000_000 * 4 - 2
    for segments in (0, 4):
        with pytest.raises(Exception, match="joined text of [0-9]+ bytes: more than 1000000"):
            joined_text(hot, "k", "v", "; ", alias="t", segments=segments, max_bytes=1_000_000).collect()
    many = spark.range(3000).selectExpr("'k' AS k", "concat('a value ', id) AS v")   # each within the bound
    for segments in (0, 4):
        with pytest.raises(Exception, match="more than 10000"):
            joined_text(many, "k", "v", "; ", alias="t", segments=segments, max_bytes=10_000).collect()


def test_joined_text_of_a_whole_large_cell(spark):
    """Without a bound from the caller, a text longer than 64 MB comes back whole; runs are joined in order."""
    hot = spark.range(0, 40_000, 1, 4).selectExpr("'k' AS k", "lpad(39999 - id, 2000, '0') AS v", "cast(id AS int) AS o")
    for order, at in ((["o"], 39_999), ([("o", False)], 0)):
        text = joined_text(hot, "k", "v", ",", alias="t", order=order, segments=5).select(
            F.length("t").alias("n"), F.expr("substring(t, 1, 2000)").alias("first"), F.sha2("t", 256).alias("sha")).first()
        values = (f"{k:02000d}" for k in (range(39_999, -1, -1) if at else range(40_000)))
        assert text["n"] == 40_000 * 2001 - 1 > 64 << 20 and int(text["first"]) == at
        assert text["sha"] == hashlib.sha256(",".join(values).encode()).hexdigest()


def test_joined_projections(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "c", None), (2, "c", None), (None, "d", 7), (3, None, 8)],
                               "k int, v string, w int")
    own = df.select("k", "v")
    first, second = df.where("k IS NOT NULL").select("k", F.col("v").alias("v2")), df.where("k IS NOT NULL").select("k", "w").distinct()
    want = own.join(first, "k", "left").join(second, "k", "left")
    got = joined_projections(df, "k", ["v"], [([F.col("v").alias("v2")], False), (["w"], True)])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert joined_projections(df.where("false"), "k", ["v"], [(["w"], True)]).count() == 0


def test_shared_base_has_one_scan(spark):
    from conftest import SF_SMALL
    from tessera.plans.operator_queries import QUERIES

    plan = QUERIES["shared_base"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_collated_keys(spark):
    """Joins, groups, partitions and substring tests of a collated key ignore case and trailing blanks."""
    from tessera.operators import flag_pivot, hot_keys, left_join_spread, lookup

    df = spark.createDataFrame([("Ab", 1, "RYB Gold"), ("aB ", 2, "ryb silver"), ("c", 3, "x"), (None, 4, None), ("", 5, "y")],
                               "k string, v int, t string")
    df = df.select(normalize_key("k", "ci_rtrim").alias("k"), "v", normalize_key("t", "ci_rtrim").alias("t"))
    assert sorted(r["v"] for r in latest_per_key(df, "k", "v").collect()) == [2, 3, 4, 5]
    assert df.where(F.col("t").contains("RYB")).count() == 2
    flags = flag_pivot(df, "k", "t", [("gold", "GOLD"), ("silver", "Silver")]).where("k = 'AB'").collect()
    assert [(r["gold"], r["silver"]) for r in flags] == [("Yes", "Yes")]
    dim = spark.createDataFrame([("AB", 10), ("  ", 20), ("d", 30)], "k string, w int").select(
        normalize_key("k", "ci_rtrim").alias("k"), "w")
    for join in (lambda: left_join_spread(df, dim, "k", "v", buckets=4), lambda: lookup(df, dim, "k"),
                 lambda: left_join_spread(df, dim, "k", "v", hot=hot_keys(df, "k", partitions=4)["k"])):
        assert {r["v"]: r["w"] for r in join().collect()} == {1: 10, 2: 10, 3: None, 4: None, 5: 20}
    with pytest.raises(Exception, match="has 2 rows"):
        lookup(df, dim.unionAll(dim.limit(0)).unionAll(
            spark.createDataFrame([("ab  ", 11)], "k string, w int").select(normalize_key("k", "ci_rtrim"), "w")), "k").collect()
    code = recode(F.col("k"), [("AB", "first"), ("c", "third")], null_codes=["C"], collated=True)
    assert [r[0] for r in df.orderBy("v").select(code).collect()] == ["first", "first", None, None, ""]


def test_conform_positional(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("A", LongType()), StructField("B", StringType())])
    df = spark.createDataFrame([(1, 2)], "x int, y int")
    out = conform(df, schema)
    assert out.schema == schema and tuple(out.first()) == (1, "2")
    with pytest.raises(ValueError):
        conform(df.select("x"), schema)


@pytest.mark.parametrize("kind", ["int", "string"])
def test_left_join_spread(spark, kind):
    as_key = (lambda v: v) if kind == "int" else (lambda v: None if v is None else ("" if v == 2 else str(v)))
    fact = spark.createDataFrame([(as_key(1), "a"), (None, "b"), (None, "c"), (as_key(2), "d"), (as_key(2), "e")], f"k {kind}, f string")
    dim = spark.createDataFrame([(as_key(1), "x", 10), (as_key(1), "y", 11), (None, "z", 12), (as_key(2), "q", 13)],
                                f"k {kind}, v string, w int")
    expected = fact.join(dim, "k", "left")
    for got in (left_join_spread(fact, dim, "k", spread_by="f", buckets=4),
                left_join_spread(fact, dim.withColumnRenamed("k", "dk"), "k", spread_by="f", dim_key="dk", buckets=4)):
        assert got.columns == expected.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_hot_missing_keys_are_dealt_to_all_partitions(spark):
    """99 % of the keys NULL or blank: the shuffle is by the spread key, and no partition holds most rows."""
    fact = spark.range(8000).selectExpr("CASE WHEN id % 100 = 0 THEN CAST(id AS STRING) WHEN id % 2 = 0 THEN '' END AS k", "id AS f")
    dim = spark.range(0, 8000, 100).selectExpr("CAST(id AS STRING) AS k", "id AS v").unionAll(
        spark.sql("SELECT '' AS k, -1L AS v"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        out = left_join_spread(fact, dim, "k", spread_by="f")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(__spread_key" in plan
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        rows = out.collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 8000 and len(sizes) == 8 and max(sizes) < 2000
    assert sum(r["v"] == -1 for r in rows) == 3920 and sum(r["v"] is None for r in rows) == 4000
