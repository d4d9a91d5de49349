"""One query per operator of the report, over the benchmark tables.

The report's own sources (tickets, resets, CRM, ERP, POS, ...) are not
among the benchmark tables, so each operator is exercised on tables of
the same shape and role:

======================  =============================================
report role             benchmark table
======================  =============================================
tickets (live, B1)      ``orders`` dated >= cutoff or NULL, status O/P
no-show resets (B2)     ``orders`` with status F dated >= cutoff
attendees / customers   ``customer``
transactions / ERP      ``lineitem``
session dimension       ``part``
history / CRM / kiosk   ``events``
notes                   ``conversations``
employee dimension      ``nation`` (joined twice)
======================  =============================================

Every query reads whole tables; each has a DuckDB twin in
:data:`ORACLE_SQL` with the same output column names.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tessera.functions import (
    classify_like, comp_type, date_span_label, first_nonblank, normalize_key, not_blank,
    on_or_after, on_or_after_or_null, padded_key, prefixed_key, purchase_source, recode,
    seat_attribution, split_first_word, yes_no, yes_or_null,
)
from tessera.operators import (
    LookupCounts, first_per_key, flag_pivot, hot_keys, hybrid_union, joined_projections, joined_text,
    key_pool, latest_per_key, lookup, presence_flag, scope_by_keys,
)
from tessera.sources import BenchmarkTables

# Parameters of the operator queries (not the report's own values).
CUTOFF = _dt.date(2001, 1, 1)
LIVE_STATUSES = ("o", "p")          # compared case-folded, like the ticket statuses
RESET_STATUS = "F"
CUSTOMER_PREFIX = "Customer#"
KEY_WIDTH = 9

Query = Callable[[SparkSession, str], DataFrame]


def _id_text(col: str) -> Column:
    """An id that a left join may leave NULL, emitted as text (ids are text in the report)."""
    return F.col(col).cast("string").alias(col)


def _tables(spark: SparkSession, sf_dir: str) -> BenchmarkTables:
    return BenchmarkTables(spark, sf_dir)


# --------------------------------------------------------------------------
# shared derived relations
# --------------------------------------------------------------------------

def live_orders(tb: BenchmarkTables, *cols: str) -> DataFrame:
    """The ``tickets`` analogue: dated on/after the cutoff or undated, status O/P."""
    o = tb.read("orders", *(cols or ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")))
    return o.where(on_or_after_or_null("o_orderdate", CUTOFF)
                   & F.lower(F.col("o_orderstatus")).isin(*LIVE_STATUSES))


def reset_orders(tb: BenchmarkTables, *cols: str) -> DataFrame:
    """The ``no-show resets`` analogue: status F dated on/after the cutoff."""
    o = tb.read("orders", *(cols or ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")))
    return o.where((F.col("o_orderstatus") == RESET_STATUS) & on_or_after("o_orderdate", CUTOFF))


def customer_name_key(custkey: Column | str) -> Column:
    """``'Customer#' + zero-padded key``: a computed (concatenated) join key."""
    c = F.col(custkey) if isinstance(custkey, str) else custkey
    return prefixed_key(CUSTOMER_PREFIX, padded_key(c, KEY_WIDTH))


def _pos_chain(tb: BenchmarkTables, drivers: DataFrame) -> DataFrame:
    """drivers -> first line -> part 'blue' -> first event of the customer.

    Mirrors the report's ticket -> ERP line -> POS order -> POS event chain
    (four inner joins, one with a LIKE residual on the right side).
    """
    lines = (tb.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber")
               .where(F.col("l_linenumber") == 1)
               .select("l_orderkey", "l_partkey").distinct())
    blue = (tb.read("part", "p_partkey", "p_name", "p_retailprice")
              .where(F.col("p_name").contains("blue")))
    first_event = (tb.read("events", "user_id", "ts")
                     .groupBy("user_id")
                     .agg(F.to_date(F.min("ts")).cast("timestamp_ntz").alias("first_event_date")))
    return (drivers
            .join(lines, drivers["o_orderkey"] == lines["l_orderkey"], "inner")
            .join(blue, F.col("l_partkey") == blue["p_partkey"], "inner")
            .join(first_event, F.col("o_custkey") == first_event["user_id"], "inner"))


def _source_of_purchase(tb: BenchmarkTables) -> DataFrame:
    """Nested decision: first large-line ship date vs the order date."""
    big_ship = (tb.read("lineitem", "l_orderkey", "l_quantity", "l_shipdate")
                  .where(F.col("l_quantity") > 40)
                  .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_big_ship")))
    o = tb.read("orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    j = o.join(big_ship, o["o_orderkey"] == big_ship["l_orderkey"], "left")
    urgent = F.coalesce(F.col("o_orderpriority") == "1-URGENT", F.lit(False))
    decision = purchase_source(F.col("o_orderdate"), F.to_date("first_big_ship"), urgent,
                               F.lit(None).cast("timestamp_ntz"), F.lit(False))
    return j.select("o_orderkey", decision.alias("purchase_source"))


# --------------------------------------------------------------------------
# the queries
# --------------------------------------------------------------------------

def q_scope_tickets(spark, sf_dir):
    return live_orders(_tables(spark, sf_dir))


def q_scoped_semi_union(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    pool = key_pool((live_orders(tb), "o_custkey"), (reset_orders(tb), "o_custkey"))
    cust = tb.read("customer", "c_custkey", "c_name", "c_mktsegment")
    return scope_by_keys(cust, "c_custkey", pool)


def q_union_distinct_pool(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    pool = key_pool((live_orders(tb), "o_custkey"), (reset_orders(tb), "o_custkey"))
    return pool.select(F.col(pool.columns[0]).alias("custkey"))


def q_semi_single(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    errors = tb.read("events", "user_id", "event_type").where(F.col("event_type") == "error")
    scoped = scope_by_keys(errors, "user_id", key_pool((live_orders(tb), "o_custkey")))
    return scoped.select("user_id").distinct()


def q_shared_base(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    # customers, their nations and their distinct balance flags, all from one scan
    base = tb.read("customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal").withColumn(
        "big_balance", yes_or_null(F.col("c_acctbal") > 5000))
    return joined_projections(base, "c_custkey", ["c_name"], [(["c_nationkey"], False), (["big_balance"], True)])


def q_lookup_unique(spark, sf_dir):
    """Customers with their nation and region; a repeated key in either would fail the query."""
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey", "c_nationkey")
    n = tb.read("nation", "n_nationkey", "n_name", "n_regionkey")
    r = tb.read("region", "r_regionkey", "r_name")
    j = lookup(c, n, "c_nationkey", dim_on="n_nationkey", name="nation")
    return lookup(j, r, "n_regionkey", dim_on="r_regionkey", name="region").select("c_custkey", "n_name", "r_name")


def q_lookup_counted(spark, sf_dir):
    """Rows before and after three lookups, counted while they run: repeated keys add rows in two of them."""
    tb = _tables(spark, sf_dir)
    counts = LookupCounts()
    o = tb.read("orders", "o_orderkey", "o_custkey")
    shipped = tb.read("lineitem", "l_orderkey", "l_shipdate").where(F.col("l_shipdate") >= F.lit(_dt.date(2001, 1, 1)))
    users = tb.read("events", "user_id", "event_type").where(F.col("event_type") == "error")
    j = lookup(o, shipped, "o_orderkey", unique=False, dim_on="l_orderkey", name="shipments", counts=counts)
    j = lookup(j, users, "o_custkey", unique=False, dim_on="user_id", name="errors", counts=counts)
    j = lookup(j, tb.read("customer", "c_custkey", "c_name"), "o_custkey", unique=False, dim_on="c_custkey",
               name="customer", counts=counts)
    j.write.format("noop").mode("overwrite").save()
    rows = [(name, before, after) for name, (before, after) in counts.rows().items()]
    return spark.createDataFrame(rows, "lookup string, rows_before long, rows_after long")


def q_hot_key_lookup(spark, sf_dir):
    """Lines with a part key that a third of them share, and the part's brand: the hot key is spread."""
    tb = _tables(spark, sf_dir)
    li = tb.read("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    li = li.withColumn("part_key", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_partkey")))
    hot = hot_keys(li, "part_key")["part_key"]
    return lookup(li, tb.read("part", "p_partkey", "p_brand"), "part_key", dim_on="p_partkey", name="part",
                  spread_by="l_orderkey", hot=hot)


def q_filter_eq(spark, sf_dir):
    li = _tables(spark, sf_dir).read("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 3))


def q_filter_ne(spark, sf_dir):
    li = _tables(spark, sf_dir).read("lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    return li.where((F.col("l_linenumber") != 1) & (F.col("l_returnflag") != ""))


def q_null_tests(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    cust = tb.read("customer", "c_custkey", "c_name")
    users = tb.read("events", "user_id").distinct()
    j = cust.join(users, cust["c_custkey"] == users["user_id"], "left")
    return j.where(F.col("user_id").isNull() & F.col("c_name").isNotNull()).select("c_custkey", "c_name")


def q_not_in_literals(spark, sf_dir):
    ev = _tables(spark, sf_dir).read("events", "event_id", "user_id", "event_type")
    return ev.where(~F.col("event_type").isin("view", "click"))


def q_residual_like_inner(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    li = tb.read("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    blue = tb.read("part", "p_partkey", "p_name").where(F.col("p_name").contains("blue"))
    return (li.join(blue, li["l_partkey"] == blue["p_partkey"], "inner")
              .select("l_orderkey", "l_linenumber", "l_partkey", "p_name"))


def q_composite_inner(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    a = tb.read("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    b = (tb.read("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
           .where(F.col("l_returnflag") == "R")
           .select(F.col("l_orderkey").alias("r_orderkey"), F.col("l_linenumber").alias("r_linenumber"),
                   F.col("l_partkey").alias("r_partkey")))
    return (a.join(b, (a["l_orderkey"] == b["r_orderkey"]) & (a["l_linenumber"] == b["r_linenumber"]), "inner")
             .select("l_orderkey", "l_linenumber", "l_partkey", "r_partkey"))


def q_concat_key_join(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey")
    c = tb.read("customer", "c_name", "c_mktsegment")
    return (o.join(c, customer_name_key("o_custkey") == c["c_name"], "left")
             .select("o_orderkey", "o_custkey", "c_name", "c_mktsegment"))


def q_cast_key_join(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey")
    ck = (tb.read("customer", "c_custkey", "c_mktsegment")
            .select(F.col("c_custkey").cast("string").alias("cust_text"), "c_mktsegment").distinct())
    return (o.join(ck, o["o_custkey"].cast("string") == ck["cust_text"], "inner")
             .select("o_orderkey", "cust_text", "c_mktsegment"))


def q_lower_key_join(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey", "c_mktsegment")
    segs = (tb.read("customer", "c_mktsegment").where(F.col("c_mktsegment").contains("U"))
              .select(normalize_key("c_mktsegment", "lcase").alias("seg_key")).distinct())
    return (c.join(segs, normalize_key(c["c_mktsegment"], "lcase") == segs["seg_key"], "left")
             .select("c_custkey", "c_mktsegment", "seg_key"))


def q_left_where_to_inner(spark, sf_dir):
    # LEFT JOIN ... WHERE right.col = left.col rejects NULLs: it is an inner join
    tb = _tables(spark, sf_dir)
    li = tb.read("lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    p = tb.read("part", "p_partkey", "p_size")
    return (li.join(p, (li["l_partkey"] == p["p_partkey"]) & (p["p_size"] == li["l_linenumber"]), "inner")
              .select("l_orderkey", "l_linenumber", "l_partkey", "p_size"))


def _first_big_order(tb: BenchmarkTables) -> DataFrame:
    big = (tb.read("orders", "o_orderkey", "o_custkey", "o_totalprice")
             .where(F.col("o_totalprice") > 400000))
    return first_per_key(big, "o_custkey", "o_orderkey").select(
        F.col("o_custkey").alias("big_custkey"), F.col("o_orderkey").alias("first_big_order"),
        "o_totalprice")


def q_left_on_rn1(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey", "c_name")
    fb = _first_big_order(tb)
    return (c.join(fb, c["c_custkey"] == fb["big_custkey"], "left")
             .select("c_custkey", "c_name", _id_text("first_big_order"), "o_totalprice"))


def q_chained_left(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey")
    fb = _first_big_order(tb)
    parts = (tb.read("lineitem", "l_orderkey", "l_partkey", "l_quantity")
               .where(F.col("l_quantity") > 30)
               .groupBy("l_orderkey").agg(F.min("l_partkey").alias("min_big_part")))
    return (c.join(fb, c["c_custkey"] == fb["big_custkey"], "left")
             .join(parts, F.col("first_big_order") == parts["l_orderkey"], "left")
             .select("c_custkey", _id_text("first_big_order"), _id_text("min_big_part")))


def q_flag_join(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey")
    buyers = (tb.read("events", "user_id", "event_type", "value")
                .where((F.col("event_type") == "purchase") & (F.col("value") > 90)))
    flagged = presence_flag(o, buyers, on="o_custkey", keys_on="user_id", name="is_buyer")
    return flagged.select("o_orderkey", "o_custkey", yes_no(F.col("is_buyer")).alias("big_buyer"))


def q_role_playing_dim(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey", "c_nationkey")
    s = tb.read("supplier", "s_suppkey", "s_nationkey")
    n1 = tb.read("nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("n1_key"), F.col("n_name").alias("cust_nation"))
    n2 = tb.read("nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("n2_key"), F.col("n_name").alias("supp_nation"))
    return (c.join(s, c["c_custkey"] == s["s_suppkey"], "left")
             .join(n1, F.col("c_nationkey") == n1["n1_key"], "left")
             .join(n2, F.col("s_nationkey") == n2["n2_key"], "left")
             .select("c_custkey", "cust_nation", _id_text("s_suppkey"), "supp_nation"))


def q_star_left(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    t = live_orders(tb, "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = tb.read("customer", "c_custkey", "c_name", "c_nationkey")
    n = tb.read("nation", "n_nationkey", "n_name")
    ship = (tb.read("lineitem", "l_orderkey", "l_shipdate")
              .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship")))
    resets = (reset_orders(tb).groupBy(F.col("o_custkey").alias("reset_custkey"))
                .agg(F.min("o_orderkey").alias("first_reset_order")))
    return (t.join(c, t["o_custkey"] == c["c_custkey"], "left")
             .join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
             .join(ship, t["o_orderkey"] == ship["l_orderkey"], "left")
             .join(resets, t["o_custkey"] == resets["reset_custkey"], "left")
             .select("o_orderkey", "c_name", "n_name", "first_ship", _id_text("first_reset_order")))


def q_pos_chain(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey")
    return _pos_chain(tb, o).select("o_orderkey", "l_partkey", "p_name", "first_event_date")


def q_min_over_union(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    # union the two drivers first, then run the chain once
    drivers = live_orders(tb, "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").select(
        "o_orderkey", "o_custkey").unionAll(reset_orders(tb).select("o_orderkey", "o_custkey"))
    chain = _pos_chain(tb, drivers)
    return chain.groupBy("o_orderkey").agg(F.min("p_retailprice").alias("min_price"),
                                           F.min("first_event_date").alias("original_event_date"))


def q_min_per_key(spark, sf_dir):
    li = _tables(spark, sf_dir).read("lineitem", "l_orderkey", "l_shipdate")
    return li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))


def q_max_string_independent(spark, sf_dir):
    o = _tables(spark, sf_dir).read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return (o.where(F.col("o_orderstatus") != "F")
             .groupBy("o_custkey")
             .agg(F.max("o_orderpriority").alias("max_priority"),
                  F.max("o_orderstatus").alias("max_status"),
                  F.min("o_orderkey").alias("min_order")))


def q_conditional_flags(spark, sf_dir):
    ev = _tables(spark, sf_dir).read("events", "user_id", "event_type", "value")
    big = F.col("value") > 100
    t = F.col("event_type")
    return flag_pivot(ev, "user_id", t, [
        ("big_click", t.contains("click") & big),
        ("big_purchase", t.contains("purchase") & big),
        ("big_error", t.contains("error") & big),
        ("big_view", t.contains("view") & big),
    ])


def q_listagg_distinct(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    li = tb.read("lineitem", "l_orderkey", "l_partkey")
    p = tb.read("part", "p_partkey", "p_name")
    classes = (li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
                 .select("l_orderkey",
                         classify_like("p_name", [("widget", "widget"), ("ring", "ring"), ("gear", "gear")])
                         .alias("part_class"))
                 .where(F.col("part_class").isNotNull()))
    return joined_text(classes, "l_orderkey", "part_class", ", ", alias="part_classes", distinct=True)


def q_listagg_prefix(spark, sf_dir):
    li = _tables(spark, sf_dir).read("lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_returnflag")
    src = (li.where(F.col("l_discount") > 0)
             .select("l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("reason")))
    return joined_text(src, "l_orderkey", "reason", "; ", alias="refund_info", prefix="Yes - ")


def q_notes_listagg(spark, sf_dir):
    cv = _tables(spark, sf_dir).read("conversations", "conv_id", "turn", "text")
    kept = cv.where(~F.col("text").contains("ción") & ~F.col("text").contains("ß"))
    return joined_text(kept, "conv_id", "text", " | ", alias="notes", order=["turn"])


def q_text_segments(spark, sf_dir):
    """Ship dates of all lines, in one text per return flag: three keys, their rows split by range."""
    tb = _tables(spark, sf_dir)
    li = tb.read("lineitem", "l_orderkey", "l_returnflag", "l_shipdate")
    lines = li.select("l_returnflag", "l_orderkey", F.date_format("l_shipdate", "yyyyMMdd").alias("shipped"))
    return joined_text(lines, "l_returnflag", "shipped", ",", alias="shipments", order=["l_orderkey"], segments=16)


def q_distinct_rows(spark, sf_dir):
    return _tables(spark, sf_dir).read("orders", "o_custkey", "o_orderstatus").distinct()


def q_latest_per_key(spark, sf_dir):
    ev = _tables(spark, sf_dir).read("events", "event_id", "ts", "user_id", "event_type")
    return latest_per_key(ev, "user_id", "ts", tiebreak="event_id")


def q_first_per_key(spark, sf_dir):
    o = _tables(spark, sf_dir).read("orders", "o_orderkey", "o_custkey", "o_orderdate")
    return first_per_key(o, "o_custkey", "o_orderdate", tiebreak="o_orderkey")


def q_latest_per_expr_key(spark, sf_dir):
    ev = _tables(spark, sf_dir).read("events", "event_id", "ts", "event_type")
    keyed = (ev.where(not_blank("event_type"))
               .select(F.lower("event_type").alias("type_key"), "event_id", "ts"))
    return latest_per_key(keyed, "type_key", "ts", tiebreak="event_id")


SEGMENT_RECODE = (("BUILDING", "Construction"), ("AUTOMOBILE", "Automotive"), ("MACHINERY", "Manufacturing"))


def q_recode_pass(spark, sf_dir):
    c = _tables(spark, sf_dir).read("customer", "c_custkey", "c_mktsegment")
    return c.select("c_custkey", recode("c_mktsegment", SEGMENT_RECODE).alias("segment_label"))


def q_recode_null_hit(spark, sf_dir):
    c = _tables(spark, sf_dir).read("customer", "c_custkey", "c_mktsegment")
    return c.select("c_custkey", recode("c_mktsegment", SEGMENT_RECODE,
                                        null_codes=("HOUSEHOLD",)).alias("segment_label"))


def q_recode_else_null(spark, sf_dir):
    o = _tables(spark, sf_dir).read("orders", "o_orderkey", "o_orderstatus")
    return o.select("o_orderkey", recode("o_orderstatus", (("O", "Open"), ("F", "Final")),
                                         default="null").alias("status_label"))


def q_nested_case(spark, sf_dir):
    return _source_of_purchase(_tables(spark, sf_dir))


def q_seat_attribution(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                "o_orderdate", "o_orderpriority")
    ev = tb.read("events", "user_id", "event_type")
    synth = o.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_totalprice") < 100000, F.lit(1)).when(F.col("o_totalprice") < 300000, F.lit(0))
         .alias("is_comped"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("string"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit(""))
         .otherwise(F.col("o_orderkey").cast("string")).alias("sales_order_id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("undecided_ts"),
    )
    synth = presence_flag(synth, ev.where(F.col("event_type") == "click"), on="o_custkey",
                          keys_on="user_id", name="rescheduled")
    synth = presence_flag(synth, ev.where(F.col("event_type") == "error"), on="o_custkey",
                          keys_on="user_id", name="was_undecided")
    j = synth.join(_source_of_purchase(tb), "o_orderkey", "inner")
    c = F.col
    seat = seat_attribution(c("is_comped"), c("sales_order_id"), c("rescheduled"), c("was_undecided"),
                            c("undecided_ts"), c("purchase_source"))
    return j.select("o_orderkey", seat.alias("seat_attribution"),
                    comp_type(c("is_comped"), c("sales_order_id")).alias("comp_type"))


def q_name_split(spark, sf_dir):
    p = _tables(spark, sf_dir).read("part", "p_partkey", "p_name", "p_brand")
    full = F.concat_ws(" ", "p_name", "p_brand")
    first, rest = split_first_word(full)
    return p.select("p_partkey", full.alias("full_name"), first.alias("first_name"), rest.alias("last_name"))


def q_tab_label(spark, sf_dir):
    o = _tables(spark, sf_dir).read("orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", date_span_label("o_orderdate", 2).alias("tab_name"))


def q_nullif_coalesce(spark, sf_dir):
    o = _tables(spark, sf_dir).read("orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    preferred = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.lit(""))
    return o.select("o_orderkey", first_nonblank(preferred, F.col("o_orderstatus")).alias("status_or_priority"))


def q_flag_from_null(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    c = tb.read("customer", "c_custkey", "c_acctbal")
    first_buy = (tb.read("events", "user_id", "event_type", "ts")
                   .where(F.col("event_type") == "purchase")
                   .groupBy("user_id").agg(F.min("ts").alias("first_purchase")))
    j = c.join(first_buy, c["c_custkey"] == first_buy["user_id"], "left")
    walkin = F.when(F.col("c_acctbal") > 5000, F.lit(1)).when(F.col("c_acctbal") < 0, F.lit(0))
    return j.select("c_custkey", "first_purchase",
                    yes_or_null(F.col("first_purchase").isNotNull()).alias("buyer_flag"),
                    yes_no(walkin == 1).alias("walk_in"))


def q_trim_key(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey")
    padded = F.concat(customer_name_key("o_custkey"), F.lit("   "))
    c = tb.read("customer", "c_custkey", "c_name")
    return (o.join(c, normalize_key(padded, "binary_rtrim") == normalize_key(c["c_name"], "binary_rtrim"), "inner")
             .select("o_orderkey", "c_custkey", "c_name"))


def q_collated_key(spark, sf_dir):
    """Parts by type whatever its case: first part, parts with "ring" in the name, distinct brands in use."""
    p = _tables(spark, sf_dir).read("part", "p_partkey", "p_name", "p_type", "p_brand")
    spelled = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.concat("p_type", F.lit("  ")))
    p = p.select("p_partkey", "p_brand", normalize_key(spelled, "ci_rtrim").alias("type"),
                 normalize_key(F.upper("p_name"), "ci_rtrim").alias("name"))
    first = first_per_key(p, "type", "p_partkey").select(F.col("type"), F.col("p_brand").alias("first_brand"))
    per_type = p.groupBy("type").agg(F.min("p_partkey").alias("first_part"), F.count("*").alias("parts"),
                                     F.count(F.when(F.col("name").contains("ring"), 1)).alias("rings"))
    return per_type.join(first, "type").select(F.rtrim(F.lower("type")).cast("string").alias("part_type"),
                                               "first_part", "first_brand", "parts", "rings")


HYBRID_SCHEMA = StructType([
    StructField("record_type", StringType()),
    StructField("tab_name", StringType()),
    StructField("blast_date", StringType()),
    StructField("order_key", LongType()),
    StructField("cust_key", LongType()),
    StructField("status", StringType()),
    StructField("date_selection", TimestampNTZType()),
])


def _report_branch(df: DataFrame, record_type: Column) -> DataFrame:
    return df.select(record_type.alias("record_type"),
                     date_span_label("o_orderdate", 2).alias("tab_name"),
                     F.lit(None).cast("string").alias("blast_date"),
                     F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("cust_key"),
                     F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("date_selection"))


def q_hybrid_union(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    # stored report rows of earlier runs (history), read with date < cutoff
    history = _report_branch(
        tb.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"),
        F.when(F.col("o_orderstatus") == RESET_STATUS, F.lit("No Show Reset")).otherwise(F.lit("Active")))
    live = _report_branch(live_orders(tb), F.lit("Active"))
    resets = _report_branch(reset_orders(tb), F.lit("No Show Reset"))
    return hybrid_union(history, [live, resets], HYBRID_SCHEMA, CUTOFF, "date_selection")


def q_report_sorted(spark, sf_dir):
    tb = _tables(spark, sf_dir)
    o = tb.read("orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = tb.read("customer", "c_custkey", "c_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return (j.select("o_orderdate", "c_name", "o_orderkey")
             .orderBy(F.col("o_orderdate").asc_nulls_first(), F.col("c_name").asc_nulls_first(),
                      F.col("o_orderkey").asc_nulls_first()))


QUERIES: dict[str, Query] = {
    "scope_tickets": q_scope_tickets,
    "scoped_semi_union": q_scoped_semi_union,
    "union_distinct_pool": q_union_distinct_pool,
    "semi_single": q_semi_single,
    "shared_base": q_shared_base,
    "lookup_unique": q_lookup_unique,
    "lookup_counted": q_lookup_counted,
    "hot_key_lookup": q_hot_key_lookup,
    "text_segments": q_text_segments,
    "filter_eq": q_filter_eq,
    "filter_ne": q_filter_ne,
    "null_tests": q_null_tests,
    "not_in_literals": q_not_in_literals,
    "residual_like_inner": q_residual_like_inner,
    "composite_inner": q_composite_inner,
    "concat_key_join": q_concat_key_join,
    "cast_key_join": q_cast_key_join,
    "lower_key_join": q_lower_key_join,
    "left_where_to_inner": q_left_where_to_inner,
    "left_on_rn1": q_left_on_rn1,
    "chained_left": q_chained_left,
    "flag_join": q_flag_join,
    "role_playing_dim": q_role_playing_dim,
    "star_left": q_star_left,
    "pos_chain": q_pos_chain,
    "min_over_union": q_min_over_union,
    "min_per_key": q_min_per_key,
    "max_string_independent": q_max_string_independent,
    "conditional_flags": q_conditional_flags,
    "listagg_distinct": q_listagg_distinct,
    "listagg_prefix": q_listagg_prefix,
    "notes_listagg": q_notes_listagg,
    "distinct_rows": q_distinct_rows,
    "latest_per_key": q_latest_per_key,
    "first_per_key": q_first_per_key,
    "latest_per_expr_key": q_latest_per_expr_key,
    "recode_pass": q_recode_pass,
    "recode_null_hit": q_recode_null_hit,
    "recode_else_null": q_recode_else_null,
    "nested_case": q_nested_case,
    "seat_attribution": q_seat_attribution,
    "name_split": q_name_split,
    "tab_label": q_tab_label,
    "nullif_coalesce": q_nullif_coalesce,
    "flag_from_null": q_flag_from_null,
    "trim_key": q_trim_key,
    "collated_key": q_collated_key,
    "hybrid_union": q_hybrid_union,
    "report_sorted": q_report_sorted,
}
