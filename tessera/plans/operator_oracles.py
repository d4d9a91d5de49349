"""DuckDB SQL twins of :mod:`tessera.plans.operator_queries`.

Each string runs on DuckDB with the benchmark tables registered as
views and returns the same columns (names and meaning) as the Spark
query of the same key. Dialect notes: ``string_agg(x, s ORDER BY ...)``
for ``listagg ... WITHIN GROUP``; ``strftime`` for ``date_format``;
``rtrim`` on both sides for blank-padded key equality; NULL ordering
written out (DuckDB's default puts NULLs last both ways).
"""

from __future__ import annotations

_T = """T AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
    WHERE (o_orderdate >= DATE '2001-01-01' OR o_orderdate IS NULL)
      AND lower(o_orderstatus) IN ('o', 'p'))"""
_R = """R AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
    WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '2001-01-01')"""
_CHAIN = """lines AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber = 1),
blue AS (SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name LIKE '%blue%'),
first_event AS (SELECT user_id, CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS first_event_date
                FROM events GROUP BY user_id)"""
_SOP = """big_ship AS (
    SELECT l_orderkey, min(l_shipdate) AS first_big_ship FROM lineitem
    WHERE l_quantity > 40 GROUP BY l_orderkey),
sop AS (
    SELECT o.o_orderkey,
           CASE WHEN b.first_big_ship IS NOT NULL THEN
                     CASE WHEN CAST(o.o_orderdate AS DATE) = CAST(b.first_big_ship AS DATE)
                          THEN 'POS' ELSE 'Concierge' END
                WHEN o.o_orderpriority = '1-URGENT' THEN 'Concierge'
                ELSE 'POS' END AS purchase_source
    FROM orders o LEFT JOIN big_ship b ON o.o_orderkey = b.l_orderkey)"""
_FIRST_BIG = """first_big AS (
    SELECT o_custkey AS big_custkey, o_orderkey AS first_big_order, o_totalprice FROM (
        SELECT o_custkey, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey ASC NULLS FIRST) AS rn
        FROM orders WHERE o_totalprice > 400000) x
    WHERE rn = 1)"""
_CUST_KEY = """'Customer#' || CASE WHEN length(CAST({k} AS VARCHAR)) < 9
                THEN lpad(CAST({k} AS VARCHAR), 9, '0') ELSE CAST({k} AS VARCHAR) END"""
_SEGMENT_CASE = """CASE {c} WHEN 'BUILDING' THEN 'Construction' WHEN 'AUTOMOBILE' THEN 'Automotive'
                 WHEN 'MACHINERY' THEN 'Manufacturing' {extra} ELSE {c} END"""
_BRANCH = """SELECT {tag} AS record_type,
       strftime(o_orderdate, '%B %d') || '-' || strftime(o_orderdate + INTERVAL 2 DAY, '%d')
           || ' ' || strftime(o_orderdate, '%Y') AS tab_name,
       CAST(NULL AS VARCHAR) AS blast_date,
       o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status,
       o_orderdate AS date_selection
FROM {src}"""

ORACLE_SQL: dict[str, str] = {
    "scope_tickets": f"WITH {_T} SELECT * FROM T",

    "scoped_semi_union": f"""WITH {_T}, {_R}
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM T WHERE o_custkey IS NOT NULL
                    UNION SELECT o_custkey FROM R WHERE o_custkey IS NOT NULL)""",

    "union_distinct_pool": f"""WITH {_T}, {_R}
SELECT o_custkey AS custkey FROM T WHERE o_custkey IS NOT NULL
UNION SELECT o_custkey FROM R WHERE o_custkey IS NOT NULL""",

    "semi_single": f"""WITH {_T}
SELECT DISTINCT user_id FROM events
WHERE event_type = 'error' AND user_id IN (SELECT o_custkey FROM T)""",

    "shared_base": """WITH base AS (
    SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE NULL END AS big_balance
    FROM customer WHERE c_custkey IS NOT NULL),
dim_nation AS (SELECT c_custkey, c_nationkey FROM base),
dim_flag AS (SELECT DISTINCT c_custkey, big_balance FROM base)
SELECT c.c_custkey, c.c_name, dn.c_nationkey, df.big_balance
FROM customer c
LEFT JOIN dim_nation dn ON c.c_custkey = dn.c_custkey
LEFT JOIN dim_flag df ON c.c_custkey = df.c_custkey""",

    "lookup_unique": """SELECT c.c_custkey, n.n_name, r.r_name
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",

    "lookup_counted": """WITH shipments AS (
    SELECT o.o_custkey FROM orders o
    LEFT JOIN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= DATE '2001-01-01') l ON o.o_orderkey = l.l_orderkey),
errors AS (
    SELECT s.o_custkey FROM shipments s
    LEFT JOIN (SELECT user_id FROM events WHERE event_type = 'error') e ON s.o_custkey = e.user_id),
customers AS (
    SELECT e.o_custkey FROM errors e LEFT JOIN customer c ON e.o_custkey = c.c_custkey)
SELECT 'shipments' AS lookup, (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM shipments) AS rows_after
UNION ALL SELECT 'errors', (SELECT count(*) FROM shipments), (SELECT count(*) FROM errors)
UNION ALL SELECT 'customer', (SELECT count(*) FROM errors), (SELECT count(*) FROM customers)""",

    "hot_key_lookup": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.part_key, p.p_brand
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS part_key FROM lineitem) l
LEFT JOIN part p ON l.part_key = p.p_partkey""",

    "text_segments": """SELECT l_returnflag,
       string_agg(strftime(l_shipdate, '%Y%m%d'), ',' ORDER BY l_orderkey, strftime(l_shipdate, '%Y%m%d')) AS shipments
FROM lineitem GROUP BY l_returnflag""",

    "filter_eq": """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_linenumber = 3""",

    "filter_ne": """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
WHERE l_linenumber != 1 AND l_returnflag != ''""",

    "null_tests": """SELECT c.c_custkey, c.c_name FROM customer c
LEFT JOIN (SELECT DISTINCT user_id FROM events) u ON c.c_custkey = u.user_id
WHERE u.user_id IS NULL AND c.c_name IS NOT NULL""",

    "not_in_literals": """SELECT event_id, user_id, event_type FROM events
WHERE event_type NOT IN ('view', 'click')""",

    "residual_like_inner": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey AND p.p_name LIKE '%blue%'""",

    "composite_inner": """SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_partkey AS r_partkey
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE b.l_returnflag = 'R'""",

    "concat_key_join": f"""SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON {_CUST_KEY.format(k='o.o_custkey')} = c.c_name""",

    "cast_key_join": """SELECT o.o_orderkey, ck.cust_text, ck.c_mktsegment
FROM orders o JOIN (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS cust_text, c_mktsegment FROM customer) ck
  ON CAST(o.o_custkey AS VARCHAR) = ck.cust_text""",

    "lower_key_join": """SELECT c.c_custkey, c.c_mktsegment, s.seg_key
FROM customer c LEFT JOIN (
    SELECT DISTINCT lower(c_mktsegment) AS seg_key FROM customer WHERE c_mktsegment LIKE '%U%') s
  ON lower(c.c_mktsegment) = s.seg_key""",

    "left_where_to_inner": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_size
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_size = l.l_linenumber""",

    "left_on_rn1": f"""WITH {_FIRST_BIG}
SELECT c.c_custkey, c.c_name, CAST(fb.first_big_order AS VARCHAR) AS first_big_order, fb.o_totalprice
FROM customer c LEFT JOIN first_big fb ON c.c_custkey = fb.big_custkey""",

    "chained_left": f"""WITH {_FIRST_BIG},
parts AS (SELECT l_orderkey, min(l_partkey) AS min_big_part FROM lineitem
          WHERE l_quantity > 30 GROUP BY l_orderkey)
SELECT c.c_custkey, CAST(fb.first_big_order AS VARCHAR) AS first_big_order,
       CAST(p.min_big_part AS VARCHAR) AS min_big_part
FROM customer c
LEFT JOIN first_big fb ON c.c_custkey = fb.big_custkey
LEFT JOIN parts p ON fb.first_big_order = p.l_orderkey""",

    "flag_join": """SELECT o.o_orderkey, o.o_custkey,
       CASE WHEN b.user_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS big_buyer
FROM orders o LEFT JOIN (
    SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 90) b
  ON o.o_custkey = b.user_id""",

    "role_playing_dim": """SELECT c.c_custkey, n1.n_name AS cust_nation, CAST(s.s_suppkey AS VARCHAR) AS s_suppkey,
       n2.n_name AS supp_nation
FROM customer c
LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey
LEFT JOIN nation n1 ON c.c_nationkey = n1.n_nationkey
LEFT JOIN nation n2 ON s.s_nationkey = n2.n_nationkey""",

    "star_left": f"""WITH {_T}, {_R},
ship AS (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey),
resets AS (SELECT o_custkey AS reset_custkey, min(o_orderkey) AS first_reset_order FROM R GROUP BY o_custkey)
SELECT t.o_orderkey, c.c_name, n.n_name, s.first_ship,
       CAST(r.first_reset_order AS VARCHAR) AS first_reset_order
FROM T t
LEFT JOIN customer c ON t.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN ship s ON t.o_orderkey = s.l_orderkey
LEFT JOIN resets r ON t.o_custkey = r.reset_custkey""",

    "pos_chain": f"""WITH {_CHAIN}
SELECT o.o_orderkey, l.l_partkey, b.p_name, fe.first_event_date
FROM orders o
JOIN lines l ON o.o_orderkey = l.l_orderkey
JOIN blue b ON l.l_partkey = b.p_partkey
JOIN first_event fe ON o.o_custkey = fe.user_id""",

    "min_over_union": f"""WITH {_T}, {_R}, {_CHAIN},
drivers AS (SELECT o_orderkey, o_custkey FROM T UNION ALL SELECT o_orderkey, o_custkey FROM R),
chain AS (
    SELECT d.o_orderkey, b.p_retailprice, fe.first_event_date
    FROM drivers d
    JOIN lines l ON d.o_orderkey = l.l_orderkey
    JOIN blue b ON l.l_partkey = b.p_partkey
    JOIN first_event fe ON d.o_custkey = fe.user_id)
SELECT o_orderkey, min(p_retailprice) AS min_price, min(first_event_date) AS original_event_date
FROM chain GROUP BY o_orderkey""",

    "min_per_key": "SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey",

    "max_string_independent": """SELECT o_custkey, max(o_orderpriority) AS max_priority,
       max(o_orderstatus) AS max_status, min(o_orderkey) AS min_order
FROM orders WHERE o_orderstatus != 'F' GROUP BY o_custkey""",

    "conditional_flags": """SELECT user_id,
  max(CASE WHEN event_type LIKE '%click%' AND value > 100 THEN 'Yes' ELSE NULL END) AS big_click,
  max(CASE WHEN event_type LIKE '%purchase%' AND value > 100 THEN 'Yes' ELSE NULL END) AS big_purchase,
  max(CASE WHEN event_type LIKE '%error%' AND value > 100 THEN 'Yes' ELSE NULL END) AS big_error,
  max(CASE WHEN event_type LIKE '%view%' AND value > 100 THEN 'Yes' ELSE NULL END) AS big_view
FROM events GROUP BY user_id""",

    "listagg_distinct": """SELECT l_orderkey, string_agg(part_class, ', ' ORDER BY part_class) AS part_classes
FROM (
    SELECT DISTINCT l.l_orderkey,
           CASE WHEN p.p_name LIKE '%widget%' THEN 'widget'
                WHEN p.p_name LIKE '%ring%' THEN 'ring'
                WHEN p.p_name LIKE '%gear%' THEN 'gear'
                ELSE NULL END AS part_class
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey) x
WHERE part_class IS NOT NULL
GROUP BY l_orderkey""",

    "listagg_prefix": """SELECT l_orderkey,
       'Yes - ' || string_agg(reason, '; ' ORDER BY reason) AS refund_info
FROM (SELECT l_orderkey, CASE WHEN l_returnflag != 'N' THEN l_returnflag ELSE NULL END AS reason
      FROM lineitem WHERE l_discount > 0) x
GROUP BY l_orderkey""",

    "notes_listagg": """SELECT conv_id, string_agg(text, ' | ' ORDER BY turn) AS notes
FROM conversations
WHERE text NOT LIKE '%ción%' AND text NOT LIKE '%ß%'
GROUP BY conv_id""",

    "distinct_rows": "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",

    "latest_per_key": """SELECT event_id, ts, user_id, event_type FROM (
    SELECT event_id, ts, user_id, event_type,
           row_number() OVER (PARTITION BY user_id
                              ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM events) x
WHERE rn = 1""",

    "first_per_key": """SELECT o_orderkey, o_custkey, o_orderdate FROM (
    SELECT o_orderkey, o_custkey, o_orderdate,
           row_number() OVER (PARTITION BY o_custkey
                              ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS rn
    FROM orders) x
WHERE rn = 1""",

    "latest_per_expr_key": """SELECT type_key, event_id, ts FROM (
    SELECT lower(event_type) AS type_key, event_id, ts,
           row_number() OVER (PARTITION BY lower(event_type)
                              ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM events WHERE event_type IS NOT NULL AND rtrim(event_type) != '') x
WHERE rn = 1""",

    "recode_pass": "SELECT c_custkey, " + _SEGMENT_CASE.format(c="c_mktsegment", extra="")
                   + " AS segment_label FROM customer",

    "recode_null_hit": "SELECT c_custkey, " + _SEGMENT_CASE.format(
        c="c_mktsegment", extra="WHEN 'HOUSEHOLD' THEN NULL") + " AS segment_label FROM customer",

    "recode_else_null": """SELECT o_orderkey,
       CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Final' ELSE NULL END AS status_label
FROM orders""",

    "nested_case": f"WITH {_SOP} SELECT o_orderkey, purchase_source FROM sop",

    "seat_attribution": f"""WITH {_SOP},
synth AS (
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_totalprice < 100000 THEN 1 WHEN o_totalprice < 300000 THEN 0 ELSE NULL END AS is_comped,
           CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                WHEN o_orderpriority = '2-HIGH' THEN ''
                ELSE CAST(o_orderkey AS VARCHAR) END AS sales_order_id,
           CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE NULL END AS undecided_ts
    FROM orders),
touched AS (
    SELECT user_id, bool_or(event_type = 'click') AS moved, bool_or(event_type = 'error') AS unsure
    FROM events GROUP BY user_id),
facts AS (
    SELECT s.o_orderkey, s.sales_order_id, sop.purchase_source,
           coalesce(s.is_comped = 1, false) AS comped,
           coalesce(rtrim(s.sales_order_id), '') = '' AS no_order,
           coalesce(t.moved, false) AS moved,
           coalesce(t.unsure, false) OR s.undecided_ts IS NOT NULL AS unsure
    FROM synth s JOIN sop USING (o_orderkey) LEFT JOIN touched t ON t.user_id = s.o_custkey)
SELECT o_orderkey,
  CASE WHEN comped AND no_order THEN if(moved, 'Rescheduled + Comp', 'Comp')
       WHEN moved THEN if(unsure, 'Rescheduled + Undecided', 'Rescheduled')
       ELSE if(purchase_source = 'Concierge', 'Undecided', 'Sales') END AS seat_attribution,
  if(comped, if(sales_order_id IS NULL, 'Comp - No Sales Order', 'Comp - Sales Order'), NULL) AS comp_type
FROM facts""",

    "name_split": """SELECT p_partkey, full_name,
       split_part(full_name, ' ', 1) AS first_name,
       substr(full_name, instr(full_name || ' ', ' ') + 1, length(rtrim(full_name))) AS last_name
FROM (SELECT p_partkey, concat_ws(' ', p_name, p_brand) AS full_name FROM part) x""",

    "tab_label": """SELECT o_orderkey,
       strftime(o_orderdate, '%B %d') || '-' || strftime(o_orderdate + INTERVAL 2 DAY, '%d')
           || ' ' || strftime(o_orderdate, '%Y') AS tab_name
FROM orders""",

    "nullif_coalesce": """SELECT o_orderkey,
       COALESCE(CASE WHEN rtrim(p) = '' THEN NULL ELSE p END, o_orderstatus) AS status_or_priority
FROM (SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END AS p FROM orders) x""",

    "flag_from_null": """SELECT c.c_custkey, fb.first_purchase,
       CASE WHEN fb.first_purchase IS NOT NULL THEN 'Yes' ELSE NULL END AS buyer_flag,
       CASE WHEN (CASE WHEN c.c_acctbal > 5000 THEN 1 WHEN c.c_acctbal < 0 THEN 0 ELSE NULL END) = 1
            THEN 'Yes' ELSE 'No' END AS walk_in
FROM customer c LEFT JOIN (
    SELECT user_id, min(ts) AS first_purchase FROM events
    WHERE event_type = 'purchase' GROUP BY user_id) fb
  ON c.c_custkey = fb.user_id""",

    "trim_key": f"""SELECT o.o_orderkey, c.c_custkey, c.c_name
FROM orders o JOIN customer c
  ON rtrim({_CUST_KEY.format(k='o.o_custkey')} || '   ') = rtrim(c.c_name)""",

    "collated_key": """SELECT lower(p_type) AS part_type, min(p_partkey) AS first_part, arg_min(p_brand, p_partkey) AS first_brand,
       count(*) AS parts, count(CASE WHEN lower(p_name) LIKE '%ring%' THEN 1 END) AS rings
FROM part GROUP BY lower(p_type)""",

    "hybrid_union": f"""WITH {_T}, {_R},
history AS ({_BRANCH.format(
        tag="CASE WHEN o_orderstatus = 'F' THEN 'No Show Reset' ELSE 'Active' END", src="orders")})
SELECT * FROM history WHERE date_selection < DATE '2001-01-01'
UNION ALL
{_BRANCH.format(tag="'Active'", src="T")}
UNION ALL
{_BRANCH.format(tag="'No Show Reset'", src="R")}""",

    "report_sorted": """SELECT o.o_orderdate, c.c_name, o.o_orderkey
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
ORDER BY o.o_orderdate ASC NULLS FIRST, c.c_name ASC NULLS FIRST, o.o_orderkey ASC NULLS FIRST""",
}

