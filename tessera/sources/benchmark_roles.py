"""The report's 22 sources derived from the benchmark tables.

Lets the full report run over the benchmark data (whole tables, every
scale factor): each source is a Spark projection / join of benchmark
tables, so its size grows with theirs. The rules are deterministic and
chosen so every branch of the report's logic is hit (matches and misses,
NULLs, blanks, ties, fan-out).

Role of each benchmark table:

- ``orders``: tickets (status O/P live, F = no-show resets), sales orders
- ``customer``: attendees, customers, the customer dimension, CRM companies
- ``lineitem``: payments/refunds, ERP lines, session bookings, POS orders
- ``part``: event sessions, POS events
- ``events``: ticket history, CRM contacts, kiosk check-ins
- ``conversations``: ticket notes (whole texts)
- ``nation`` / ``supplier``: sales reps and the employee dimension
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from tessera.config import ReportConfig
from tessera.sources.benchmark_tables import BenchmarkTables
from tessera.sources.catalog import SourceCatalog

# report parameters that fit the benchmark dates (orders span 1995-2001)
BENCHMARK_CONFIG = ReportConfig(cutoff=_dt.date(2001, 1, 1))
EVENT_TYPE = BENCHMARK_CONFIG.event_type_id
SECOND_COMPANY = 1_000_000_000_000


def _email(expr: str) -> str:
    return f"concat(lower({expr}), '@example.test')"


# Column rules shared by tickets and resets (SQL expressions over ``orders``).
_TICKET_COMMON = [
    "concat('T', o_orderkey) AS ticket_id",
    # some tickets have no attendee or no customer
    "CASE WHEN o_custkey % 17 != 0 THEN concat('A', o_custkey) END AS attendee_id",
    "CASE WHEN o_custkey % 19 != 0 THEN concat('C', o_custkey) END AS customer_id",
    "o_orderpriority AS product_name",
    "CASE WHEN o_totalprice > 300000 THEN 'VIP' ELSE 'GA' END AS ticket_type",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Yes' ELSE 'No' END AS confirmation_status",
    # some are not scheduled yet
    "CASE WHEN o_orderkey % 97 != 0 THEN o_orderdate END AS event_date",
    "CAST(o_totalprice AS DECIMAL(18,2)) AS ticket_price",
    "'Email' AS confirmation_method",
    "date_sub(to_date(o_orderdate), 30) AS confirmed_date",
    "CASE WHEN o_totalprice > 400000 THEN 'Hotel' END AS travel_details",
    "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Do not call' END AS outreach_restriction",
    # no sales order for low priority, a blank one for unspecified priority
    "CASE WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS STRING) "
    "     WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE CAST(o_orderkey AS STRING) END AS sales_order_id",
    f"{_email("concat('buyer', o_custkey)")} AS purchaser_email",
    "CASE WHEN o_totalprice < 60000 THEN 1 WHEN o_totalprice < 200000 THEN 0 END AS is_comped",
    f"{EVENT_TYPE} AS event_type_id",
]


def derive_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tb = BenchmarkTables(spark, sf_dir)
    orders = tb.read("orders")
    customer = tb.read("customer")
    lineitem = tb.read("lineitem")
    part = tb.read("part")
    events = tb.read("events")
    nation = tb.read("nation")
    supplier = tb.read("supplier")

    tickets = orders.selectExpr(
        *_TICKET_COMMON,
        "concat('E', date_format(o_orderdate, 'yyyy')) AS event_id",
        "CASE o_orderstatus WHEN 'O' THEN 'Scheduled' WHEN 'P' THEN 'ATTENDED' ELSE 'Cancelled' END AS status",
        "CAST(NULL AS STRING) AS person_id",
        "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN o_orderdate END AS undecided_timestamp",
        "CAST(NULL AS TIMESTAMP_NTZ) AS enter_dtm",
        "CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 0 END AS is_walkin",
    )
    resets = orders.where("o_orderstatus = 'F'").selectExpr(
        *_TICKET_COMMON,
        "concat('Guest ', o_custkey, ' ', substring(o_orderpriority, 3)) AS attendee_name",
        f"{_email("concat('guest', o_custkey)")} AS attendee_email",
        "CAST(NULL AS STRING) AS attendee_phone",
        "concat('Company ', o_custkey) AS customer_name",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'desk' END AS confirmed_by",
        "substring(o_orderpriority, 1, 1) AS vertical",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'E125' END AS customer_elite_status",
        "'no show' AS source_ticket_status",
        "CASE WHEN o_custkey % 29 != 0 THEN concat('CV', o_custkey) END AS cv_customer_id",
    )

    attendees = customer.selectExpr(
        "concat('A', c_custkey) AS attendee_id",
        "CASE WHEN c_custkey % 13 != 0 THEN concat('P', c_custkey) END AS person_id",
        "concat_ws(' ', c_name, c_mktsegment) AS attendee_name",
        f"{_email('c_name')} AS attendee_email",
        "CAST(NULL AS STRING) AS attendee_phone",
        "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Vegan' END AS dietary_restrictions",
    )
    customers = customer.selectExpr(
        "concat('C', c_custkey) AS id",
        "c_name AS name",
        "CASE WHEN c_custkey % 23 != 0 THEN concat('CV', c_custkey) END AS cv_customer_id",
        "CASE WHEN c_acctbal > 8000 THEN '5 Million+' WHEN c_acctbal > 5000 THEN '2 Million +' "
        "     WHEN c_acctbal < 0 THEN 'To Be Determined' END AS abr",
        "CAST(c_nationkey AS STRING) AS vertical",
        "CASE WHEN c_acctbal > 9000 THEN '3' WHEN c_acctbal > 7000 THEN '4' WHEN c_acctbal > 6000 THEN '9' END AS status",
    )
    dim_customer = customer.selectExpr(
        "concat('CV', c_custkey) AS CVCustomerID",
        "c_custkey AS NetSuiteID",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Construction' END AS VerticalName",
        "CASE WHEN c_acctbal > 2000 THEN '1 Million+' WHEN c_acctbal < 0 THEN '8' END AS AnnualBusinessRevenueName",
        "CASE WHEN c_acctbal > 7500 THEN date_sub(DATE'2000-01-01', c_nationkey) END AS First10X360PurchaseDate",
    )
    # some keys of the customer dimension occur twice
    dim_customer = dim_customer.unionAll(customer.where("c_custkey % 40 = 0").selectExpr(
        "concat('CV', c_custkey)", "c_custkey", "'Second vertical'", "'3 Million+'", "CAST(NULL AS DATE)"))
    # customers with no company, one or two; companies without a customer
    companies = customer.where("c_custkey % 11 != 0").selectExpr(
        "CASE WHEN c_custkey % 31 != 0 THEN concat('CV', c_custkey) END AS CVCustomerID", "c_custkey AS CompanyID"
    ).unionAll(customer.where("c_custkey % 7 = 0").selectExpr("concat('CV', c_custkey)", f"c_custkey + {SECOND_COMPANY}"))
    contact_assoc = events.selectExpr("user_id AS CompanyID", "event_id AS ContactID").unionAll(
        events.where("event_type = 'purchase'").selectExpr(f"user_id + {SECOND_COMPANY}", "event_id"))
    contacts = events.selectExpr(
        "event_id AS ContactID",
        "CASE event_type WHEN 'purchase' THEN '10 Million+' WHEN 'signup' THEN '' END AS AnnualBusinessRevenue",
        "ts AS UpdatedAtUTC",
        "CASE WHEN value > 100 THEN 1 ELSE 0 END AS BusinessOwner",
        "concat('P', user_id) AS CVPersonID",
        f"{_email("concat('Customer#', lpad(user_id, greatest(9, length(user_id)), '0'))")} "
        "AS Email",
    )

    reps = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "inner") \
                   .selectExpr("s_suppkey", "concat('Rep ', n_name) AS rep_name")
    lines = lineitem.join(orders.select("o_orderkey", "o_custkey"), lineitem["l_orderkey"] == orders["o_orderkey"],
                          "inner").join(reps, lineitem["l_suppkey"] == reps["s_suppkey"], "left")
    erp = lines.selectExpr(
        "o_custkey AS EntityID",
        "CASE WHEN l_returnflag = 'R' THEN concat('RYB ', l_linestatus) ELSE concat('Item ', l_partkey) END AS ItemName",
        "to_date(l_shipdate) AS TransactionDate",
        "CASE WHEN l_linestatus = 'F' THEN 11 ELSE 12 END AS SubsidiaryID",
        "CASE WHEN l_tax > 0.06 THEN 'Cash Sale' ELSE 'Sales Order' END AS TransactionType",
        "concat('Sales Order #', l_orderkey) AS TransactionDisplayName",
        "rep_name AS SalesRepName",
        "CASE WHEN l_linenumber <= 2 THEN concat('Rep NATION_', l_linenumber) END AS SalesRep2Name",
        "l_orderkey * 1000 + l_linenumber AS TransactionID",
        "l_linenumber - 1 AS TransactionLineID",
    )
    employees = nation.selectExpr("concat('Rep ', n_name) AS EmployeeName", f"{_email('n_name')} AS Email") \
        .unionAll(nation.where("n_nationkey < 3").selectExpr(
            "concat('Rep ', n_name) AS EmployeeName", f"{_email("concat(n_name, '.alt')")} AS Email"))

    transactions = lineitem.selectExpr(
        "CAST(l_orderkey AS STRING) AS sales_order_id",
        "CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'N' THEN 'Other' END AS refund_reason",
        "CAST(l_discount * l_extendedprice AS DECIMAL(18,2)) AS refund_amount",
        "to_date(l_shipdate) AS transaction_date",
    )
    pos_orders = lineitem.where("l_linenumber = 1").selectExpr(
        "concat('PO', l_orderkey) AS order_id", "CAST(l_orderkey * 1000 + 1 AS STRING) AS sales_order_ids")
    pos_order_events = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"], "inner").selectExpr(
        "concat('PO', l_orderkey) AS order_id",
        "CASE WHEN p_name LIKE '%blue%' THEN concat('Elite Edge ', p_type) ELSE p_type END AS selected_event_name",
        "concat('EV', l_partkey) AS selected_event_id")
    pos_events = part.selectExpr(
        "concat('EV', p_partkey) AS EventID", "date_add(DATE'2001-01-01', p_size * 3) AS StartDate")

    sessions = part.selectExpr(
        "concat('S', p_partkey) AS CVEventSessionID",
        "concat('E', 1951 + p_size) AS Event",
        "CASE WHEN p_name LIKE '%widget%' THEN concat('Vertical Summit ', p_name) "
        "     WHEN p_name LIKE '%gear%' THEN concat('Roofing Founders ', p_name) "
        "     WHEN p_name LIKE '%ring%' THEN '10X360 Implementation' ELSE p_name END AS SessionName")
    attendee_tickets = orders.selectExpr("concat('AT', o_orderkey) AS attendee_ticket_id",
                                         "concat('T', o_orderkey) AS ticket_id")
    attendee_ticket_sessions = lineitem.selectExpr("concat('AT', l_orderkey) AS attendee_ticket_id",
                                                   "concat('S', l_partkey) AS event_session_code")

    history = events.selectExpr(
        "concat('T', event_id) AS ticket_id",
        "CASE event_type WHEN 'click' THEN 'Confirmation status updated' "
        "     WHEN 'view' THEN 'Event assigned/unassigned' "
        "     WHEN 'error' THEN 'Status changed to undecided' ELSE 'Note added' END AS action",
        "CASE WHEN value > 300 THEN 'System' WHEN value > 250 THEN CAST(NULL AS STRING) "
        "     ELSE concat('user', user_id) END AS changed_by",
        "CASE WHEN value > 20 THEN 'E1' ELSE '' END AS old_value",
        "'E2' AS new_value",
        "ts AS changed_at",
    )
    kiosk_usage = events.selectExpr(
        "concat('T', event_id) AS ticket_id",
        "concat('K', event_type) AS session_id",
        "concat('E', date_format(ts, 'yyyy')) AS event_id",
        "CASE WHEN value > 10 THEN 'badge_printed' ELSE 'scan' END AS flow_type",
        "CASE WHEN value > 300 THEN ts END AS check_in_undone_at",
    )
    kiosk_registrations = events.selectExpr(
        "concat('K', event_type) AS session_id",
        "concat('E', date_format(ts, 'yyyy')) AS event_id",
        "CASE event_type WHEN 'click' THEN 'General Session Day 1' WHEN 'view' THEN 'General Session Day 2' "
        "     WHEN 'purchase' THEN 'General Session Day 3' WHEN 'signup' THEN 'Vertical Summit Hall' "
        "     ELSE 'Help Desk' END AS session_name",
    ).distinct()
    # nation-wide representatives go by their region's name in the employee dimension
    rep_aliases = nation.where("n_nationkey % 5 = 0").selectExpr(
        "concat('Rep ', n_name) AS source_name", "concat('Rep NATION_', n_nationkey + 1) AS alias")
    notes = tb.read("conversations").selectExpr("concat('T', conv_id) AS ticket_id", "text AS note")

    return {
        "tickets": tickets,
        "ticket_no_show_resets": resets,
        "attendees": attendees,
        "customers": customers,
        "attendee_ticket_sessions": attendee_ticket_sessions,
        "attendee_tickets": attendee_tickets,
        "silver_EventSession": sessions,
        "kiosk_usage": kiosk_usage,
        "kiosk_registrations": kiosk_registrations,
        "transactions": transactions,
        "notes": notes,
        "history": history,
        "DimCustomer": dim_customer,
        "DimEmployee": employees,
        "silver_Companies": companies,
        "silver_ContactCompanyAssoc": contact_assoc,
        "silver_Contacts": contacts,
        "silver_Transaction": erp,
        "bronze_OrdersFULL": pos_orders,
        "bronze_OrdersSelectedEventsFULL": pos_order_events,
        "silver_Events": pos_events,
        "rep_aliases": rep_aliases,
    }


def derive_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored report rows of earlier runs: one per order, also dated on or after the cutoff.

    The columns that a stored row fills here are listed; the others are NULL.
    """
    from tessera.plans.report import REPORT_SCHEMA

    filled = {
        "RecordType": "CASE o_orderstatus WHEN 'F' THEN 'No Show Reset' ELSE 'Active' END",
        "Product": "o_orderpriority",
        "AttendeeFullName": "concat('Stored ', o_custkey)",
        "CompanyName": "CASE WHEN o_custkey % 3 != 0 THEN concat('Company ', o_custkey) END",
        "Price": "o_totalprice",
        "DATESelectionDNT": "CASE WHEN o_orderkey % 97 != 0 THEN o_orderdate END",
        "HubspotContactID": "o_custkey",
        "TicketID": "concat('T', o_orderkey)",
    }
    return BenchmarkTables(spark, sf_dir).read("orders").selectExpr(*[
        f"CAST({filled.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in REPORT_SCHEMA.fields])


def benchmark_catalog(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return SourceCatalog(spark, frames=derive_sources(spark, sf_dir), history=derive_history(spark, sf_dir))
