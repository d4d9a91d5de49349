"""DuckDB SQL twins of :mod:`tessera.plans.report_queries`.

``_RELATIONS`` restates, as one WITH list over the benchmark tables, first
the sources of :mod:`tessera.sources.benchmark_roles` and then the report's
Values that must equal the report's are taken from :mod:`tessera.config`.

Casts on output columns are for the comparison alone: dates as timestamps,
nullable numbers as text and money as double on both sides.
"""

from __future__ import annotations

from tessera import config as C
from tessera.sources.benchmark_roles import BENCHMARK_CONFIG, SECOND_COMPANY

CUTOFF = f"TIMESTAMP '{BENCHMARK_CONFIG.cutoff.isoformat()}'"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _recoded(x: str, pairs, nulls=(), unknown: str | None = None) -> str:
    """``x`` through a table of pairs; ``unknown`` (default: ``x``) for other values."""
    table = [*pairs, *((n, None) for n in nulls)]
    keys = ", ".join(_text(a) for a, _ in table)
    values = ", ".join(_text(b) for _, b in table)
    return f"if(list_contains([{keys}], {x}), [{values}][list_position([{keys}], {x})], {unknown or x})"


def _name(key: str) -> str:
    return (f"'Customer#' || if(length(CAST({key} AS VARCHAR)) < 9, lpad(CAST({key} AS VARCHAR), 9, '0'),"
            f" CAST({key} AS VARCHAR))")


_STATUSES = ", ".join(_text(s) for s in C.TICKET_STATUSES)

_RELATIONS = f"""
-- sources
ticket_rows AS (
  SELECT 'T' || o_orderkey AS ticket_id,
         if(o_custkey % 17 != 0, 'A' || o_custkey, NULL) AS attendee_id,
         if(o_custkey % 19 != 0, 'C' || o_custkey, NULL) AS customer_id,
         o_orderpriority AS product_name, if(o_totalprice > 300000, 'VIP', 'GA') AS ticket_type,
         if(o_orderpriority IN ('1-URGENT', '2-HIGH'), 'Yes', 'No') AS confirmation_status,
         if(o_orderkey % 97 != 0, o_orderdate, NULL) AS event_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS ticket_price, 'Email' AS confirmation_method,
         CAST(o_orderdate AS DATE) - 30 AS confirmed_date,
         if(o_totalprice > 400000, 'Hotel', NULL) AS travel_details,
         if(o_orderpriority = '3-MEDIUM', 'Do not call', NULL) AS outreach_restriction,
         CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS sales_order_id,
         'buyer' || o_custkey || '@example.test' AS purchaser_email,
         CASE WHEN o_totalprice < 60000 THEN 1 WHEN o_totalprice < 200000 THEN 0 END AS is_comped,
         'E' || strftime(o_orderdate, '%Y') AS event_id,
         CASE o_orderstatus WHEN 'O' THEN 'Scheduled' WHEN 'P' THEN 'ATTENDED' ELSE 'Cancelled' END AS status,
         if(o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P', o_orderdate, NULL) AS undecided_timestamp,
         CASE o_orderpriority WHEN '2-HIGH' THEN 1 WHEN '1-URGENT' THEN 0 END AS is_walkin,
         o_orderstatus, o_custkey, o_orderpriority
  FROM orders),
attendee_rows AS (
  SELECT 'A' || c_custkey AS attendee_id, if(c_custkey % 13 != 0, 'P' || c_custkey, NULL) AS person_id,
         concat_ws(' ', c_name, c_mktsegment) AS attendee_name, lower(c_name) || '@example.test' AS attendee_email,
         CAST(NULL AS VARCHAR) AS attendee_phone,
         if(c_mktsegment = 'HOUSEHOLD', 'Vegan', NULL) AS dietary_restrictions
  FROM customer),
customer_rows AS (
  SELECT 'C' || c_custkey AS customer_id, c_name AS company_name,
         if(c_custkey % 23 != 0, 'CV' || c_custkey, NULL) AS cv_customer_id,
         CASE WHEN c_acctbal > 8000 THEN '5 Million+' WHEN c_acctbal > 5000 THEN '2 Million +'
              WHEN c_acctbal < 0 THEN 'To Be Determined' END AS abr,
         CAST(c_nationkey AS VARCHAR) AS vertical,
         CASE WHEN c_acctbal > 9000 THEN '3' WHEN c_acctbal > 7000 THEN '4' WHEN c_acctbal > 6000 THEN '9' END
           AS customer_status
  FROM customer),
dimension_rows AS (
  SELECT 'CV' || c_custkey AS cv_customer_id, c_custkey AS netsuite_id,
         if(c_mktsegment = 'BUILDING', 'Construction', NULL) AS vertical,
         CASE WHEN c_acctbal > 2000 THEN '1 Million+' WHEN c_acctbal < 0 THEN '8' END AS revenue,
         if(c_acctbal > 7500, CAST(DATE '2000-01-01' - CAST(c_nationkey AS INTEGER) AS TIMESTAMP), NULL) AS first_date
  FROM customer
  UNION ALL
  SELECT 'CV' || c_custkey, c_custkey, 'Second vertical', '3 Million+', NULL FROM customer WHERE c_custkey % 40 = 0),
company_rows AS (
  SELECT 'CV' || c_custkey AS cv_customer_id, c_custkey AS company_id FROM customer
  WHERE c_custkey % 11 != 0 AND c_custkey % 31 != 0
  UNION ALL SELECT 'CV' || c_custkey, c_custkey + {SECOND_COMPANY} FROM customer WHERE c_custkey % 7 = 0),
contact_rows AS (
  SELECT event_id AS contact_id, ts AS updated_at, value > 100 AS owner, 'P' || user_id AS person_id,
         CASE event_type WHEN 'purchase' THEN '10 Million+' WHEN 'signup' THEN '' END AS revenue,
         lower({_name('user_id')}) || '@example.test' AS email, user_id, event_type
  FROM events),
member_rows AS (
  SELECT user_id AS company_id, contact_id FROM contact_rows
  UNION ALL SELECT user_id + {SECOND_COMPANY}, contact_id FROM contact_rows WHERE event_type = 'purchase'),
erp_rows AS (
  SELECT o.o_custkey AS entity_id, if(l.l_returnflag = 'R', 'RYB ' || l.l_linestatus, 'Item ' || l.l_partkey) AS item,
         CAST(CAST(l.l_shipdate AS DATE) AS TIMESTAMP) AS dated, if(l.l_linestatus = 'F', 11, 12) AS subsidiary,
         if(l.l_tax > 0.06, 'Cash Sale', 'Sales Order') AS kind, 'Sales Order #' || l.l_orderkey AS display_name,
         'Rep ' || n.n_name AS rep1, if(l.l_linenumber <= 2, 'Rep NATION_' || l.l_linenumber, NULL) AS rep2,
         l.l_orderkey * 1000 + l.l_linenumber AS transaction_id, l.l_linenumber - 1 AS line_id
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN (supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey) ON s.s_suppkey = l.l_suppkey),
payment_rows AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sales_order_id,
         CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'N' THEN 'Other' END AS reason,
         CAST(l_discount * l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS paid_at
  FROM lineitem),
change_rows AS (
  SELECT 'T' || event_id AS ticket_id, ts AS changed_at,
         CASE event_type WHEN 'click' THEN 'confirm' WHEN 'view' THEN 'move' WHEN 'error' THEN 'undecide' END AS action,
         CASE WHEN value > 300 THEN 'System' WHEN value <= 250 THEN 'user' || user_id END AS changed_by,
         value > 20 AS both_values
  FROM events),

-- drivers
live AS (
  SELECT * FROM ticket_rows
  WHERE lower(status) IN ({_STATUSES}) AND (event_date IS NULL OR event_date >= {CUTOFF})),
resets AS (
  SELECT *, 'Guest ' || o_custkey || ' ' || substr(o_orderpriority, 3) AS attendee_name,
         'guest' || o_custkey || '@example.test' AS attendee_email, 'Company ' || o_custkey AS customer_name,
         if(o_orderpriority = '1-URGENT', 'desk', NULL) AS confirmed_by, substr(o_orderpriority, 1, 1) AS vertical,
         if(o_orderpriority = '1-URGENT', 'E125', NULL) AS elite,
         if(o_custkey % 29 != 0, 'CV' || o_custkey, NULL) AS cv_customer_id
  FROM ticket_rows WHERE o_orderstatus = 'F' AND event_date >= {CUTOFF}),
drivers AS (
  SELECT ticket_id, attendee_id, customer_id, sales_order_id FROM live
  UNION ALL SELECT ticket_id, attendee_id, customer_id, sales_order_id FROM resets),

-- datasets
attendees AS (SELECT * FROM attendee_rows SEMI JOIN drivers USING (attendee_id)),
customers AS (SELECT * FROM customer_rows SEMI JOIN drivers USING (customer_id)),
cv_ids AS (SELECT cv_customer_id FROM customers UNION SELECT cv_customer_id FROM resets),
dimension AS (
  SELECT *, if(first_date IS NOT NULL, 'Yes', NULL) AS bought FROM dimension_rows SEMI JOIN cv_ids USING (cv_customer_id)),
rooms AS (
  SELECT ticket_id, string_agg(DISTINCT room, ', ' ORDER BY room) AS rooms FROM (
    SELECT t.ticket_id, CASE WHEN p.p_name LIKE '%widget%' THEN 'Vertical Summit'
                             WHEN p.p_name LIKE '%gear%' THEN 'Roofing Founders Summit'
                             WHEN p.p_name LIKE '%ring%' THEN '10X360 Implementation' END AS room
    FROM live t JOIN lineitem l ON 'T' || l.l_orderkey = t.ticket_id JOIN part p ON p.p_partkey = l.l_partkey
    WHERE 'E' || (1951 + p.p_size) = t.event_id)
  WHERE room IS NOT NULL GROUP BY ticket_id),
kiosk_sessions AS (SELECT DISTINCT event_type, strftime(ts, '%Y') AS held FROM events),
checkins AS (
  SELECT 'T' || e.event_id AS ticket_id,
         max(if(k.event_type = 'click', 'Yes', NULL)) AS day1, max(if(k.event_type = 'view', 'Yes', NULL)) AS day2,
         max(if(k.event_type = 'purchase', 'Yes', NULL)) AS day3, max(if(k.event_type = 'signup', 'Yes', NULL)) AS summit
  FROM events e JOIN kiosk_sessions k ON k.event_type = e.event_type AND k.held = strftime(e.ts, '%Y')
  WHERE e.value > 10 AND e.value <= 300 AND 'T' || e.event_id IN (SELECT ticket_id FROM live)
  GROUP BY 1),
owner_revenue AS (
  SELECT f.cv_customer_id, max_by(c.revenue, (c.updated_at, c.contact_id)) AS revenue
  FROM (SELECT cv_customer_id, min(company_id) AS company_id FROM company_rows GROUP BY 1) f
  JOIN member_rows m USING (company_id) JOIN contact_rows c USING (contact_id)
  WHERE c.owner AND c.revenue IS NOT NULL GROUP BY 1),
revenue AS (
  SELECT d.cv_customer_id, coalesce(nullif(rtrim(o.revenue), ''), d.revenue) AS revenue
  FROM dimension d LEFT JOIN owner_revenue o USING (cv_customer_id)),
ryb AS (
  SELECT d.cv_customer_id, max_by(e.item, (e.dated, e.transaction_id, e.item)) AS item
  FROM dimension d JOIN erp_rows e ON e.entity_id = d.netsuite_id
  WHERE contains(e.item, 'RYB') AND e.subsidiary = 11 GROUP BY 1),
ten AS (SELECT DISTINCT cv_customer_id, bought, first_date FROM dimension),
refunds AS (
  SELECT sales_order_id, 'Yes - ' || string_agg(reason, '; ' ORDER BY reason) AS refund
  FROM payment_rows SEMI JOIN drivers USING (sales_order_id) WHERE amount > 0 GROUP BY 1),
purchases AS (
  SELECT sales_order_id, min(paid_at) AS purchased FROM payment_rows SEMI JOIN drivers USING (sales_order_id) GROUP BY 1),
notes AS (
  SELECT 'T' || conv_id AS ticket_id, string_agg(text, ' | ' ORDER BY text) AS notes FROM conversations
  WHERE NOT contains(text, 'Created from POS') AND NOT contains(text, 'Created from Fabric')
    AND 'T' || conv_id IN (SELECT ticket_id FROM drivers) GROUP BY conv_id),
order_names AS (SELECT DISTINCT 'Sales Order #' || sales_order_id AS display_name FROM drivers),
reps AS (
  SELECT display_name, max(rep1) AS rep1, max(rep2) AS rep2, min(transaction_id) AS transaction_id
  FROM erp_rows SEMI JOIN order_names USING (display_name) WHERE kind = 'Sales Order' AND line_id != 0 GROUP BY 1),
aliases AS (
  SELECT 'Rep ' || n_name AS known, 'Rep NATION_' || (n_nationkey + 1) AS alias FROM nation WHERE n_nationkey % 5 = 0),
rep_names AS (
  SELECT r.display_name, coalesce(a.alias, r.rep1) AS rep1, coalesce(b.alias, r.rep2) AS rep2, r.transaction_id
  FROM reps r LEFT JOIN aliases a ON a.known = r.rep1 LEFT JOIN aliases b ON b.known = r.rep2),
employees AS (
  SELECT 'Rep ' || n_name AS employee, lower(n_name) || '@example.test' AS email FROM nation
  UNION SELECT 'Rep ' || n_name, lower(n_name) || '.alt@example.test' FROM nation WHERE n_nationkey < 3),
by_person AS (
  SELECT person_id, max_by(contact_id, (updated_at, contact_id)) AS contact_id
  FROM contact_rows SEMI JOIN attendees USING (person_id) GROUP BY 1),
emails AS (SELECT lower(attendee_email) AS email FROM attendees UNION SELECT lower(attendee_email) FROM resets),
by_email AS (
  SELECT email, max_by(contact_id, (updated_at, contact_id)) AS contact_id
  FROM contact_rows SEMI JOIN emails USING (email) GROUP BY 1),
changes AS (SELECT * FROM change_rows SEMI JOIN live USING (ticket_id)),
confirmed AS (
  SELECT ticket_id, max_by(changed_by, (changed_at, changed_by)) AS changed_by FROM changes
  WHERE action = 'confirm' AND changed_by != 'System' GROUP BY 1),
moved AS (SELECT DISTINCT ticket_id FROM changes WHERE action = 'move' AND both_values),
undecided AS (SELECT DISTINCT ticket_id FROM changes WHERE action = 'undecide'),
pos_dates AS (
  SELECT d.ticket_id, min(CAST(DATE '2001-01-01' + CAST(p.p_size * 3 AS INTEGER) AS TIMESTAMP)) AS held
  FROM drivers d
  JOIN erp_rows e ON e.display_name = 'Sales Order #' || d.sales_order_id AND e.kind = 'Sales Order' AND e.line_id = 0
  JOIN lineitem first_line ON first_line.l_orderkey * 1000 + 1 = e.transaction_id AND first_line.l_linenumber = 1
  JOIN lineitem any_line ON any_line.l_orderkey = first_line.l_orderkey
  JOIN part p ON p.p_partkey = any_line.l_partkey AND contains(p.p_name, 'blue')
  GROUP BY 1),
ticket_facts AS (
  SELECT t.ticket_id, t.sales_order_id, p.held, CAST(t.event_date AS DATE) = p.held AS same_day,
         coalesce(t.is_comped = 1, false) AS comped, coalesce(rtrim(t.sales_order_id), '') = '' AS no_order,
         m.ticket_id IS NOT NULL AS moved, u.ticket_id IS NOT NULL OR t.undecided_timestamp IS NOT NULL AS unsure
  FROM live t LEFT JOIN pos_dates p USING (ticket_id)
  LEFT JOIN moved m USING (ticket_id) LEFT JOIN undecided u USING (ticket_id)),
sources AS (
  SELECT *, if(CASE WHEN held IS NOT NULL THEN coalesce(same_day, false) ELSE NOT (moved OR unsure) END,
               'POS', 'Concierge') AS source
  FROM ticket_facts),
seats AS (
  SELECT ticket_id, CASE WHEN comped AND no_order THEN if(moved, 'Rescheduled + Comp', 'Comp')
                         WHEN moved THEN if(unsure, 'Rescheduled + Undecided', 'Rescheduled')
                         ELSE if(source = 'Concierge', 'Undecided', 'Sales') END AS seat
  FROM sources),

-- the report
order_facts AS (
  SELECT d.sales_order_id, f.refund, p.purchased, r.rep1, r.rep2, e1.email AS email1, e2.email AS email2
  FROM (SELECT DISTINCT sales_order_id FROM drivers WHERE sales_order_id IS NOT NULL) d
  LEFT JOIN refunds f USING (sales_order_id) LEFT JOIN purchases p USING (sales_order_id)
  LEFT JOIN rep_names r ON r.display_name = 'Sales Order #' || d.sales_order_id
  LEFT JOIN employees e1 ON e1.employee = r.rep1 LEFT JOIN employees e2 ON e2.employee = r.rep2),
cv_facts AS (
  SELECT i.cv_customer_id, d.vertical AS dim_vertical, v.revenue, y.item, x.bought, x.first_date
  FROM cv_ids i LEFT JOIN dimension d USING (cv_customer_id) LEFT JOIN revenue v USING (cv_customer_id)
  LEFT JOIN ryb y USING (cv_customer_id) LEFT JOIN ten x USING (cv_customer_id)),
part_active AS (
  SELECT 'Active' AS "RecordType", t.event_date, s.seat AS "SeatAttribution", t.product_name, t.ticket_type, r.rooms,
         a.attendee_name, a.attendee_email, a.attendee_phone, t.purchaser_email, c.company_name, o.purchased, p.held,
         t.confirmation_status, k.changed_by AS confirmed_by, t.travel_details, t.confirmation_method, t.confirmed_date,
         t.outreach_restriction, n.notes, a.dietary_restrictions, o.refund, t.ticket_price, o.email1, o.rep1, o.email2,
         o.rep2, q.source, t.is_comped, t.sales_order_id, coalesce(bp.contact_id, be.contact_id) AS contact_id,
         coalesce(v.revenue, c.abr) AS revenue, coalesce(v.dim_vertical, {_recoded('c.vertical', C.VERTICAL_RECODE)}) AS vertical,
         {_recoded('c.customer_status', C.ELITE_STATUS_RECODE, unknown='NULL')} AS elite, t.status, v.bought, v.first_date,
         v.item, c.cv_customer_id, a.person_id, if(lower(t.status) = 'attended', 'Yes', 'No') AS attended, 'No' AS no_show,
         if(coalesce(t.is_walkin = 1, false), 'Yes', 'No') AS walk_in, h.day1, h.day2, h.day3, h.summit, t.ticket_id
  FROM live t LEFT JOIN rooms r USING (ticket_id) LEFT JOIN notes n USING (ticket_id)
  LEFT JOIN confirmed k USING (ticket_id) LEFT JOIN sources q USING (ticket_id) LEFT JOIN pos_dates p USING (ticket_id)
  LEFT JOIN seats s USING (ticket_id) LEFT JOIN checkins h USING (ticket_id)
  LEFT JOIN order_facts o ON o.sales_order_id = t.sales_order_id
  LEFT JOIN attendees a ON a.attendee_id = t.attendee_id
  LEFT JOIN by_person bp ON bp.person_id = a.person_id LEFT JOIN by_email be ON be.email = lower(a.attendee_email)
  LEFT JOIN customers c ON c.customer_id = t.customer_id LEFT JOIN cv_facts v ON v.cv_customer_id = c.cv_customer_id),
part_reset AS (
  SELECT 'No Show Reset' AS "RecordType", t.event_date, NULL AS "SeatAttribution", t.product_name, t.ticket_type,
         NULL AS rooms, t.attendee_name, t.attendee_email, NULL AS attendee_phone, t.purchaser_email,
         t.customer_name AS company_name, o.purchased, p.held, t.confirmation_status, t.confirmed_by, t.travel_details,
         t.confirmation_method, t.confirmed_date, t.outreach_restriction, n.notes, a.dietary_restrictions, o.refund,
         t.ticket_price, o.email1, o.rep1, o.email2, o.rep2, NULL AS source, t.is_comped, t.sales_order_id, be.contact_id,
         coalesce(v.revenue, c.abr) AS revenue, coalesce(v.dim_vertical, {_recoded('t.vertical', C.VERTICAL_RECODE)}) AS vertical,
         t.elite, 'no show' AS status, v.bought, v.first_date, v.item, t.cv_customer_id, NULL AS person_id,
         'No' AS attended, 'Yes' AS no_show, 'No' AS walk_in, NULL AS day1, NULL AS day2, NULL AS day3, NULL AS summit,
         t.ticket_id
  FROM resets t LEFT JOIN notes n USING (ticket_id) LEFT JOIN pos_dates p USING (ticket_id)
  LEFT JOIN order_facts o ON o.sales_order_id = t.sales_order_id
  LEFT JOIN attendees a ON a.attendee_id = t.attendee_id LEFT JOIN by_email be ON be.email = lower(t.attendee_email)
  LEFT JOIN customers c ON c.customer_id = t.customer_id LEFT JOIN cv_facts v ON v.cv_customer_id = t.cv_customer_id),
part_history AS (
  SELECT if(o_orderstatus = 'F', 'No Show Reset', 'Active') AS record_type, o_orderpriority AS product,
         'Stored ' || o_custkey AS attendee, if(o_custkey % 3 != 0, 'Company ' || o_custkey, NULL) AS company,
         o_totalprice AS price, o_orderdate AS dated, o_custkey AS contact_id, 'T' || o_orderkey AS ticket_id
  FROM orders WHERE o_orderkey % 97 != 0 AND o_orderdate < {CUTOFF})
"""

# output column of the report -> its expression over part_active / part_reset
_LABEL = ("strftime(event_date, '%B %d') || '-' || strftime(event_date + INTERVAL 2 DAY, '%d') || ' ' "
          "|| strftime(event_date, '%Y')")
_REST = "substr(attendee_name, instr(attendee_name || ' ', ' ') + 1, length(rtrim(attendee_name)))"
_COMP = ("if(coalesce(is_comped = 1, false), if(sales_order_id IS NULL, 'Comp - No Sales Order', 'Comp - Sales Order'),"
         " NULL)")
_NONE, _NO_TIME, _NO_PRICE = "CAST(NULL AS VARCHAR)", "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS DOUBLE)"
_LIVE_COLUMNS = {
    "RecordType": '"RecordType"', "TabName": _LABEL, "SeatAttribution": '"SeatAttribution"', "Product": "product_name",
    "TicketType": "ticket_type", "RoomOriginationAdditionEffort": "rooms", "AttendeeFullName": "attendee_name",
    "FirstName": "split_part(attendee_name, ' ', 1)", "LastName": _REST, "AttendeeEmail": "attendee_email",
    "PhoneNumber": "attendee_phone", "CustomerEmail": "purchaser_email", "CompanyName": "company_name",
    "DateofPurchase": "purchased", "OriginalEventScheduledDate": "held", "AttendanceConfirmed": "confirmation_status",
    "ConfirmedBy": "confirmed_by", "HotelFlightDetails": "travel_details", "ConfirmationMethod": "confirmation_method",
    "ConfirmationDate": "CAST(confirmed_date AS TIMESTAMP)", "BlastDate": _NO_TIME, "Donotcontact": "outreach_restriction",
    "LastCalledDate": _NO_TIME, "Notes": "notes", "DietaryRestrictions": "dietary_restrictions", "RefundRequest": "refund",
    "Price": "CAST(ticket_price AS DOUBLE)", "SalesPerson1": "email1", "SalesPerson1Name": "rep1", "SalesPerson2": "email2",
    "SalesPerson2Name": "rep2", "SourceofPurchase": "source", "CompType": _COMP, "DATESelectionDNT": "event_date",
    "HubspotContactID": "CAST(contact_id AS VARCHAR)",
    "AnnualBusinessRevenue": _recoded("revenue", C.ABR_RECODE, C.ABR_NULL_CODES), "Vertical": "vertical",
    "EliteStatus": "elite", "VerticalSummit": _NONE, "Status": "status", "ProductsSoldAttheEvent": _NONE,
    "10X360": "bought", "First10X360PurchaseDate": "first_date", "RYB": "item", "TCV": _NO_PRICE,
    "CVCustomerID": "cv_customer_id", "CVPersonID": "person_id", "Attended": "attended", "IsNoShow": "no_show",
    "WalkIn": "walk_in", "RegistrationDay1": "day1", "RegistrationDay2": "day2", "RegistrationDay3": "day3",
    "10XVerticalSummit": "summit", "TicketID": "ticket_id",
}
_STORED = {
    "RecordType": "record_type", "Product": "product", "AttendeeFullName": "attendee", "CompanyName": "company",
    "Price": "CAST(CAST(price AS DECIMAL(18,2)) AS DOUBLE)", "DATESelectionDNT": "dated",
    "HubspotContactID": "CAST(contact_id AS VARCHAR)", "TicketID": "ticket_id",
}
_TYPED = {"DateofPurchase": _NO_TIME, "OriginalEventScheduledDate": _NO_TIME, "ConfirmationDate": _NO_TIME,
          "BlastDate": _NO_TIME, "LastCalledDate": _NO_TIME, "First10X360PurchaseDate": _NO_TIME, "TCV": _NO_PRICE}


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())


_HISTORY_COLUMNS = {name: _STORED.get(name, _TYPED.get(name, _NONE)) for name in _LIVE_COLUMNS}
_HISTORY = f"SELECT {_listed(_HISTORY_COLUMNS)} FROM part_history"


def _query(body: str) -> str:
    return f"WITH {_RELATIONS}\n{body}"


REPORT_ORACLE_SQL: dict[str, str] = {name: _query(body) for name, body in {
    "attendee_report": f"""{_HISTORY}
UNION ALL SELECT {_listed(_LIVE_COLUMNS)} FROM part_active
UNION ALL SELECT {_listed(_LIVE_COLUMNS)} FROM part_reset
ORDER BY "DATESelectionDNT" NULLS FIRST, "CompanyName" NULLS FIRST, "AttendeeFullName" NULLS FIRST""",
    "report_history": _HISTORY,
    "report_active": f"SELECT {_listed(_LIVE_COLUMNS)} FROM part_active",
    "report_no_show": f"SELECT {_listed(_LIVE_COLUMNS)} FROM part_reset",
    "report_tickets": """SELECT ticket_id, event_id, attendee_id, customer_id, status, event_date, sales_order_id,
  CAST(is_comped AS VARCHAR) AS is_comped, CAST(is_walkin AS VARCHAR) AS is_walkin, undecided_timestamp FROM live""",
    "report_attendees": "SELECT * FROM attendees",
    "report_customers": "SELECT * FROM customers",
    "report_customer_verticals": "SELECT cv_customer_id, vertical FROM dimension",
    "report_sessions": "SELECT ticket_id, rooms AS room_origination FROM rooms",
    "report_checkins": """SELECT ticket_id, day1 AS "Registration Day 1", day2 AS "Registration Day 2",
  day3 AS "Registration Day 3", summit AS "10X Vertical Summit" FROM checkins""",
    "report_business_revenue": "SELECT cv_customer_id, revenue AS annual_business_revenue FROM revenue",
    "report_ryb_purchases": 'SELECT cv_customer_id, item AS "ItemName" FROM ryb',
    "report_first_purchase_flag": """SELECT cv_customer_id, bought AS is_10x360_flag,
  first_date AS first_10x360_purchase_date FROM ten""",
    "report_refunds": "SELECT sales_order_id, refund AS refund_info FROM refunds",
    "report_ticket_notes": "SELECT ticket_id, notes FROM notes",
    "report_ticket_transactions": "SELECT sales_order_id, purchased AS date_of_purchase FROM purchases",
    "report_sales_reps": """SELECT display_name AS "TransactionDisplayName", rep1 AS "SalesRepName",
  rep2 AS "SalesRep2Name", transaction_id AS "TransactionID" FROM reps""",
    "report_rep_names": """SELECT display_name AS "TransactionDisplayName", rep1 AS "SalesRepName",
  rep2 AS "SalesRep2Name", transaction_id AS "TransactionID" FROM rep_names""",
    "report_employees": 'SELECT employee AS "EmployeeName", email AS "Email" FROM employees',
    "report_contact_by_person": 'SELECT person_id AS "CVPersonID", contact_id AS "ContactID" FROM by_person',
    "report_contact_by_email": 'SELECT email AS "Email", contact_id AS "ContactID" FROM by_email',
    "report_confirmed_by": "SELECT ticket_id, changed_by FROM confirmed",
    "report_pos_event_dates": "SELECT ticket_id, held AS original_event_date FROM pos_dates",
    "report_rescheduled": "SELECT ticket_id FROM moved",
    "report_was_undecided": "SELECT ticket_id FROM undecided",
    "report_purchase_source": "SELECT ticket_id, source AS source_of_purchase FROM sources",
    "report_seat_attribution": "SELECT ticket_id, seat AS seat_attribution FROM seats",
    "report_duplicate_keys": """SELECT * FROM (
  SELECT 'tickets' AS dataset, ticket_id AS key, count(*) AS rows FROM live GROUP BY 2
  UNION ALL SELECT 'dim_customer', cv_customer_id, count(*) FROM dimension GROUP BY 2
  UNION ALL SELECT 'hubspot_abr', cv_customer_id, count(*) FROM revenue GROUP BY 2
  UNION ALL SELECT 'is_10x360', cv_customer_id, count(*) FROM ten GROUP BY 2
  UNION ALL SELECT 'dim_employee', employee, count(*) FROM employees GROUP BY 2)
WHERE rows > 1""",
}.items()}
