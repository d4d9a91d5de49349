"""Declared schemas of the report's 22 source tables.

Types follow how the report uses each column (codes that look numeric
stay strings; money is decimal; audit times and dates that may carry a
time of day are timestamp_ntz).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DecimalType, IntegerType, LongType, StringType, StructField,
    StructType, TimestampNTZType,
)

S, I, L = StringType(), IntegerType(), LongType()
D, TS, MONEY = DateType(), TimestampNTZType(), DecimalType(18, 2)


def _struct(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


SOURCE_SCHEMAS: dict[str, StructType] = {
    "tickets": _struct(
        ("ticket_id", S), ("event_id", S), ("attendee_id", S), ("customer_id", S),
        ("product_name", S), ("ticket_type", S), ("status", S), ("confirmation_status", S),
        ("event_date", TS), ("ticket_price", MONEY), ("confirmation_method", S),
        ("confirmed_date", D), ("travel_details", S), ("outreach_restriction", S),
        ("person_id", S), ("sales_order_id", S), ("purchaser_email", S), ("is_comped", I),
        ("undecided_timestamp", TS), ("enter_dtm", TS), ("is_walkin", I), ("event_type_id", I),
    ),
    "ticket_no_show_resets": _struct(
        ("ticket_id", S), ("attendee_id", S), ("customer_id", S), ("sales_order_id", S),
        ("event_type_id", I), ("event_date", TS), ("product_name", S), ("ticket_type", S),
        ("attendee_name", S), ("attendee_email", S), ("attendee_phone", S),
        ("purchaser_email", S), ("customer_name", S), ("confirmation_status", S),
        ("confirmed_by", S), ("travel_details", S), ("confirmation_method", S),
        ("confirmed_date", D), ("outreach_restriction", S), ("ticket_price", MONEY),
        ("is_comped", I), ("vertical", S), ("customer_elite_status", S),
        ("source_ticket_status", S), ("cv_customer_id", S),
    ),
    "attendees": _struct(
        ("attendee_id", S), ("person_id", S), ("attendee_name", S), ("attendee_email", S),
        ("attendee_phone", S), ("dietary_restrictions", S),
    ),
    "customers": _struct(
        ("id", S), ("name", S), ("cv_customer_id", S), ("abr", S), ("vertical", S), ("status", S),
    ),
    "attendee_ticket_sessions": _struct(("attendee_ticket_id", S), ("event_session_code", S)),
    "attendee_tickets": _struct(("attendee_ticket_id", S), ("ticket_id", S)),
    "silver_EventSession": _struct(("CVEventSessionID", S), ("Event", S), ("SessionName", S)),
    "kiosk_usage": _struct(
        ("ticket_id", S), ("session_id", S), ("event_id", S), ("flow_type", S),
        ("check_in_undone_at", TS),
    ),
    "kiosk_registrations": _struct(("session_id", S), ("event_id", S), ("session_name", S)),
    "transactions": _struct(
        ("sales_order_id", S), ("refund_reason", S), ("refund_amount", MONEY),
        ("transaction_date", TS),
    ),
    "notes": _struct(("ticket_id", S), ("note", S)),
    "history": _struct(
        ("ticket_id", S), ("action", S), ("changed_by", S), ("old_value", S),
        ("new_value", S), ("changed_at", TS),
    ),
    "DimCustomer": _struct(
        ("CVCustomerID", S), ("NetSuiteID", L), ("VerticalName", S),
        ("AnnualBusinessRevenueName", S), ("First10X360PurchaseDate", TS),
    ),
    "DimEmployee": _struct(("EmployeeName", S), ("Email", S)),
    "silver_Companies": _struct(("CVCustomerID", S), ("CompanyID", L)),
    "silver_ContactCompanyAssoc": _struct(("CompanyID", L), ("ContactID", L)),
    "silver_Contacts": _struct(
        ("ContactID", L), ("AnnualBusinessRevenue", S), ("UpdatedAtUTC", TS),
        ("BusinessOwner", I), ("CVPersonID", S), ("Email", S),
    ),
    "silver_Transaction": _struct(
        ("EntityID", L), ("ItemName", S), ("TransactionDate", TS), ("SubsidiaryID", I),
        ("TransactionType", S), ("TransactionDisplayName", S), ("SalesRepName", S),
        ("SalesRep2Name", S), ("TransactionID", L), ("TransactionLineID", I),
    ),
    "bronze_OrdersFULL": _struct(("order_id", S), ("sales_order_ids", S)),
    "bronze_OrdersSelectedEventsFULL": _struct(
        ("order_id", S), ("selected_event_name", S), ("selected_event_id", S),
    ),
    "silver_Events": _struct(("EventID", S), ("StartDate", TS)),
    # sales-rep alias table (deployment data, see ReportConfig.rep_aliases)
    "rep_aliases": _struct(("source_name", S), ("alias", S)),
}

SOURCE_TABLES = tuple(n for n in SOURCE_SCHEMAS if n != "rep_aliases")

# Columns that are compared (joined on, looked up in a list or recoded).
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "tickets": ("ticket_id", "event_id", "attendee_id", "customer_id", "status", "sales_order_id"),
    "ticket_no_show_resets": ("ticket_id", "attendee_id", "customer_id", "sales_order_id", "attendee_email",
                              "vertical", "cv_customer_id"),
    "attendees": ("attendee_id", "person_id", "attendee_email"),
    "customers": ("id", "cv_customer_id", "abr", "vertical", "status"),
    "attendee_ticket_sessions": ("attendee_ticket_id", "event_session_code"),
    "attendee_tickets": ("attendee_ticket_id", "ticket_id"),
    "silver_EventSession": ("CVEventSessionID", "Event"),
    "kiosk_usage": ("ticket_id", "session_id", "event_id", "flow_type"),
    "kiosk_registrations": ("session_id", "event_id"),
    "transactions": ("sales_order_id",),
    "notes": ("ticket_id",),
    "history": ("ticket_id", "action", "changed_by"),
    "DimCustomer": ("CVCustomerID", "AnnualBusinessRevenueName"),
    "DimEmployee": ("EmployeeName",),
    "silver_Companies": ("CVCustomerID",),
    "silver_Contacts": ("AnnualBusinessRevenue", "CVPersonID", "Email"),
    "silver_Transaction": ("TransactionType", "TransactionDisplayName", "SalesRepName", "SalesRep2Name"),
    "bronze_OrdersFULL": ("order_id", "sales_order_ids"),
    "bronze_OrdersSelectedEventsFULL": ("order_id", "selected_event_id"),
    "silver_Events": ("EventID",),
    "rep_aliases": ("source_name",),
}

# Columns that the report searches for a pattern (LIKE).
PATTERN_COLUMNS: dict[str, tuple[str, ...]] = {
    "silver_EventSession": ("SessionName",),
    "kiosk_registrations": ("session_name",),
    "silver_Transaction": ("ItemName",),
    "bronze_OrdersSelectedEventsFULL": ("selected_event_name",),
    "notes": ("note",),
}
