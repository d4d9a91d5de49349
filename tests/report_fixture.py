"""Small hand-made inputs in the shape of the report's 22 sources.

Cutoff is the default (2026-08-11). Every value is invented. The rows
cover: NULL / on-cutoff / before-cutoff dates, mixed-case and unknown
statuses, missing attendee / customer / order, NULL and blank sales
orders, a reset sharing a ticket id with a ticket, names of one, two and
three words with odd blanks, all-NULL refund reasons, excluded notes,
sessions matching 0-2 classes, undone / other-flow kiosk rows, ties in
timestamps, blank owner revenue, NULL-coded revenue, unmapped verticals,
independent rep maxima, an employee with two emails, a duplicated
customer-dimension key, system / NULL history users, POS events on and
off the ticket date, and month / year crossing labels.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

D = dt.date
TS = dt.datetime


def ts(y, m, d, h=0):
    return TS(y, m, d, h)


TICKETS = [
    # ticket_id, event_id, attendee_id, customer_id, product_name, ticket_type, status,
    # confirmation_status, event_date, ticket_price, confirmation_method, confirmed_date,
    # travel_details, outreach_restriction, person_id, sales_order_id, purchaser_email,
    # is_comped, undecided_timestamp, enter_dtm, is_walkin, event_type_id
    ("T1", "E1", "A1", "C1", "Summit", "VIP", "Scheduled", "Yes", ts(2026, 8, 11, 9), Decimal("100.00"),
     "Email", D(2026, 7, 1), "Hotel", None, "P1", "1001", "buyer1@x.test", 0, None, None, 1, 12),
    ("T2", "E1", "A2", "C2", "Summit", "GA", "ATTENDED", "No", ts(2026, 8, 30), Decimal("0.00"),
     None, None, None, "Do not call", "P2", None, "buyer2@x.test", 1, None, None, None, 12),
    ("T3", "E2", "A3", None, "Workshop", "GA", "no show", None, None, None,
     None, None, None, None, None, "", None, 1, None, None, 0, 12),
    ("T4", "E1", "A1", "C1", "Summit", "VIP", "scheduled", None, ts(2026, 8, 10, 23), None,
     None, None, None, None, None, "1004", None, 0, None, None, 0, 12),       # before cutoff
    ("T5", "E1", "A1", "C1", "Summit", "VIP", "Cancelled", None, ts(2026, 9, 1), None,
     None, None, None, None, None, None, None, 0, None, None, 0, 12),         # status not listed
    ("T6", "E1", "A1", "C1", "Summit", "VIP", "scheduled", None, ts(2026, 9, 1), None,
     None, None, None, None, None, None, None, 0, None, None, 0, 11),         # other event type
    ("T7", "E3", "A9", "C3", "Summit", "VIP", "reserved", None, ts(2026, 12, 30), Decimal("250.50"),
     None, None, None, None, None, "1002", None, 0, None, None, None, 12),
]

RESETS = [
    # ticket_id, attendee_id, customer_id, sales_order_id, event_type_id, event_date, product_name,
    # ticket_type, attendee_name, attendee_email, attendee_phone, purchaser_email, customer_name,
    # confirmation_status, confirmed_by, travel_details, confirmation_method, confirmed_date,
    # outreach_restriction, ticket_price, is_comped, vertical, customer_elite_status,
    # source_ticket_status, cv_customer_id
    ("T1", "A1", "C1", "1001", 12, ts(2026, 9, 1), "Summit", "VIP", "Mary Ann Smith", "MARY@X.TEST",
     "555-1", "buyer1@x.test", "Acme Reset", "Yes", "carol", None, "Phone", D(2026, 7, 2), None,
     Decimal("100.00"), None, "2", "E125", "no show", "CV1"),
    ("R2", "A4", "C4", None, 12, None, "Summit", "GA", "Nobody", None, None, None, "Delta", None, None,
     None, None, None, None, None, 0, "3", None, "no show", "CV4"),                # NULL date: dropped
    ("R3", "A5", None, "1003", 12, ts(2026, 10, 5), "Summit", "GA", "Ann  Lee  ", "ann@x.test", None,
     None, "Echo", None, None, None, None, None, None, None, 1, "22", None, "no_show", "CV9"),
    ("R4", "A6", "C1", None, 12, ts(2026, 8, 1), "Summit", "GA", "Old One", None, None, None, "Old",
     None, None, None, None, None, None, None, 0, "1", None, "no show", "CV1"),    # before cutoff
]

ATTENDEES = [
    ("A1", "P1", "John Smith", "John@X.test", "555-0001", "Vegan"),
    ("A2", "P2", "Cher", "cher@x.test", None, None),
    ("A3", None, None, None, None, None),
    ("A5", "P5", "Ann Lee", "ann@x.test", None, "Kosher"),
    ("A7", "P7", "Unrelated Person", "u@x.test", None, None),
]

CUSTOMERS = [
    ("C1", "Acme", "CV1", "2 Million +", "3", "3"),
    ("C2", "Beta", "CV2", "To Be Determined", "2", "4"),
    ("C3", "Gamma", "CV3", None, "xyz", "5"),
    ("C8", "Unrelated", "CV8", "1 Million+", "4", "3"),
]

DIM_CUSTOMER = [
    ("CV1", 501, "Roofing", "5 Million+", ts(2024, 1, 1)),
    ("CV2", 502, "Retail", "8", None),
    ("CV2", 502, "Retail2", "8", None),           # duplicated key: fans out
    (None, 503, "Ghost", None, None),
]

SILVER_COMPANIES = [("CV1", 20), ("CV1", 10), ("CV2", 30), (None, 40)]
CONTACT_ASSOC = [(10, 100), (10, 101), (30, 102), (20, 103)]
SILVER_CONTACTS = [
    # ContactID, AnnualBusinessRevenue, UpdatedAtUTC, BusinessOwner, CVPersonID, Email
    (100, "1 Million+", ts(2026, 1, 1), 1, "P1", "john@x.test"),
    (101, "", ts(2026, 2, 1), 1, "P1", "JOHN@x.test"),          # latest owner, blank revenue
    (102, None, ts(2026, 3, 1), 1, None, ""),
    (103, "9 Million+", ts(2026, 4, 1), 0, "P2", "cher@x.test"),  # not an owner
    (104, "7 Million+", ts(2026, 4, 1), 0, "P2", None),            # tie on UpdatedAtUTC with 103
]

SILVER_TRANSACTION = [
    # EntityID, ItemName, TransactionDate, SubsidiaryID, TransactionType, TransactionDisplayName,
    # SalesRepName, SalesRep2Name, TransactionID, TransactionLineID
    (501, "RYB Kit", ts(2026, 1, 5), 11, "Sales Order", "Sales Order #1001", "Zed Rep", "Amy Rep", 9001, 1),
    (501, "RYB Pro", ts(2026, 3, 5), 11, "Cash Sale", "Cash Sale #77", None, None, 9002, 1),
    (501, "RYB Old", ts(2026, 5, 1), 12, "Sales Order", "Sales Order #55", None, None, 9010, 1),
    (501, "Book", ts(2026, 6, 1), 11, "Sales Order", "Sales Order #56", None, None, 9011, 1),
    (None, "Other", ts(2026, 1, 1), 11, "Sales Order", "Sales Order #1001", "Bob Rep", "Zoe Rep", 9003, 2),
    (None, None, ts(2026, 1, 1), 11, "Sales Order", "Sales Order #1001", None, None, 9000, 0),
    (None, None, ts(2026, 1, 1), 11, "Sales Order", "Sales Order #1002", None, None, 9100, 0),
    (None, None, ts(2026, 1, 1), 11, "Invoice", "Sales Order #1002", "Inv Rep", None, 9101, 3),
]

BRONZE_ORDERS = [("O1", "9000"), ("O2", "9100"), ("O3", "9999")]
BRONZE_ORDER_EVENTS = [
    ("O1", "Elite Edge August", "EV1"),
    ("O1", "Other Event", "EV2"),
    ("O2", "Elite Edge December", "EV3"),
]
SILVER_EVENTS = [("EV1", ts(2026, 8, 11)), ("EV2", ts(2026, 1, 1)), ("EV3", ts(2026, 12, 1))]

DIM_EMPLOYEE = [
    ("Zed Rep", "zed@x.test"),
    ("Zed Rep", "zed2@x.test"),      # two emails: fans out
    ("Zed Rep", "zed@x.test"),       # exact duplicate: removed by DISTINCT
    ("Zoe Rep", None),
]

TRANSACTIONS = [
    # sales_order_id, refund_reason, refund_amount, transaction_date
    ("1001", "Late", Decimal("10.00"), ts(2026, 7, 1)),
    ("1001", "Dup", Decimal("5.00"), ts(2026, 6, 1)),
    ("1001", None, Decimal("0.00"), ts(2026, 5, 1)),
    ("1002", None, Decimal("3.00"), ts(2026, 7, 2)),
    ("9999", "x", Decimal("1.00"), ts(2020, 1, 1)),
]

NOTES = [
    ("T1", "Call back"),
    ("T1", "Created from POS import"),
    ("T1", "Also VIP"),
    ("T1", None),
    ("T7", "Created from Fabric sync"),
    ("R3", "Reset note"),
]

HISTORY = [
    # ticket_id, action, changed_by, old_value, new_value, changed_at
    ("T1", "Confirmation status updated", "alice", None, None, ts(2026, 7, 1)),
    ("T1", "Confirmation status updated", "System", None, None, ts(2026, 7, 5)),
    ("T1", "Confirmation status updated", None, None, None, ts(2026, 7, 6)),
    ("T2", "Event assigned/unassigned", "bob", "E0", "E1", ts(2026, 7, 1)),
    ("T7", "Event assigned/unassigned", "bob", "", "E3", ts(2026, 7, 1)),
    ("T7", "Status changed to undecided", "x", None, None, ts(2026, 7, 2)),
    ("R3", "Status changed to undecided", "x", None, None, ts(2026, 7, 2)),
]

ATTENDEE_TICKETS = [("AT1", "T1"), ("AT2", "T2")]
ATTENDEE_TICKET_SESSIONS = [("AT1", "S1"), ("AT1", "S2"), ("AT1", "S3"), ("AT1", "S1"), ("AT2", "S4")]
EVENT_SESSIONS = [
    ("S1", "E1", "Vertical Summit Roofing"),
    ("S2", "E1", "Roofing Founders Dinner"),
    ("S3", "E9", "10X360 Implementation"),      # another event
    ("S4", "E1", "Lunch"),
]

KIOSK_USAGE = [
    ("T1", "K1", "E1", "badge_printed", None),
    ("T1", "K2", "E1", "badge_printed", ts(2026, 8, 12)),   # undone
    ("T1", "K3", "E1", "scan", None),                       # other flow
    (None, "K1", "E1", "badge_printed", None),              # no ticket
    ("T2", "K4", "E1", "badge_printed", None),
]
KIOSK_REGISTRATIONS = [
    ("K1", "E1", "General Session Day 1"),
    ("K2", "E1", "General Session Day 2"),
    ("K3", "E1", "General Session Day 3"),
    ("K4", "E1", "Vertical Summit Lunch"),
]

REP_ALIASES = [("Zed Rep", "Zed Rep"), ("Bob Rep", "Robert Rep")]

SOURCES = {
    "tickets": TICKETS,
    "ticket_no_show_resets": RESETS,
    "attendees": ATTENDEES,
    "customers": CUSTOMERS,
    "attendee_ticket_sessions": ATTENDEE_TICKET_SESSIONS,
    "attendee_tickets": ATTENDEE_TICKETS,
    "silver_EventSession": EVENT_SESSIONS,
    "kiosk_usage": KIOSK_USAGE,
    "kiosk_registrations": KIOSK_REGISTRATIONS,
    "transactions": TRANSACTIONS,
    "notes": NOTES,
    "history": HISTORY,
    "DimCustomer": DIM_CUSTOMER,
    "DimEmployee": DIM_EMPLOYEE,
    "silver_Companies": SILVER_COMPANIES,
    "silver_ContactCompanyAssoc": CONTACT_ASSOC,
    "silver_Contacts": SILVER_CONTACTS,
    "silver_Transaction": SILVER_TRANSACTION,
    "bronze_OrdersFULL": BRONZE_ORDERS,
    "bronze_OrdersSelectedEventsFULL": BRONZE_ORDER_EVENTS,
    "silver_Events": SILVER_EVENTS,
    "rep_aliases": REP_ALIASES,
}
