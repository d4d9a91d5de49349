"""Report parameters.

Everything the report treats as business data (cutoff date, codes,
patterns, recode tables) lives here, not in the operators, so a run can
override it through :class:`ReportConfig`.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# --------------------------------------------------------------------------
# FIXED VALUES - these must equal the original report's literals for the
# results to match. Listed in the order the original report states them.
# --------------------------------------------------------------------------

CUTOFF = "2026-08-11"
EVENT_TYPE_ID = 12

TICKET_STATUSES = (
    "scheduled", "attended", "no show", "no_show", "assigned", "reserved", "expired",
)

# session name pattern -> room class (first match wins)
ROOM_CLASSES = (
    ("Vertical Summit", "Vertical Summit"),
    ("Roofing Founders", "Roofing Founders Summit"),
    ("10X360 Implementation", "10X360 Implementation"),
)

# check-in flag column -> kiosk session name pattern
CHECKIN_FLAGS = (
    ("Registration Day 1", "General Session Day 1"),
    ("Registration Day 2", "General Session Day 2"),
    ("Registration Day 3", "General Session Day 3"),
    ("10X Vertical Summit", "Vertical Summit"),
)
CHECKIN_FLOW_TYPE = "badge_printed"

RYB_ITEM_PATTERN = "RYB"
RYB_SUBSIDIARY_ID = 11
RYB_TRANSACTION_TYPES = ("Sales Order", "Cash Sale")

SALES_ORDER_TYPE = "Sales Order"
SALES_ORDER_PREFIX = "Sales Order #"
POS_EVENT_PATTERN = "Elite Edge"

NOTE_EXCLUDED_PATTERNS = ("Created from POS", "Created from Fabric")
REFUND_PREFIX = "Yes - "
REFUND_SEPARATOR = "; "
NOTES_SEPARATOR = " | "
ROOM_SEPARATOR = ", "

CONFIRM_ACTION = "Confirmation status updated"
SYSTEM_USERS = ("System", "bulk-import")
RESCHEDULE_ACTION = "Event assigned/unassigned"
UNDECIDED_ACTION = "Status changed to undecided"

# annual business revenue: text -> label; codes in ABR_NULL_CODES become NULL,
# anything else passes through unchanged
ABR_RECODE = (
    ("1 Million+", "$1 Million+"),
    ("2 Million +", "$2 Million+"),
    ("2 Million+", "$2 Million+"),
    ("3 Million+", "$3 Million+"),
    ("4 Million+", "$4 Million+"),
    ("5 Million+", "$5 Million+"),
    ("6 Million+", "$6 Million+"),
    ("7 Million+", "$7 Million+"),
    ("8 Million+", "$8 Million+"),
    ("9 Million+", "$9 Million+"),
    ("10 Million+", "$10 Million+"),
    ("20 Million+", "$20 Million+"),
    ("30 Million+", "$30 Million+"),
    ("50 Million+", "$50 Million+"),
    ("100 Million+", "$100 Million+"),
    ("Under $100k", "Under $100k"),
    ("No Business Revenue", "No Business Revenue"),
)
ABR_NULL_CODES = ("To Be Determined", "8")

# vertical code -> vertical name; unknown codes pass through
VERTICAL_RECODE = (
    ("1", "To Be Determined"),
    ("3", "Automotive"),
    ("4", "Community Services"),
    ("5", "Construction"),
    ("6", "Education"),
    ("7", "Extractive Industries"),
    ("8", "Farm & Ranch"),
    ("9", "Health Care"),
    ("10", "Home Services"),
    ("11", "HVAC, Plumbing & Electrical"),
    ("12", "Information Technology"),
    ("13", "Insurance"),
    ("14", "Leasing and Renting"),
    ("15", "Manufacturing"),
    ("16", "Professional Services"),
    ("17", "Real Estate"),
    ("18", "Repair and Maintenance"),
    ("19", "Retail"),
    ("20", "Roofing"),
    ("21", "Warehouse and Storage"),
    ("22", "Wholesale"),
)

# customer status code -> elite status; unknown codes become NULL
ELITE_STATUS_RECODE = (("3", "E125"), ("4", "E250"))

TAB_SPAN_DAYS = 2

# labels of the decisions
SOURCE_POS = "POS"
SOURCE_CONCIERGE = "Concierge"
SEAT_RESCHEDULED_COMP = "Rescheduled + Comp"
SEAT_COMP = "Comp"
SEAT_RESCHEDULED_UNDECIDED = "Rescheduled + Undecided"
SEAT_RESCHEDULED = "Rescheduled"
SEAT_SALES = "Sales"
SEAT_UNDECIDED = "Undecided"
COMP_ORDER = "Comp - Sales Order"
COMP_NO_ORDER = "Comp - No Sales Order"

# --------------------------------------------------------------------------
# end of fixed values
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ReportConfig:
    """Run parameters of the report.

    ``rep_aliases`` maps sales-rep names as the ERP spells them to the
    names used in the employee dimension. It holds personal names, so it
    is deployment data: pass it here (or as a two-column table through
    ``SourceCatalog``), it is never part of the code. ``None`` (the default)
    requires the table; an empty tuple states that there are no aliases.

    ``key_mode`` is the comparison rule of keys, codes and status values,
    applied once to each source: ``binary_rtrim`` (trailing blanks do not
    count, as on the original's server), ``binary``, or ``ci_rtrim`` (nor does
    case, also in groups, partitions and substring tests).
    """

    cutoff: _dt.date = _dt.date.fromisoformat(CUTOFF)
    event_type_id: int = EVENT_TYPE_ID
    ticket_statuses: tuple[str, ...] = TICKET_STATUSES
    rep_aliases: tuple[tuple[str, str], ...] | None = None
    key_mode: str = "binary_rtrim"
    # Restrict dimension reads to the keys the live rows use (semi-joins).
    # Results are the same either way; off is only for checking that.
    scope_sources: bool = True
    # Refuse lookup keys that have several rows (the run fails and names the
    # key); off, such keys multiply rows, as in the original, and are counted.
    unique_lookups: bool = False
    # Joined texts (notes, refund reasons): range segments that a key's rows are
    # split into (0: none), and the longest text of one key, above which a run fails.
    text_segments: int = 0
    max_text_bytes: int = 64 << 20
    # How relations that several steps read are materialized while the plan is
    # built: "auto" = written as Parquet under spark.checkpoint.dir when the
    # session names one, else persist(MEMORY_AND_DISK); or "table",
    # "persist", "none" (inline everything into one plan).
    materialize: str = "auto"
