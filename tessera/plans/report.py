"""

    history (date < cutoff)  UNION ALL  active tickets  UNION ALL  no-show resets
    ORDER BY date, company, attendee

Join strategy. The live branches look up ~20 relations keyed by only four
keys: ticket id, sales-order id, attendee id and customer id (the
customer-dimension lookups hang off the customer's ``cv_customer_id``).
Instead of joining each lookup onto the wide fact row (one shuffle of the
fact per lookup when nothing is small enough to broadcast), the lookups
are first left-joined with each other into one *profile* per key, at the
grain of that key; the fact is then joined to four profiles. Re-associating
left joins this way yields the same rows, including the fan-out of
non-unique lookups (each fact row gets the product of its lookups'
matches, NULLs where none). Each of these joins shuffles the fact by
another key, with missing and blank keys spread, unless AQE finds the
profile small enough to broadcast at runtime.
"""

from __future__ import annotations

import re
import threading
from collections import Counter
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tessera import config as C
from tessera.config import ReportConfig
from tessera.functions import (
    comp_type, date_span_label, normalize_key, prefixed_key, recode, split_first_word, yes_no,
)
from tessera.operators import HotKeys, LookupCounts, hot_keys, hybrid_union, left_join_spread, lookup, union_all
from tessera.operators.union import conform
from tessera.plans.datasets import ReportDatasets
from tessera.plans.stages import run_stages, stage
from tessera.sources import SourceCatalog

S, D, TS, L, MONEY = StringType(), DateType(), TimestampNTZType(), LongType(), DecimalType(18, 2)

# FIXED VALUES: the report's 55 column labels, in output order, with types.
REPORT_COLUMNS: tuple[tuple[str, object], ...] = (
    ("Record Type", S), ("Tab Name", S), ("Seat Attribution", S), ("Product", S),
    ("Ticket Type", S), ("Room Origination - Addition Effort", S), ("Attendee Full Name", S),
    ("First Name", S), ("Last Name", S), ("Attendee Email", S), ("Phone Number", S),
    ("Customer Email", S), ("Company Name", S), ("Date of Purchase", TS),
    ("Original Event Scheduled Date", TS), ("Attendance Confirmed", S), ("Confirmed By", S),
    ("Hotel/Flight Details", S), ("Confirmation Method", S), ("Confirmation Date", D),
    ("Blast Date", D), ("Do not contact", S), ("Last Called Date", D), ("Notes", S),
    ("Dietary Restrictions", S), ("Refund Request", S), ("Price", MONEY),
    ("Sales Person 1", S), ("Sales Person 1 Name", S), ("Sales Person 2", S),
    ("Sales Person 2 Name", S), ("Source of Purchase", S), ("Comp Type", S),
    ("DATE Selection (DNT)", TS), ("Hubspot Contact ID", L), ("Annual Business Revenue", S),
    ("Vertical", S), ("Elite Status", S), ("Vertical Summit?", S), ("Status", S),
    ("Products Sold At the Event", S), ("10X360", S), ("First 10X360 Purchase Date", TS),
    ("RYB", S), ("TCV", MONEY), ("CV-CustomerID", S), ("CVPersonID", S), ("Attended", S),
    ("Is No Show", S), ("Walk-In", S), ("Registration Day 1", S), ("Registration Day 2", S),
    ("Registration Day 3", S), ("10X Vertical Summit", S), ("Ticket ID", S),
)


def stored_name(label: str) -> str:
    """Column name in the stored history table: the label without blanks or punctuation."""
    return re.sub(r"[^0-9A-Za-z]", "", label)


REPORT_SCHEMA = StructType([StructField(stored_name(n), t, True) for n, t in REPORT_COLUMNS])
DATE_COL = stored_name("DATE Selection (DNT)")
SORT_COLS = (DATE_COL, stored_name("Company Name"), stored_name("Attendee Full Name"))


def with_labels(df: DataFrame) -> DataFrame:
    """Rename stored names to the report's display labels (for the spreadsheet consumer)."""
    return df.toDF(*[n for n, _ in REPORT_COLUMNS])


def _null(t) -> F.Column:
    return F.lit(None).cast(t)


# Stages and the stages that each reads, which stand before it. The names are
# properties of the datasets, or of the report.
STAGES: dict[str, tuple[str, ...]] = {
    "active_columns": (),
    "no_show_columns": (),
    "tickets": (),
    "resets": (),
    "ticket_hot_keys": ("tickets",),
    "reset_hot_keys": ("resets",),
    "live_ticket_pool": ("tickets",),
    "ticket_pool": ("tickets", "resets"),
    "attendee_pool": ("tickets", "resets"),
    "customer_pool": ("tickets", "resets"),
    "order_pool": ("tickets", "resets"),
    "attendees": ("attendee_pool",),
    "customers": ("customer_pool",),
    "_transactions": ("order_pool",),
    "_erp_lines": ("order_pool",),
    "ticket_notes": ("ticket_pool",),
    "_history_scoped": ("live_ticket_pool",),
    "cv_pool": ("customers", "resets"),
    "hubspot_email": ("attendees", "resets"),
    "pos_original_event_dedup": ("tickets", "resets", "_erp_lines"),
    "sales_order_profile": ("tickets", "resets", "_transactions", "_erp_lines"),
    "dim_customer_base": ("cv_pool",),
    "_first_company": ("cv_pool",),
    "_ticket_flags": ("tickets", "_history_scoped", "pos_original_event_dedup"),
    "cv_profile": ("cv_pool", "dim_customer_base", "_first_company"),
    "ticket_facts": ("tickets", "live_ticket_pool", "ticket_notes", "_history_scoped"),
    "attendee_profile": ("attendees", "hubspot_email"),
    "customer_profile": ("customers", "cv_profile"),
}
# what the plans of the two live branches read
BRANCHES: dict[str, tuple[str, ...]] = {
    "active": ("active_columns", "tickets", "ticket_hot_keys", "ticket_facts", "_ticket_flags", "pos_original_event_dedup",
               "sales_order_profile", "attendee_profile", "customer_profile"),
    "no_show": ("no_show_columns", "resets", "reset_hot_keys", "ticket_notes", "pos_original_event_dedup", "sales_order_profile",
                "attendees", "customers", "cv_profile", "hubspot_email"),
}
# the branches' rows as tables: the sort, which reads its input twice, repeats no join
STAGES |= {"active_rows": BRANCHES["active"], "no_show_rows": BRANCHES["no_show"]}


class Report:
    """Builds the report's branches from a source catalog."""

    def __init__(self, sources: SourceCatalog, cfg: ReportConfig | None = None) -> None:
        self.cfg = cfg or ReportConfig()
        self.ds = ReportDatasets(sources, self.cfg)
        self.src = sources
        # counted where stages are written: there every lookup runs once
        self.counts = LookupCounts() if self.ds.writes_tables else None

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, self.cfg.materialize, self.ds._kept, name)

    def _owner(self, name: str) -> object:
        return self if hasattr(type(self), name) else self.ds

    def prepare(self, *kept: str) -> None:
        """Write the stages ``kept`` and those that they need, independent ones at the same time.

        A needed stage is removed when the last stage that reads it has been
        written. Nothing is done where stages are not written, or are written
        already.
        """
        if not self.ds.writes_tables:
            return
        wanted: set[str] = set()

        def want(name: str) -> None:
            if name not in wanted and name not in self._owner(name).__dict__:
                wanted.add(name)
                for read in STAGES[name]:
                    want(read)

        for name in kept:
            want(name)
        readers = Counter(read for name in wanted for read in STAGES[name])
        lock = threading.Lock()

        def done(name: str) -> None:
            with lock:
                for read in STAGES[name]:
                    readers[read] -= 1
                    if not readers[read] and read in wanted and read not in kept:
                        self._forget(read)

        run_stages({name: (lambda name=name: getattr(self._owner(name), name), reads)
                    for name, reads in STAGES.items() if name in wanted}, done)

    def _forget(self, name: str) -> None:
        """Remove a stage; asked for again, it is made again."""
        self.ds.forget(self._owner(name).__dict__.pop(name))
        held = self.ds.held()
        for own in [n for n, v in self.__dict__.items() if isinstance(v, DataFrame) and id(v) not in held]:
            self.__dict__.pop(own, None)

    @cached_property
    def ticket_hot_keys(self) -> dict[str, HotKeys]:
        """Hot join keys of the live tickets, by column."""
        return self._hot_keys(self.ds.tickets, "ticket_id", "sales_order_id", "attendee_id", "customer_id")

    @cached_property
    def reset_hot_keys(self) -> dict[str, HotKeys]:
        """Hot join keys of the resets, by column."""
        keyed = self.ds.resets.withColumn("he_email", normalize_key(F.col("attendee_email"), "lcase"))
        return self._hot_keys(keyed, "ticket_id", "sales_order_id", "attendee_id", "customer_id", "cv_customer_id", "he_email")

    def _hot_keys(self, driver: DataFrame, *keys: str) -> dict[str, HotKeys]:
        # where the driver is a plan and not a table, looking for them would run all of it
        return hot_keys(driver, *keys) if self.ds.writes_tables else {}

    def multiplied(self) -> dict[str, int]:
        """Rows that repeated keys of a lookup added, by lookup, as counted while the report ran.

        For written stages only, and after the report has been written: it
        waits for the queries that hold the lookups.
        """
        return self.counts.multiplied() if self.counts is not None else {}

    def _lookup(self, df: DataFrame, dim: DataFrame, key: str, name: str, dim_key: str | None = None,
                spread_by: str | None = None, hot: HotKeys | None = None) -> DataFrame:
        """A lookup whose key the sources do not guarantee to be unique: refused or counted."""
        return lookup(df, dim, key, unique=self.cfg.unique_lookups, dim_on=dim_key, spread_by=spread_by, name=name,
                      counts=self.counts, hot=hot)

    # ------------------------------------------------------------------
    # profiles: lookups pre-joined at the grain of their key
    # ------------------------------------------------------------------
    @cached_property
    def cv_profile(self) -> DataFrame:
        """cv_customer_id -> vertical, revenue, RYB item, 10X360 flag/date (with fan-out)."""
        ds = self.ds
        keys = ds.cv_pool.withColumnRenamed(ds.cv_pool.columns[0], "cv_customer_id")
        j = self._lookup(keys, ds.dim_customer.withColumnRenamed("vertical", "dc_vertical"), "cv_customer_id", "customer vertical")
        j = self._lookup(j, ds.hubspot_abr, "cv_customer_id", "business revenue")
        j = j.join(ds.ryb_purchases, "cv_customer_id", "left")
        return self._stage(self._lookup(j, ds.is_10x360, "cv_customer_id", "first purchase"), "cv-profile")

    @cached_property
    def customer_profile(self) -> DataFrame:
        """customer_id -> scoped customer columns + its cv profile."""
        c = self.ds.customers
        cvp = self.cv_profile.withColumnRenamed("cv_customer_id", "p_cv_customer_id")
        return self._stage(left_join_spread(c, cvp, "cv_customer_id", "customer_id", dim_key="p_cv_customer_id"),
                           "customer-profile")

    @cached_property
    def sales_order_profile(self) -> DataFrame:
        """sales_order_id -> refund text, purchase date, rep names and rep emails."""
        ds = self.ds
        keys = union_all([ds.tickets.select("sales_order_id"), ds.resets.select("sales_order_id")]) \
            .where(F.col("sales_order_id").isNotNull()).distinct()
        keys = keys.withColumn("so_display_name", prefixed_key(C.SALES_ORDER_PREFIX, F.col("sales_order_id")))
        nsr = ds.netsuite_names.select(
            F.col("TransactionDisplayName").alias("so_display_name"), "SalesRepName", "SalesRep2Name")
        e1 = ds.dim_employee.select(F.col("EmployeeName").alias("e1_name"), F.col("Email").alias("rep1_email"))
        e2 = ds.dim_employee.select(F.col("EmployeeName").alias("e2_name"), F.col("Email").alias("rep2_email"))
        j = (keys.join(ds.refunds, "sales_order_id", "left")
                 .join(ds.ticket_transactions, "sales_order_id", "left")
                 .join(nsr, "so_display_name", "left"))
        # most orders have no second representative: NULL names are spread
        j = self._lookup(j, e1, "SalesRepName", "sales rep 1", "e1_name", "sales_order_id")
        j = self._lookup(j, e2, "SalesRep2Name", "sales rep 2", "e2_name", "sales_order_id")
        return self._stage(j.drop("so_display_name"), "order-profile")

    @cached_property
    def attendee_profile(self) -> DataFrame:
        """attendee_id -> attendee columns + latest HubSpot contact by person and by email."""
        ds = self.ds
        a = ds.attendees
        hp = ds.hubspot_person.select(F.col("CVPersonID").alias("hp_person_id"), F.col("ContactID").alias("hp_contact_id"))
        he = ds.hubspot_email.select(F.col("Email").alias("he_email"), F.col("ContactID").alias("he_contact_id"))
        a = a.withColumn("a_email", normalize_key(F.col("attendee_email"), "lcase"))
        j = left_join_spread(a, hp, "person_id", "attendee_id", dim_key="hp_person_id")
        return self._stage(left_join_spread(j, he, "a_email", "attendee_id", dim_key="he_email").drop("a_email"),
                           "attendee-profile")

    @cached_property
    def ticket_facts(self) -> DataFrame:
        """ticket_id (live tickets) -> rooms, notes, confirmer, check-ins."""
        ds = self.ds
        keys = ds.tickets.select("ticket_id").where(F.col("ticket_id").isNotNull()).distinct()
        return self._stage(keys
                .join(ds.sessions, "ticket_id", "left")
                .join(ds.ticket_notes, "ticket_id", "left")
                .join(ds.confirmed_by, "ticket_id", "left")
                .join(ds.session_checkins, "ticket_id", "left"), "ticket-facts")

    @cached_property
    def ticket_profile(self) -> DataFrame:
        """ticket_id (live tickets) -> the facts, POS date and decisions."""
        ds = self.ds
        return (self.ticket_facts
                .join(ds.pos_original_event_dedup, "ticket_id", "left")
                .join(ds.source_of_purchase, "ticket_id", "left")
                .join(ds.seat_attribution, "ticket_id", "left"))

    @cached_property
    def reset_ticket_profile(self) -> DataFrame:
        """ticket_id (resets) -> notes, POS date."""
        ds = self.ds
        keys = ds.resets.select("ticket_id").where(F.col("ticket_id").isNotNull()).distinct()
        return (keys.join(ds.ticket_notes, "ticket_id", "left")
                    .join(ds.pos_original_event_dedup, "ticket_id", "left"))

    # ------------------------------------------------------------------
    # branches
    # ------------------------------------------------------------------
    @staticmethod
    def _prefixed(df: DataFrame, prefix: str, keep: str) -> DataFrame:
        return df.select(*[F.col(c).alias(c if c == keep else prefix + c) for c in df.columns])

    def _abr(self, col: F.Column) -> F.Column:
        return recode(col, C.ABR_RECODE, null_codes=C.ABR_NULL_CODES, collated=self.ds.collated)

    def _vertical(self, col: F.Column) -> F.Column:
        return recode(col, C.VERTICAL_RECODE, collated=self.ds.collated)

    # The output columns need no data: they are put together while the first stages run.
    @cached_property
    def active_columns(self) -> list[F.Column]:
        """The 55 columns of the active branch, over its joined lookups."""
        first, rest = split_first_word(F.col("a_attendee_name"))
        return [
            F.lit("Active"),
            date_span_label("event_date", C.TAB_SPAN_DAYS),
            F.col("tp_seat_attribution"),
            F.col("product_name"), F.col("ticket_type"),
            F.col("tp_room_origination"),
            F.col("a_attendee_name"), first, rest,
            F.col("a_attendee_email"), F.col("a_attendee_phone"),
            F.col("purchaser_email"), F.col("c_company_name"),
            F.col("so_date_of_purchase"), F.col("tp_original_event_date"),
            F.col("confirmation_status"), F.col("tp_changed_by"),
            F.col("travel_details"), F.col("confirmation_method"), F.col("confirmed_date"),
            _null(D), F.col("outreach_restriction"), _null(D),
            F.col("tp_notes"), F.col("a_dietary_restrictions"), F.col("so_refund_info"),
            F.col("ticket_price"),
            F.col("so_rep1_email"), F.col("so_SalesRepName"),
            F.col("so_rep2_email"), F.col("so_SalesRep2Name"),
            F.col("tp_source_of_purchase"),
            comp_type(F.col("is_comped"), F.col("sales_order_id")),
            F.col("event_date"),
            F.coalesce(F.col("a_hp_contact_id"), F.col("a_he_contact_id")),
            self._abr(F.coalesce(F.col("c_annual_business_revenue"), F.col("c_abr"))),
            F.coalesce(F.col("c_dc_vertical"), self._vertical(F.col("c_vertical"))),
            recode(F.col("c_customer_status"), C.ELITE_STATUS_RECODE, default="null", collated=self.ds.collated),
            _null(S), F.col("status"), _null(S),
            F.col("c_is_10x360_flag"), F.col("c_first_10x360_purchase_date"),
            F.col("c_ItemName"), _null(MONEY),
            F.col("c_cv_customer_id"), F.col("a_person_id"),
            yes_no(F.lower(F.col("status")) == "attended"),
            F.lit("No"),
            yes_no(F.col("is_walkin") == 1),
            *[F.col(f"tp_{name}") for name, _ in C.CHECKIN_FLAGS],
            F.col("ticket_id"),
        ]

    @cached_property
    def no_show_columns(self) -> list[F.Column]:
        """The 55 columns of the no-show branch, over its joined lookups."""
        first, rest = split_first_word(F.col("attendee_name"))
        return [
            F.lit("No Show Reset"),
            date_span_label("event_date", C.TAB_SPAN_DAYS),
            _null(S),
            F.col("product_name"), F.col("ticket_type"),
            _null(S),
            F.col("attendee_name"), first, rest,
            F.col("attendee_email"), F.col("attendee_phone"),
            F.col("purchaser_email"), F.col("customer_name"),
            F.col("so_date_of_purchase"), F.col("tp_original_event_date"),
            F.col("confirmation_status"), F.col("confirmed_by"),
            F.col("travel_details"), F.col("confirmation_method"), F.col("confirmed_date"),
            _null(D), F.col("outreach_restriction"), _null(D),
            F.col("tp_notes"), F.col("a_dietary_restrictions"), F.col("so_refund_info"),
            F.col("ticket_price"),
            F.col("so_rep1_email"), F.col("so_SalesRepName"),
            F.col("so_rep2_email"), F.col("so_SalesRep2Name"),
            _null(S),
            comp_type(F.col("is_comped"), F.col("sales_order_id")),
            F.col("event_date"),
            F.col("he_contact_id"),
            self._abr(F.coalesce(F.col("cv_annual_business_revenue"), F.col("c_abr"))),
            F.coalesce(F.col("cv_dc_vertical"), self._vertical(F.col("vertical"))),
            F.col("customer_elite_status"),
            _null(S), F.col("source_ticket_status"), _null(S),
            F.col("cv_is_10x360_flag"), F.col("cv_first_10x360_purchase_date"),
            F.col("cv_ItemName"), _null(MONEY),
            F.col("cv_customer_id"), _null(S),
            F.lit("No"), F.lit("Yes"), F.lit("No"),
            _null(S), _null(S), _null(S), _null(S),
            F.col("ticket_id"),
        ]

    @staticmethod
    def _output(df: DataFrame, columns: list[F.Column]) -> DataFrame:
        return conform(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), REPORT_SCHEMA)

    @cached_property
    def active(self) -> DataFrame:
        """B27 (Part B1): one row per live ticket x lookup matches, 55 columns."""
        self.prepare(*BRANCHES["active"])
        t, hot = self.ds.tickets, self.ticket_hot_keys
        tp = self._prefixed(self.ticket_profile, "tp_", "ticket_id")
        so = self._prefixed(self.sales_order_profile, "so_", "sales_order_id")
        ap = self._prefixed(self.attendee_profile, "a_", "attendee_id")
        cp = self._prefixed(self.customer_profile, "c_", "customer_id")
        j = t
        for profile, key in ((tp, "ticket_id"), (so, "sales_order_id"), (ap, "attendee_id"), (cp, "customer_id")):
            j = self._lookup(j, profile, key, f"active: {key}", spread_by="ticket_id", hot=hot.get(key))
        return self._output(j, self.active_columns)

    @cached_property
    def no_show(self) -> DataFrame:
        """B28 (Part B2): one row per reset x lookup matches, 55 columns."""
        self.prepare(*BRANCHES["no_show"])
        r, hot = self.ds.resets, self.reset_hot_keys
        tp = self._prefixed(self.reset_ticket_profile, "tp_", "ticket_id")
        so = self._prefixed(self.sales_order_profile, "so_", "sales_order_id")
        a2 = self.ds.attendees.select(F.col("attendee_id"), F.col("dietary_restrictions").alias("a_dietary_restrictions"))
        c2 = self.ds.customers.select("customer_id", F.col("abr").alias("c_abr"))
        cvp = self._prefixed(self.cv_profile, "cv_", "cv_customer_id")
        he = self.ds.hubspot_email.select(F.col("Email").alias("he_email"), F.col("ContactID").alias("he_contact_id"))
        j = r.withColumn("he_email", normalize_key(F.col("attendee_email"), "lcase"))
        for profile, key in ((tp, "ticket_id"), (so, "sales_order_id"), (a2, "attendee_id"), (c2, "customer_id"),
                             (cvp, "cv_customer_id"), (he, "he_email")):
            j = self._lookup(j, profile, key, f"no-show: {key}", spread_by="ticket_id", hot=hot.get(key))
        return self._output(j, self.no_show_columns)

    @cached_property
    def active_rows(self) -> DataFrame:
        """The active branch as a stage."""
        return self._stage(self.active, "active")

    @cached_property
    def no_show_rows(self) -> DataFrame:
        """The no-show branch as a stage."""
        return self._stage(self.no_show, "no-show")

    def history(self) -> DataFrame | None:
        return self.src.history()

    def duplicates(self) -> DataFrame:
        """Keys that multiply rows of the report; see :meth:`ReportDatasets.duplicates`."""
        return self.ds.duplicates()

    def release(self) -> None:
        """Release all stages (cached or written) once the report has been written."""
        self.ds.release()
        for name in [n for n, v in self.__dict__.items() if isinstance(v, DataFrame) or n in STAGES]:
            del self.__dict__[name]
        self.counts = LookupCounts() if self.ds.writes_tables else None

    def live(self) -> DataFrame:
        """Parts B1 + B2 (no history)."""
        return union_all(self._live_rows())

    def _live_rows(self) -> list[DataFrame]:
        if not self.ds.writes_tables:
            return [self.active, self.no_show]
        self.prepare("active_rows", "no_show_rows")
        return [self.active_rows, self.no_show_rows]

    def build(self, sort: bool = True) -> DataFrame:
        """History before the cutoff + both live branches, sorted."""
        live = self._live_rows()
        hist = self.history()
        if hist is None:
            out = union_all(live)
        else:
            out = hybrid_union(hist, live, REPORT_SCHEMA, self.cfg.cutoff, DATE_COL)
        if sort:
            out = out.orderBy(*[F.col(c).asc_nulls_first() for c in SORT_COLS])
        return out


def build_report(sources: SourceCatalog, cfg: ReportConfig | None = None, sort: bool = True) -> DataFrame:
    return Report(sources, cfg).build(sort=sort)
