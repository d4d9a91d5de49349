"""

Each dataset is a DataFrame built lazily from a :class:`SourceCatalog`
and a :class:`ReportConfig`. Relations with several readers are staged
(:mod:`tessera.plans.stages`): with a checkpoint folder they are computed
and written when a dataset that reads them is first asked for, so building
the report runs jobs; with ``materialize="none"`` nothing runs before an
action, and Catalyst sees the whole plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import config as C
from tessera.config import ReportConfig
from tessera.functions import (
    classify_like, concat_text, first_nonblank, not_blank, on_or_after, on_or_after_or_null,
    normalize_key, prefixed_key, purchase_source, recode, seat_attribution, yes_or_null,
)
from tessera.operators import (
    duplicate_keys, first_per_key, flag_pivot, joined_text, key_pool, latest_per_key, left_join_spread,
    presence_flag, scope_by_keys, union_all,
)
from tessera.plans.stages import Staged, resolve_mode, stage
from tessera.sources import SourceCatalog


class ReportDatasets:
    """Lazily built intermediate relations of the report."""

    def __init__(self, sources: SourceCatalog, cfg: ReportConfig | None = None) -> None:
        self.cfg = cfg or ReportConfig()
        self.src = sources.with_key_mode(self.cfg.key_mode)
        self._kept: list[Staged] = []

    # ------------------------------------------------------------------
    # drivers
    # ------------------------------------------------------------------
    @cached_property
    def tickets(self) -> DataFrame:
        """Live tickets - event type, date on/after the cutoff or NULL, status list."""
        t = self.src.table("tickets")
        keep = (
            (F.col("event_type_id") == self.cfg.event_type_id)
            & on_or_after_or_null("event_date", self.cfg.cutoff)
            & F.lower(F.col("status")).isin(*self.cfg.ticket_statuses)
        )
        return self._keep(t.where(keep).select(
            "ticket_id", "event_id", "attendee_id", "customer_id", "product_name",
            "ticket_type", "status", "confirmation_status", "event_date", "ticket_price",
            "confirmation_method", "confirmed_date", "travel_details", "outreach_restriction",
            "sales_order_id", "purchaser_email", "is_comped", "undecided_timestamp", "is_walkin",
        ), "tickets")

    @cached_property
    def resets(self) -> DataFrame:
        """No-show reset records of the event type dated on/after the cutoff (NULL dates drop)."""
        r = self.src.table("ticket_no_show_resets")
        return self._keep(r.where((F.col("event_type_id") == self.cfg.event_type_id)
                                  & on_or_after("event_date", self.cfg.cutoff)), "resets")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        """Materialize a relation several later steps read; see :func:`tessera.plans.stages.stage`."""
        return stage(df, self.cfg.materialize, self._kept, name)

    @property
    def writes_tables(self) -> bool:
        """Are stages written (and computed while plans are built)?"""
        return resolve_mode(self.src.spark, self.cfg.materialize) == "table"

    def forget(self, *tables: DataFrame) -> None:
        """Release the given stages, and drop the plans that were built on them: asked for again, they are rebuilt."""
        for staged in [s for s in self._kept if any(s.df is t for t in tables)]:
            staged.release()
            self._kept.remove(staged)
        held = self.held()
        for name, value in list(self.__dict__.items()):
            if isinstance(value, DataFrame) and id(value) not in held:
                del self.__dict__[name]

    def held(self) -> set[int]:
        """Identities of the stages that are held."""
        return {id(s.df) for s in self._kept}

    def release(self) -> None:
        """Release every stage: unpersist it or remove its table."""
        self.forget(*[s.df for s in self._kept])

    @property
    def _text_bounds(self) -> dict[str, int]:
        return {"segments": self.cfg.text_segments, "max_bytes": self.cfg.max_text_bytes}

    # Key pools. As tables they are small scans, which Spark may turn into runtime
    # filters of the large ones (operators/scope.py).
    def _live_keys(self, col: str) -> DataFrame:
        """Distinct keys of tickets ∪ resets."""
        return self._keep(key_pool((self.tickets, col), (self.resets, col)), f"pool-{col}")

    @cached_property
    def ticket_pool(self) -> DataFrame:
        return self._live_keys("ticket_id")

    @cached_property
    def attendee_pool(self) -> DataFrame:
        return self._live_keys("attendee_id")

    @cached_property
    def customer_pool(self) -> DataFrame:
        return self._live_keys("customer_id")

    @cached_property
    def order_pool(self) -> DataFrame:
        return self._live_keys("sales_order_id")

    @cached_property
    def live_ticket_pool(self) -> DataFrame:
        """Ticket ids of the live tickets alone."""
        return self._keep(key_pool((self.tickets, "ticket_id")), "pool-live-tickets")

    @staticmethod
    def _prefixed_pool(pool: DataFrame, prefix: str) -> DataFrame:
        # prefixing is injective, so the prefixed pool stays distinct
        return pool.select(prefixed_key(prefix, F.col(pool.columns[0])).alias(pool.columns[0]))

    @property
    def collated(self) -> bool:
        """Are keys and codes collated strings?"""
        return self.cfg.key_mode == "ci_rtrim"

    def _computed_key(self, col):
        """A key that is computed, and not read from a source, as one of the sources' kind."""
        return normalize_key(col, self.cfg.key_mode) if self.collated else col

    def _scope(self, df: DataFrame, key, pool_fn) -> DataFrame:
        """``df`` restricted to keys in the pool (skipped when scoping is off)."""
        return scope_by_keys(df, key, pool_fn()) if self.cfg.scope_sources else df

    # ------------------------------------------------------------------
    # scoped dimensions
    # ------------------------------------------------------------------
    @cached_property
    def attendees(self) -> DataFrame:
        """Attendees used by a ticket or a reset."""
        a = self.src.table("attendees").select(
            "attendee_id", "person_id", "attendee_name", "attendee_email", "attendee_phone",
            "dietary_restrictions")
        return self._keep(self._scope(a, "attendee_id", lambda: self.attendee_pool), "attendees")

    @cached_property
    def customers(self) -> DataFrame:
        """Customers used by a ticket or a reset, renamed."""
        c = self.src.table("customers").select(
            F.col("id").alias("customer_id"), F.col("name").alias("company_name"),
            "cv_customer_id", "abr", "vertical", F.col("status").alias("customer_status"))
        return self._keep(self._scope(c, "customer_id", lambda: self.customer_pool), "customers")

    @cached_property
    def dim_customer_base(self) -> DataFrame:
        """One read of the customer dimension for four consumers (not deduplicated)."""
        dc = self.src.table("DimCustomer")
        # every consumer is left-joined on cv_customer_id from customers or resets,
        # so only those keys can ever match
        dc = self._scope(dc, "CVCustomerID", lambda: self.cv_pool)
        return self._keep(dc.where(F.col("CVCustomerID").isNotNull()).select(
            F.col("CVCustomerID").alias("cv_customer_id"), "NetSuiteID",
            F.col("VerticalName").alias("vertical"), "AnnualBusinessRevenueName",
            yes_or_null(F.col("First10X360PurchaseDate").isNotNull()).alias("is_10x360_flag"),
            F.col("First10X360PurchaseDate").alias("first_10x360_purchase_date")), "dim-customer")

    @cached_property
    def cv_pool(self) -> DataFrame:
        """Distinct cv_customer_id of the scoped customers and of the resets."""
        return self._keep(key_pool((self.customers, "cv_customer_id"), (self.resets, "cv_customer_id")), "cv-pool")

    @cached_property
    def dim_customer(self) -> DataFrame:
        """(cv_customer_id, vertical)."""
        return self.dim_customer_base.select("cv_customer_id", "vertical")

    # ------------------------------------------------------------------
    # per-ticket text and flags
    # ------------------------------------------------------------------
    @cached_property
    def sessions(self) -> DataFrame:
        """Ticket -> distinct room classes of its sessions at the ticket's event."""
        ats = self.src.table("attendee_ticket_sessions")
        att = self.src.table("attendee_tickets")
        es = self.src.table("silver_EventSession")
        t = self.tickets.select(F.col("ticket_id").alias("t_ticket_id"), F.col("event_id").alias("t_event_id"))
        # The session LEFT JOIN is followed by a NULL-rejecting WHERE on it: an
        # inner join. All joins are inner, so start from the live tickets and
        # never join the full bridge tables with each other.
        live = att.join(t, att["ticket_id"] == t["t_ticket_id"], "inner")
        j = (live.join(ats, "attendee_ticket_id", "inner")
                 .join(es, (ats["event_session_code"] == es["CVEventSessionID"]) & (es["Event"] == F.col("t_event_id")),
                       "inner"))
        rooms = j.select(att["ticket_id"].alias("ticket_id"),
                         classify_like(es["SessionName"], C.ROOM_CLASSES).alias("room_type"))
        rooms = rooms.where(F.col("room_type").isNotNull())
        return joined_text(rooms, "ticket_id", "room_type", C.ROOM_SEPARATOR,
                           alias="room_origination", distinct=True)

    @cached_property
    def session_checkins(self) -> DataFrame:
        """Ticket -> four check-in flags from printed, not undone kiosk badges."""
        ku = self.src.table("kiosk_usage").where(
            (F.col("flow_type") == C.CHECKIN_FLOW_TYPE)
            & F.col("check_in_undone_at").isNull()
            & F.col("ticket_id").isNotNull()).select("ticket_id", "session_id", "event_id")
        # only live tickets read the check-ins
        ku = self._scope(ku, "ticket_id", lambda: self.live_ticket_pool)
        kr = self.src.table("kiosk_registrations").select("session_id", "event_id", "session_name")
        j = ku.join(kr, ["session_id", "event_id"], "inner")
        return flag_pivot(j, "ticket_id", "session_name", C.CHECKIN_FLAGS)

    # ------------------------------------------------------------------
    # CRM / ERP
    # ------------------------------------------------------------------
    @cached_property
    def _first_company(self) -> DataFrame:
        """Customer key -> its first company (for B08)."""
        companies = self.src.table("silver_Companies").where(F.col("CVCustomerID").isNotNull())
        # top-1 per key only looks at rows of that key: scoping the keys is exact
        companies = self._scope(companies, "CVCustomerID", lambda: self.cv_pool)
        return self._keep(first_per_key(companies, "CVCustomerID", "CompanyID").select(
            F.col("CVCustomerID").alias("hc_cv_customer_id"), F.col("CompanyID").alias("hc_company_id")), "company")

    @cached_property
    def hubspot_abr(self) -> DataFrame:
        """Revenue per customer-dimension row: owner contact's (latest) if not blank, else the dimension's."""
        first_company = self._first_company
        contacts = self.src.table("silver_Contacts").where(
            (F.col("BusinessOwner") == 1) & F.col("AnnualBusinessRevenue").isNotNull())
        assoc = self._scope(self.src.table("silver_ContactCompanyAssoc"), "CompanyID",
                            lambda: key_pool((first_company, "hc_company_id")))
        owner = assoc.join(contacts, "ContactID", "inner").select(
            "CompanyID", "ContactID", "AnnualBusinessRevenue", "UpdatedAtUTC")
        latest_owner = latest_per_key(owner, "CompanyID", "UpdatedAtUTC", tiebreak="ContactID").select(
            F.col("CompanyID").alias("sc_company_id"), F.col("AnnualBusinessRevenue").alias("sc_abr"))
        dcb = self.dim_customer_base
        j = dcb.join(first_company, dcb["cv_customer_id"] == first_company["hc_cv_customer_id"], "left")
        # customers without a company are many: their NULL key is spread
        j = left_join_spread(j, latest_owner, "hc_company_id", "cv_customer_id", dim_key="sc_company_id")
        return j.select("cv_customer_id",
                        first_nonblank("sc_abr", "AnnualBusinessRevenueName").alias("annual_business_revenue"))

    @cached_property
    def ryb_purchases(self) -> DataFrame:
        """Customer -> item of its latest qualifying ERP line."""
        txn = self.src.table("silver_Transaction").where(
            F.col("ItemName").contains(C.RYB_ITEM_PATTERN)
            & (F.col("SubsidiaryID") == C.RYB_SUBSIDIARY_ID)
            & F.col("TransactionType").isin(*C.RYB_TRANSACTION_TYPES)
        ).select("EntityID", "ItemName", "TransactionDate", "TransactionID")
        dcb = self.dim_customer_base.select("cv_customer_id", "NetSuiteID")
        j = dcb.join(txn, dcb["NetSuiteID"] == txn["EntityID"], "inner")
        top = latest_per_key(j, "cv_customer_id", "TransactionDate", tiebreak=["TransactionID", "ItemName"])
        return top.select("cv_customer_id", "ItemName")

    @cached_property
    def is_10x360(self) -> DataFrame:
        """Distinct (customer, flag, first purchase date)."""
        return self.dim_customer_base.select(
            "cv_customer_id", "is_10x360_flag", "first_10x360_purchase_date").distinct()

    @cached_property
    def _transactions(self) -> DataFrame:
        """Payment lines of live sales orders (one read for B11 and B13)."""
        return self._keep(self._scope(self.src.table("transactions"), "sales_order_id",
                                      lambda: self.order_pool), "transactions")

    @cached_property
    def _erp_lines(self) -> DataFrame:
        """ERP lines of live sales orders (one read for B14 and B20)."""
        lines = self.src.table("silver_Transaction").where(F.col("TransactionType") == C.SALES_ORDER_TYPE).select(
            "TransactionDisplayName", "SalesRepName", "SalesRep2Name", "TransactionID", "TransactionLineID")
        return self._keep(self._scope(lines, "TransactionDisplayName",
                                      lambda: self._prefixed_pool(self.order_pool, C.SALES_ORDER_PREFIX)), "erp-lines")

    @cached_property
    def refunds(self) -> DataFrame:
        """Sales order -> 'Yes - ' + its refund reasons (NULL if every reason is NULL)."""
        tr = self._transactions.where(F.col("refund_amount") > 0)
        return joined_text(tr, "sales_order_id", "refund_reason", C.REFUND_SEPARATOR,
                           alias="refund_info", prefix=C.REFUND_PREFIX, **self._text_bounds)

    @cached_property
    def ticket_notes(self) -> DataFrame:
        """Ticket -> its notes, system notes excluded (NULL notes drop)."""
        n = self.src.table("notes")
        keep = None
        for p in C.NOTE_EXCLUDED_PATTERNS:
            term = ~F.col("note").contains(p)
            keep = term if keep is None else keep & term
        n = self._scope(n.where(keep), "ticket_id", lambda: self.ticket_pool)
        n = n.withColumn("note", F.col("note").cast("string"))  # spellings stay apart in the text
        return self._keep(joined_text(n, "ticket_id", "note", C.NOTES_SEPARATOR, alias="notes",
                                      **self._text_bounds), "notes")

    @cached_property
    def ticket_transactions(self) -> DataFrame:
        """Sales order -> first transaction date."""
        return self._transactions.groupBy("sales_order_id").agg(F.min("transaction_date").alias("date_of_purchase"))

    @cached_property
    def netsuite(self) -> DataFrame:
        """Sales-order display name -> max rep 1, max rep 2, min transaction id (independent)."""
        nt = self._erp_lines.where(F.col("TransactionLineID") != 0)
        return nt.groupBy("TransactionDisplayName").agg(
            F.max("SalesRepName").alias("SalesRepName"),
            F.max("SalesRep2Name").alias("SalesRep2Name"),
            F.min("TransactionID").alias("TransactionID"))

    def _recode_rep(self, df: DataFrame, col: str) -> DataFrame:
        """``col`` through the alias table; without one, aliases must be given (``()`` for none)."""
        if self.cfg.rep_aliases is not None:
            if not self.cfg.rep_aliases:
                return df
            return df.withColumn(col, self._computed_key(recode(col, self.cfg.rep_aliases, collated=self.collated)))
        if not self.src.has("rep_aliases"):
            raise KeyError("no rep_aliases table: provide one, or set ReportConfig.rep_aliases "
                           "(an empty tuple if no name needs an alias)")
        aliases = first_per_key(self.src.table("rep_aliases"), "source_name", "alias").select(
            "source_name", F.col("alias").alias("__alias"), F.lit(True).alias("__listed"))
        j = left_join_spread(df, aliases, col, "TransactionDisplayName", dim_key="source_name")
        return j.withColumn(col, F.when(F.col("__listed"), F.col("__alias")).otherwise(F.col(col).cast("string"))) \
                .withColumn(col, self._computed_key(F.col(col))).drop("__alias", "__listed")

    @cached_property
    def netsuite_names(self) -> DataFrame:
        """B14 with both rep names recoded through the alias table (unknown names pass)."""
        return self._recode_rep(self._recode_rep(self.netsuite, "SalesRepName"), "SalesRep2Name")

    @cached_property
    def dim_employee(self) -> DataFrame:
        """Distinct (employee name, email) with an email."""
        return (self.src.table("DimEmployee").where(F.col("Email").isNotNull())
                .select("EmployeeName", "Email").distinct())

    @cached_property
    def hubspot_person(self) -> DataFrame:
        """Person id -> latest contact id."""
        hc = self.src.table("silver_Contacts").where(F.col("CVPersonID").isNotNull())
        hc = self._scope(hc, "CVPersonID", lambda: key_pool((self.attendees, "person_id")))
        return latest_per_key(hc, "CVPersonID", "UpdatedAtUTC", tiebreak="ContactID").select(
            "CVPersonID", "ContactID")

    @cached_property
    def hubspot_email(self) -> DataFrame:
        """Lower-cased email -> latest contact id (blank emails excluded)."""
        hc = self.src.table("silver_Contacts").where(not_blank("Email")).select(
            F.lower("Email").alias("Email"), "ContactID", "UpdatedAtUTC")
        hc = self._scope(hc, "Email", lambda: key_pool((self.attendees, F.lower("attendee_email")),
                                                       (self.resets, F.lower("attendee_email"))))
        return self._keep(latest_per_key(hc, "Email", "UpdatedAtUTC", tiebreak="ContactID")
                          .select("Email", "ContactID"), "contact-email")

    @cached_property
    def _history_scoped(self) -> DataFrame:
        """History rows of live tickets (one scoped read for B19, B22, B23)."""
        h = self.src.table("history").where(F.col("action").isin(
            C.CONFIRM_ACTION, C.RESCHEDULE_ACTION, C.UNDECIDED_ACTION))
        return self._keep(self._scope(h, "ticket_id", lambda: self.live_ticket_pool), "history")

    @cached_property
    def confirmed_by(self) -> DataFrame:
        """Ticket -> user of its latest confirmation change (system users and NULL excluded)."""
        h = self._history_scoped.where(
            (F.col("action") == C.CONFIRM_ACTION) & ~F.col("changed_by").isin(*C.SYSTEM_USERS))
        return latest_per_key(h, "ticket_id", "changed_at", tiebreak="changed_by").select(
            "ticket_id", "changed_by")

    # ------------------------------------------------------------------
    # POS chain and decisions
    # ------------------------------------------------------------------
    @cached_property
    def pos_original_event(self) -> DataFrame:
        """(ticket, earliest POS event start of its sales order) via ERP order
        line 0 -> POS order -> 'Elite Edge' event.

        The two drivers (tickets, resets) are unioned first so the chain of
        four inner joins runs once. Its only reader (B21) takes the minimum.
        """
        drivers = union_all([
            self.tickets.where(F.col("sales_order_id").isNotNull()).select("ticket_id", "sales_order_id"),
            self.resets.where(F.col("sales_order_id").isNotNull()).select("ticket_id", "sales_order_id"),
        ])
        ns_link = self._erp_lines.where(F.col("TransactionLineID") == 0).select(
            "TransactionID", "TransactionDisplayName").distinct()
        bof = self.src.table("bronze_OrdersFULL")
        bose = self.src.table("bronze_OrdersSelectedEventsFULL").where(
            F.col("selected_event_name").contains(C.POS_EVENT_PATTERN)).select(
            F.col("order_id").alias("bose_order_id"), "selected_event_id")
        evt = self.src.table("silver_Events")
        # The chain runs at the grain of the sales order and is reduced to its
        # earliest event there; only then do tickets join it, so a sales order
        # that many tickets share (a blank one) meets one row.
        orders = drivers.select("sales_order_id").distinct()
        j = (orders
             .join(ns_link, ns_link["TransactionDisplayName"]
                   == concat_text(F.lit(C.SALES_ORDER_PREFIX), orders["sales_order_id"]), "inner")
             .join(bof, bof["sales_order_ids"] == self._computed_key(ns_link["TransactionID"].cast("string")), "inner")
             .join(bose, bose["bose_order_id"] == bof["order_id"], "inner")
             .join(evt, evt["EventID"] == bose["selected_event_id"], "inner"))
        first = j.groupBy("sales_order_id").agg(F.min("StartDate").alias("original_event_date"),
                                                F.lit(True).alias("__found"))
        return (left_join_spread(drivers, first, "sales_order_id", "ticket_id").where("__found")
                .select("ticket_id", "original_event_date"))

    @cached_property
    def pos_original_event_dedup(self) -> DataFrame:
        """Ticket -> earliest POS event start over both origins."""
        return self._keep(self.pos_original_event.groupBy("ticket_id").agg(
            F.min("original_event_date").alias("original_event_date")), "pos-dates")

    @cached_property
    def history_rescheduled(self) -> DataFrame:
        """Live tickets with an assign/unassign change whose old and new values are both set."""
        h = self._history_scoped.where((F.col("action") == C.RESCHEDULE_ACTION)
                                       & not_blank("old_value") & not_blank("new_value"))
        return h.select("ticket_id").distinct()

    @cached_property
    def history_was_undecided(self) -> DataFrame:
        """Live tickets that were once set to undecided."""
        return self._history_scoped.where(F.col("action") == C.UNDECIDED_ACTION).select("ticket_id").distinct()

    @cached_property
    def _ticket_flags(self) -> DataFrame:
        """Live ticket rows with their history flags and POS date (computed once)."""
        t = self.tickets.select("ticket_id", "event_date", "undecided_timestamp", "is_comped", "sales_order_id")
        t = presence_flag(t, self.history_rescheduled, "ticket_id", "hr")
        t = presence_flag(t, self.history_was_undecided, "ticket_id", "hwu")
        return self._keep(t.join(self.pos_original_event_dedup, "ticket_id", "left"), "ticket-flags")

    @cached_property
    def source_of_purchase(self) -> DataFrame:
        """Ticket -> 'POS' / 'Concierge' (:func:`tessera.functions.purchase_source`)."""
        c = F.col
        return self._ticket_flags.select("ticket_id", purchase_source(
            c("event_date"), c("original_event_date"), c("hwu"), c("undecided_timestamp"), c("hr"))
            .alias("source_of_purchase"))

    @cached_property
    def seat_attribution(self) -> DataFrame:
        """Ticket -> who the seat counts for (:func:`tessera.functions.seat_attribution`).

        Joined to B24 on the ticket id as in the original (a duplicated
        ticket id multiplies rows there too; see :meth:`duplicates`).
        """
        sop = self.source_of_purchase.withColumnRenamed("ticket_id", "sop_ticket_id")
        t = self._ticket_flags.join(sop, F.col("ticket_id") == sop["sop_ticket_id"], "inner")
        c = F.col
        return t.select("ticket_id", seat_attribution(
            c("is_comped"), c("sales_order_id"), c("hr"), c("hwu"), c("undecided_timestamp"),
            c("source_of_purchase")).alias("seat_attribution"))

    # ------------------------------------------------------------------
    # checks
    # ------------------------------------------------------------------
    def duplicates(self) -> DataFrame:
        """``dataset, key, rows`` of keys that multiply report rows: duplicated ticket ids and
        repeated keys of the lookups that the original does not make unique (B05, B08, B10, B16)."""
        parts = [("tickets", self.tickets, "ticket_id"), ("dim_customer", self.dim_customer, "cv_customer_id"),
                 ("hubspot_abr", self.hubspot_abr, "cv_customer_id"), ("is_10x360", self.is_10x360, "cv_customer_id"),
                 ("dim_employee", self.dim_employee, "EmployeeName")]
        return union_all([duplicate_keys(df.where(F.col(key).isNotNull()), key)
                          .select(F.lit(name).alias("dataset"), F.col(key).alias("key"), F.col("count").alias("rows"))
                          for name, df, key in parts])
