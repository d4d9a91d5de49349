"""Pipeline tests of the full report on the hand-made fixture."""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
import tempfile
from collections import Counter
from decimal import Decimal

import pytest

from tessera.config import ReportConfig
from tessera.plans.report import REPORT_SCHEMA, SORT_COLS, Report, stored_name, with_labels
from tessera.sources import SourceCatalog, frames_from_rows, read_history, write_history


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def report_rows(fixture_sources):
    return rows_of(Report(fixture_sources).build())


def by_ticket(rows, record_type):
    out = {}
    for r in rows:
        if r["RecordType"] == record_type:
            out.setdefault(r["TicketID"], []).append(r)
    return out


def test_schema_and_names(fixture_sources):
    df = Report(fixture_sources).build()
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in REPORT_SCHEMA]
    assert len(df.columns) == 55
    assert SORT_COLS == ("DATESelectionDNT", "CompanyName", "AttendeeFullName")
    assert stored_name("Room Origination - Addition Effort") == "RoomOriginationAdditionEffort"
    assert with_labels(df).columns[33] == "DATE Selection (DNT)"


def test_row_counts_include_fan_out(report_rows):
    active = by_ticket(report_rows, "Active")
    resets = by_ticket(report_rows, "No Show Reset")
    # T4 before cutoff, T5 status not listed, T6 other event type -> absent
    assert set(active) == {"T1", "T2", "T3", "T7"}
    # Employee with two emails; T2: duplicated customer-dimension key (x2 vertical, x2 revenue)
    assert {k: len(v) for k, v in active.items()} == {"T1": 2, "T2": 4, "T3": 1, "T7": 1}
    # R2 has a NULL date, R4 is before the cutoff
    assert {k: len(v) for k, v in resets.items()} == {"T1": 2, "R3": 1}


def test_sort_order_nulls_first(report_rows):
    dates = [r["DATESelectionDNT"] for r in report_rows]
    assert dates[0] is None
    rest = dates[1:]
    assert rest == sorted(rest)


def test_active_ticket_values(report_rows):
    t1 = by_ticket(report_rows, "Active")["T1"]
    r = t1[0]
    assert r["TabName"] == "August 11-13 2026"
    assert r["SeatAttribution"] == "Sales"
    assert r["SourceofPurchase"] == "POS"          # POS event date equals the ticket date
    assert r["RoomOriginationAdditionEffort"] == "Roofing Founders Summit, Vertical Summit"
    assert (r["FirstName"], r["LastName"]) == ("John", "Smith")
    assert r["DateofPurchase"] == dt.datetime(2026, 5, 1)   # min over all transactions, refund or not
    assert r["OriginalEventScheduledDate"] == dt.datetime(2026, 8, 11)
    assert r["ConfirmedBy"] == "alice"                   # System and NULL users excluded
    assert r["Notes"] == "Also VIP | Call back"          # system notes and NULL excluded
    assert r["RefundRequest"] == "Yes - Dup; Late"
    assert r["Price"] == Decimal("100.00")
    assert {x["SalesPerson1"] for x in t1} == {"zed@x.test", "zed2@x.test"}
    assert r["SalesPerson1Name"] == "Zed Rep" and r["SalesPerson2Name"] == "Zoe Rep"  # independent maxima
    assert r["SalesPerson2"] is None                     # employee without email dropped
    assert r["HubspotContactID"] == 101
    assert r["AnnualBusinessRevenue"] == "$5 Million+"   # blank owner revenue falls back to the dimension
    assert r["Vertical"] == "Roofing"
    assert r["EliteStatus"] == "E125"
    assert r["10X360"] == "Yes" and r["First10X360PurchaseDate"] == dt.datetime(2024, 1, 1)
    assert r["RYB"] == "RYB Pro"                         # latest qualifying line
    assert r["CVCustomerID"] == "CV1" and r["CVPersonID"] == "P1"
    assert (r["Attended"], r["IsNoShow"], r["WalkIn"]) == ("No", "No", "Yes")
    assert (r["RegistrationDay1"], r["RegistrationDay2"], r["RegistrationDay3"], r["10XVerticalSummit"]) \
        == ("Yes", None, None, None)
    for col in ("BlastDate", "LastCalledDate", "VerticalSummit", "ProductsSoldAttheEvent", "TCV"):
        assert r[col] is None


def test_comp_and_reschedule_decisions(report_rows):
    active = by_ticket(report_rows, "Active")
    t2 = active["T2"]
    assert {r["SeatAttribution"] for r in t2} == {"Rescheduled + Comp"}
    assert {r["CompType"] for r in t2} == {"Comp - No Sales Order"}
    assert {r["SourceofPurchase"] for r in t2} == {"Concierge"}
    assert Counter(r["Vertical"] for r in t2) == Counter({"Retail": 2, "Retail2": 2})
    assert {r["AnnualBusinessRevenue"] for r in t2} == {None}   # '8' recodes to NULL, not back to '8'
    assert {(r["FirstName"], r["LastName"]) for r in t2} == {("Cher", "")}
    assert {r["Attended"] for r in t2} == {"Yes"}                # case-folded status
    assert {r["10XVerticalSummit"] for r in t2} == {"Yes"}
    assert {r["HubspotContactID"] for r in t2} == {104}          # tie on time broken by larger id
    t3 = active["T3"][0]
    assert t3["SeatAttribution"] == "Comp"                       # blank sales order counts as missing
    assert t3["CompType"] == "Comp - Sales Order"                # ...but as present here
    assert t3["TabName"] is None and t3["DATESelectionDNT"] is None
    assert t3["Vertical"] is None and t3["CompanyName"] is None
    t7 = active["T7"][0]
    assert t7["TabName"] == "December 30-01 2026"
    assert t7["SourceofPurchase"] == "Concierge" and t7["SeatAttribution"] == "Undecided"
    assert t7["RefundRequest"] is None                           # all reasons NULL -> NULL, not 'Yes - '
    assert t7["Vertical"] == "xyz"                               # unknown code passes through
    assert t7["EliteStatus"] is None                             # unknown status -> NULL
    assert t7["AttendeeFullName"] is None                        # no attendee row: LEFT JOIN keeps the ticket


def test_no_show_values(report_rows):
    resets = by_ticket(report_rows, "No Show Reset")
    r1 = resets["T1"][0]
    assert r1["TabName"] == "September 01-03 2026"
    assert (r1["FirstName"], r1["LastName"]) == ("Mary", "Ann Smith")
    assert r1["CompanyName"] == "Acme Reset" and r1["ConfirmedBy"] == "carol"
    assert r1["Notes"] == "Also VIP | Call back"                 # shares the ticket id with T1
    assert r1["OriginalEventScheduledDate"] == dt.datetime(2026, 8, 11)
    assert r1["HubspotContactID"] is None                        # email lookup only
    assert r1["EliteStatus"] == "E125" and r1["Status"] == "no show"
    assert r1["Vertical"] == "Roofing"
    assert (r1["Attended"], r1["IsNoShow"], r1["WalkIn"]) == ("No", "Yes", "No")
    for col in ("SeatAttribution", "RoomOriginationAdditionEffort", "SourceofPurchase", "CVPersonID",
                "RegistrationDay1", "RegistrationDay2", "RegistrationDay3", "10XVerticalSummit"):
        assert r1[col] is None
    r3 = resets["R3"][0]
    assert (r3["FirstName"], r3["LastName"]) == ("Ann", " Lee  ")  # length rule ignores trailing blanks
    assert r3["Vertical"] == "Wholesale"
    assert r3["DietaryRestrictions"] == "Kosher"
    assert r3["CompType"] == "Comp - Sales Order"


def test_scoping_does_not_change_results(spark, fixture_sources):
    scoped = rows_of(Report(fixture_sources).build(sort=False))
    unscoped = rows_of(Report(fixture_sources, ReportConfig(scope_sources=False)).build(sort=False))
    key = lambda rows: Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    assert key(scoped) == key(unscoped)


def test_unrelated_rows_change_nothing(spark):
    from report_fixture import SOURCES

    extra = dict(SOURCES)
    extra["attendees"] = SOURCES["attendees"] + [("A99", "P99", "Extra Person", "e@x.test", None, None)]
    extra["customers"] = SOURCES["customers"] + [("C99", "Extra", "CV99", "1 Million+", "3", "3")]
    extra["history"] = SOURCES["history"] + [
        ("T99", "Status changed to undecided", "x", None, None, dt.datetime(2026, 7, 2))]
    extra["notes"] = SOURCES["notes"] + [("T99", "note of another ticket")]
    base = rows_of(Report(SourceCatalog(spark, frames=frames_from_rows(spark, SOURCES))).build(sort=False))
    more = rows_of(Report(SourceCatalog(spark, frames=frames_from_rows(spark, extra))).build(sort=False))
    key = lambda rows: Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    assert key(base) == key(more)


def test_rep_aliases_from_config_and_table(spark):
    from report_fixture import REP_ALIASES, SOURCES

    cfg = ReportConfig(rep_aliases=(("Zed Rep", "Zed Alias"),))
    src = SourceCatalog(spark, frames=frames_from_rows(spark, SOURCES))
    rows = rows_of(Report(src, cfg).build(sort=False))
    t1 = [r for r in rows if r["TicketID"] == "T1" and r["RecordType"] == "Active"]
    assert {r["SalesPerson1Name"] for r in t1} == {"Zed Alias"}
    assert {r["SalesPerson1"] for r in t1} == {None}            # alias not in the employee dimension

    tables = dict(SOURCES, rep_aliases=REP_ALIASES)
    rows = rows_of(Report(SourceCatalog(spark, frames=frames_from_rows(spark, tables))).build(sort=False))
    t1 = [r for r in rows if r["TicketID"] == "T1" and r["RecordType"] == "Active"]
    assert {r["SalesPerson1Name"] for r in t1} == {"Zed Rep"}
    assert len(t1) == 2


def test_hybrid_history_plus_live_equals_earlier_live(spark, fixture_sources):
    """Moving the cutoff moves rows between the stored history and the live part only."""
    early = ReportConfig(cutoff=dt.date(2026, 1, 1))
    earlier_live = Report(fixture_sources, early).live()
    scratch = tempfile.mkdtemp(prefix="tessera-hist-")
    path = os.path.join(scratch, "history")
    write_history(earlier_live, path, "DATESelectionDNT", roll="2026-08-11")
    history = read_history(spark, path, before=dt.date(2026, 8, 11))
    src = SourceCatalog(spark, frames=fixture_sources.frames, history=history)
    hybrid = Report(src).build(sort=False)

    key = lambda rows: Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    assert key(rows_of(hybrid)) == key(rows_of(earlier_live))
    # T4 and R4 come from history now
    hist_ids = {r["TicketID"] for r in rows_of(hybrid) if r["DATESelectionDNT"] is not None
                and r["DATESelectionDNT"] < dt.datetime(2026, 8, 11)}
    assert hist_ids == {"T4", "R4"}
    # the month bound prunes history partitions; the date filter is pushed to the scan
    plan = hybrid._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "report_month" in part_filters and "2026-08" in part_filters
    assert "DATESelectionDNT" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_history_without_matching_columns_is_rejected(spark, fixture_sources):
    bad = spark.createDataFrame([(None, "x")], "DATESelectionDNT timestamp_ntz, b string")
    src = SourceCatalog(spark, frames=fixture_sources.frames, history=bad)
    with pytest.raises(ValueError):
        Report(src).build()


@pytest.mark.parametrize("mode", ["none", "persist"])
def test_stage_modes_give_the_same_report(spark, fixture_sources, report_rows, mode):
    """The default run here writes stages as tables (tests set a checkpoint folder)."""
    rep = Report(fixture_sources, ReportConfig(materialize=mode))
    rows = rows_of(rep.build())
    rep.release()
    key = lambda rows: Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    assert key(rows) == key(report_rows)


def staged_tables(spark):
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    found = []
    for top in [root, os.path.dirname(root)]:
        found += [os.path.join(top, n) for n in os.listdir(top) if n.startswith("tessera-")]
    return set(found)


def test_stages_are_removed(spark, fixture_sources, report_rows):
    """Stages go after the last stage that reads them, the branches' rows with release()."""
    before = staged_tables(spark)
    rep = Report(fixture_sources)
    out = rep.build()
    left = {os.path.basename(p).removeprefix("tessera-").rsplit("-", 1)[0] for p in staged_tables(spark) - before}
    assert left == {"active", "no-show"}
    assert len(rows_of(out)) == len(report_rows)
    assert rep.duplicates().count() == 3            # its relations are rebuilt
    rep.release()
    assert staged_tables(spark) == before
    assert len(rows_of(rep.build())) == len(report_rows)   # and so is a released report
    rep.release()
    assert staged_tables(spark) == before


def test_a_failed_stage_fails_the_report(spark, fixture_sources):
    from tessera.plans.stages import run_stages

    ran = []
    stages = {"a": (lambda: ran.append("a"), ()), "b": (lambda: 1 / 0, ("a",)), "c": (lambda: ran.append("c"), ("b",)),
              "d": (lambda: ran.append("d"), ("a",))}
    with pytest.raises(ZeroDivisionError):
        run_stages(stages)
    assert sorted(ran) == ["a", "d"]


def test_repeated_lookup_keys_are_counted_or_refused(fixture_sources):
    rep = Report(fixture_sources)
    rep.build().collect()
    # CV2 twice in the customer dimension (vertical x revenue, then the ticket's four rows), Zed Rep has two emails
    assert rep.multiplied() == {"customer vertical": 1, "business revenue": 2, "sales rep 1": 1,
                                "active: customer_id": 3, "active: sales_order_id": 1, "no-show: sales_order_id": 1}
    rep.release()
    strict = Report(fixture_sources, ReportConfig(unique_lookups=True))
    with pytest.raises(Exception, match="lookup .*: key (CV2|Zed Rep) has 2 rows"):
        strict.build().collect()


def test_written_stage_cuts_lineage_and_prunes_columns(spark, fixture_sources):
    from tessera.plans.stages import stage

    df = Report(fixture_sources).ds.tickets
    cut = stage(df.where("status IS NOT NULL"), "table")
    plan = cut.select("ticket_id")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "ReadSchema: struct<ticket_id:string>" in plan
    with pytest.raises(ValueError):
        stage(df, "sometimes")


def test_each_source_is_read_once(spark, fixture_sources):
    """Every job of the staged report together: one scan of the customer dimension and of the change log."""
    import uuid

    root = f"{spark.sparkContext.getCheckpointDir()}/sources-{uuid.uuid4().hex}"
    frames = {}
    for name, frame in fixture_sources.frames.items():
        frame.write.parquet(f"{root}/{name}")
        frames[name] = spark.read.parquet(f"{root}/{name}")
    reads = Counter()

    def count(df):
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        for k in range(leaves.size()):
            leaf = leaves.apply(k)
            if leaf.getClass().getSimpleName() == "LogicalRelation":
                reads.update(p.rsplit("/", 1)[1] for p in leaf.relation().location().rootPaths().mkString(",").split(","))

    import tessera.plans.stages as stages

    real = stages.materialize

    def counted(session, df, name):
        count(df)
        return real(session, df, name)

    stages.materialize = counted
    try:
        count(Report(SourceCatalog(spark, frames=frames), ReportConfig()).build())
    finally:
        stages.materialize = real
    for name in ("DimCustomer", "history", "silver_Companies", "transactions", "notes", "attendees", "customers", "tickets"):
        assert reads[name] == 1, (name, reads)
    assert reads["silver_Transaction"] == 2     # by sales order, and by customer for the latest RYB line


@pytest.mark.parametrize("key_mode, rows", [("binary_rtrim", 2), ("binary", 0)])
def test_trailing_blanks_of_keys(spark, key_mode, rows):
    from report_fixture import SOURCES

    tickets = [t if t[0] != "T1" else ("T1", "E1", "A1 ", "C1  ") + t[4:6] + ("Attended ",) + t[7:] for t in SOURCES["tickets"]]
    customers = [c if c[0] != "C1" else c[:5] + ("3 ",) for c in SOURCES["customers"]]
    src = SourceCatalog(spark, frames=frames_from_rows(spark, dict(SOURCES, tickets=tickets, customers=customers)))
    t1 = [r for r in rows_of(Report(src, ReportConfig(key_mode=key_mode)).build(sort=False))
          if r["TicketID"] == "T1" and r["RecordType"] == "Active"]
    assert len(t1) == rows
    assert all(r["EliteStatus"] == "E125" and r["AttendeeFullName"] == "John Smith" and r["Attended"] == "Yes" for r in t1)


def test_case_of_keys_codes_and_patterns(spark, fixture_sources, report_rows):
    """Under ``ci_rtrim`` other spellings of keys, codes and searched texts give the same report."""
    from report_fixture import SOURCES
    from tessera.sources.schemas import KEY_COLUMNS, PATTERN_COLUMNS, SOURCE_SCHEMAS

    def respelled(name, rows):
        fields = [f.name for f in SOURCE_SCHEMAS[name].fields]
        at = {fields.index(c) for c in (*KEY_COLUMNS.get(name, ()), *PATTERN_COLUMNS.get(name, ()))}
        return [tuple(v.swapcase() + " " if k in at and isinstance(v, str) and v and n % 2 == 0 else v
                      for k, v in enumerate(row)) for n, row in enumerate(rows)]

    swapped = {name: rows if name == "rep_aliases" else respelled(name, rows) for name, rows in SOURCES.items()}
    # the same customer key in two spellings is one partition: the smaller company id wins
    swapped["silver_Companies"] = [*swapped["silver_Companies"],
                                   *[(c[0].swapcase(), c[1] + 1000) if SOURCE_SCHEMAS["silver_Companies"].fields[0].name == "CVCustomerID"
                                     else (c[0] + 1000, c[1].swapcase()) for c in SOURCES["silver_Companies"]
                                     if all(v is not None for v in c)]]

    def folded(rows):
        return Counter(tuple(sorted((k, str(v).lower().strip()) for k, v in r.items() if k != "Notes")) for r in rows)

    src = SourceCatalog(spark, frames=frames_from_rows(spark, swapped))
    rep = Report(src, ReportConfig(key_mode="ci_rtrim"))
    rows = rows_of(rep.build())
    rep.release()
    assert folded(rows) == folded(report_rows)
    assert {r["RYB"] for r in rows} - {None} != set() and {r["SourceofPurchase"] for r in rows} >= {"POS"}


def test_time_of_day_counts(spark):
    from report_fixture import SOURCES

    at = dt.datetime(2026, 8, 11, 9)
    events = [e if e[0] != "EV1" else ("EV1", at) for e in SOURCES["silver_Events"]]
    later = [(501, "RYB Late", dt.datetime(2026, 3, 5, 18), 11, "Cash Sale", "Cash Sale #78", None, None, 8000, 1)]
    src = SourceCatalog(spark, frames=frames_from_rows(spark, dict(
        SOURCES, silver_Events=events, silver_Transaction=SOURCES["silver_Transaction"] + later)))
    t1 = [r for r in rows_of(Report(src).build(sort=False)) if r["TicketID"] == "T1" and r["RecordType"] == "Active"]
    assert {r["SourceofPurchase"] for r in t1} == {"Concierge"}   # a start at 09:00 is not the day itself
    assert {r["OriginalEventScheduledDate"] for r in t1} == {at}
    assert {r["RYB"] for r in t1} == {"RYB Late"}                 # the later line of the same day


def test_rep_aliases_are_required(spark):
    from report_fixture import SOURCES

    tables = {k: v for k, v in SOURCES.items() if k != "rep_aliases"}
    src = SourceCatalog(spark, frames=frames_from_rows(spark, tables))
    with pytest.raises(KeyError, match="rep_aliases"):
        Report(src).build()
    assert Report(src, ReportConfig(rep_aliases=())).build().count() == 11


def test_duplicate_keys_are_reported(fixture_sources):
    found = {(r["dataset"], r["key"]): r["rows"] for r in Report(fixture_sources).duplicates().collect()}
    assert found == {("dim_customer", "CV2"): 2, ("hubspot_abr", "CV2"): 2, ("dim_employee", "Zed Rep"): 2}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="no sf0.01 data")
def test_scoping_is_exact_on_benchmark_sources(spark):
    from tessera.sources.benchmark_roles import BENCHMARK_CONFIG, benchmark_catalog

    sf = "/root/testdata/sf0.01"
    scoped = Report(benchmark_catalog(spark, sf), BENCHMARK_CONFIG).build(sort=False)
    unscoped = Report(benchmark_catalog(spark, sf),
                      dataclasses.replace(BENCHMARK_CONFIG, scope_sources=False)).build(sort=False)
    assert scoped.count() == unscoped.count() > 1000
    assert scoped.exceptAll(unscoped).count() == 0
    assert unscoped.exceptAll(scoped).count() == 0


def test_padded_blank_sales_order_counts_as_missing(spark):
    from report_fixture import SOURCES

    tickets = [t if t[0] != "T3" else t[:15] + ("  ",) + t[16:] for t in SOURCES["tickets"]]
    src = SourceCatalog(spark, frames=frames_from_rows(spark, dict(SOURCES, tickets=tickets)))
    t3 = [r for r in rows_of(Report(src).build(sort=False)) if r["TicketID"] == "T3"][0]
    assert t3["SeatAttribution"] == "Comp"
    assert t3["CompType"] == "Comp - Sales Order"


def test_job_entry_point_writes_report_and_rolls_history(spark, fixture_sources):
    from tessera.__main__ import main

    root = tempfile.mkdtemp(prefix="tessera-job-")
    for name, df in fixture_sources.frames.items():
        df.write.parquet(os.path.join(root, "sources", name))
    hist, out = os.path.join(root, "history"), os.path.join(root, "out")
    # first run: no history yet; roll the live rows before 2026-09-01 into it
    first_run = ["--sources", os.path.join(root, "sources"), "--out", out, "--history", hist, "--first-run",
                 "--append-history", "--roll-to", "2026-09-01", "--duplicates-out", os.path.join(root, "dup")]
    assert main(first_run) == 0
    assert main(first_run) == 0                     # run twice: the same history
    assert spark.read.parquet(os.path.join(root, "dup")).count() == 3
    first = spark.read.parquet(out)
    assert first.count() == 11
    rolled = read_history(spark, hist)
    assert sorted(r["TicketID"] for r in rolled.collect()) == ["T1", "T1", "T2", "T2", "T2", "T2"]
    # second run with the later cutoff reads those rows from history: same report
    out2 = os.path.join(root, "out2")
    assert main(["--sources", os.path.join(root, "sources"), "--out", out2, "--history", hist,
                 "--cutoff", "2026-09-01", "--labels"]) == 0
    second = spark.read.parquet(out2)
    assert second.columns[33] == "DATE Selection (DNT)"
    key = lambda rows: Counter(tuple(str(v) for v in r) for r in rows)
    assert key(second.collect()) == key(first.collect())


def test_job_refuses_a_history_it_cannot_read(spark, fixture_sources):
    from pyspark.errors import AnalysisException

    from tessera.__main__ import main

    root = tempfile.mkdtemp(prefix="tessera-job-")
    for name, df in fixture_sources.frames.items():
        df.write.parquet(os.path.join(root, "sources", name))
    out = os.path.join(root, "out")
    base = ["--sources", os.path.join(root, "sources"), "--out", out]
    with pytest.raises(AnalysisException):
        main([*base, "--history", os.path.join(root, "no_such_folder")])
    with pytest.raises(SystemExit):
        main([*base, "--append-history", "--roll-to", "2026-09-01"])
    with pytest.raises(SystemExit):
        main([*base, "--first-run"])
    assert not os.path.exists(out)
    # a plain folder, not partitioned by month, is a history like any other
    plain = os.path.join(root, "plain")
    Report(fixture_sources, ReportConfig(cutoff=dt.date(2026, 1, 1))).live().write.parquet(plain)
    assert main([*base, "--history", plain]) == 0
    assert {"T4", "R4"} <= {r["TicketID"] for r in spark.read.parquet(out).collect()}
