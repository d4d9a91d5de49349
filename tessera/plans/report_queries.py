"""The full report and its datasets as registered queries over the benchmark tables.

Every query runs the report's own code. Casts here are for the comparison
with the DuckDB twins alone: dates as timestamps, nullable numbers as text
and money as double on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from tessera.operators import hybrid_union
from tessera.plans.datasets import ReportDatasets
from tessera.plans.report import DATE_COL, REPORT_SCHEMA, Report
from tessera.sources.benchmark_roles import BENCHMARK_CONFIG, benchmark_catalog

NULLABLE_NUMBERS = ("is_comped", "is_walkin", "HubspotContactID")


def comparable(df: DataFrame) -> DataFrame:
    def cast(f):
        if isinstance(f.dataType, DateType):
            return F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, DecimalType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        return F.col(f"`{f.name}`").cast("string").alias(f.name) if f.name in NULLABLE_NUMBERS else F.col(f"`{f.name}`")

    return df.select(*[cast(f) for f in df.schema.fields])


def _report(spark: SparkSession, sf_dir: str) -> Report:
    return Report(benchmark_catalog(spark, sf_dir), BENCHMARK_CONFIG)


def q_attendee_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three parts (stored history, active tickets, no-show resets), 55 columns, sorted."""
    return comparable(_report(spark, sf_dir).build())


def q_report_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows dated before the cutoff."""
    history = _report(spark, sf_dir).history()
    return comparable(hybrid_union(history, [], REPORT_SCHEMA, BENCHMARK_CONFIG.cutoff, DATE_COL))


def q_report_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The active branch."""
    return comparable(_report(spark, sf_dir).active)


def q_report_no_show(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The no-show branch."""
    return comparable(_report(spark, sf_dir).no_show)


def _dataset(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query of one of the report's datasets (all its columns, or the named ones)."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(_report(spark, sf_dir).ds, name)
        return comparable(df.select(*columns) if columns else df)

    query.__doc__ = getattr(ReportDatasets, name).__doc__
    return query


def q_report_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that multiply rows of the report."""
    return _report(spark, sf_dir).duplicates()


REPORT_QUERIES = {
    "attendee_report": q_attendee_report,
    "report_history": q_report_history,
    "report_active": q_report_active,
    "report_no_show": q_report_no_show,
    "report_tickets": _dataset("tickets", "ticket_id", "event_id", "attendee_id", "customer_id", "status", "event_date",
                               "sales_order_id", "is_comped", "is_walkin", "undecided_timestamp"),
    "report_attendees": _dataset("attendees"),
    "report_customers": _dataset("customers"),
    "report_customer_verticals": _dataset("dim_customer"),
    "report_sessions": _dataset("sessions"),
    "report_checkins": _dataset("session_checkins"),
    "report_business_revenue": _dataset("hubspot_abr"),
    "report_ryb_purchases": _dataset("ryb_purchases"),
    "report_first_purchase_flag": _dataset("is_10x360"),
    "report_refunds": _dataset("refunds"),
    "report_ticket_notes": _dataset("ticket_notes"),
    "report_ticket_transactions": _dataset("ticket_transactions"),
    "report_sales_reps": _dataset("netsuite"),
    "report_rep_names": _dataset("netsuite_names"),
    "report_employees": _dataset("dim_employee"),
    "report_contact_by_person": _dataset("hubspot_person"),
    "report_contact_by_email": _dataset("hubspot_email"),
    "report_confirmed_by": _dataset("confirmed_by"),
    "report_pos_event_dates": _dataset("pos_original_event_dedup"),
    "report_rescheduled": _dataset("history_rescheduled"),
    "report_was_undecided": _dataset("history_was_undecided"),
    "report_purchase_source": _dataset("source_of_purchase"),
    "report_seat_attribution": _dataset("seat_attribution"),
    "report_duplicate_keys": q_report_duplicate_keys,
}
