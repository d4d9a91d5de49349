"""The report's business decisions as Column functions.

Used by the report's datasets and by the operator queries alike. The
labels are fixed values in :mod:`tessera.config`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import config as C
from tessera.functions.text import is_blank


def _comped(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(0)) == 1


def purchase_source(event_date: Column, pos_date: Column, was_undecided: Column, undecided_at: Column,
                    rescheduled: Column) -> Column:
    """Bought at the point of sale, or through the concierge.

    With a POS event, its start must be the day of the ticket (an unknown
    ticket date or a start with a time of day is no match). Without one,
    any sign of a change after the purchase means the concierge.
    """
    same_day = F.to_date(event_date).cast("timestamp_ntz") == pos_date.cast("timestamp_ntz")
    changed = was_undecided | undecided_at.isNotNull() | rescheduled
    at_pos = F.when(pos_date.isNotNull(), F.coalesce(same_day, F.lit(False))).otherwise(~changed)
    return F.when(at_pos, F.lit(C.SOURCE_POS)).otherwise(F.lit(C.SOURCE_CONCIERGE))


def seat_attribution(is_comped: Column, sales_order_id: Column, rescheduled: Column, was_undecided: Column,
                     undecided_at: Column, source: Column) -> Column:
    """Who a seat counts for: comps without an order, then reschedules, then the purchase source."""
    comp = _comped(is_comped) & is_blank(sales_order_id)
    return (F.when(comp, F.when(rescheduled, F.lit(C.SEAT_RESCHEDULED_COMP)).otherwise(F.lit(C.SEAT_COMP)))
             .when(rescheduled, F.when(was_undecided | undecided_at.isNotNull(), F.lit(C.SEAT_RESCHEDULED_UNDECIDED))
                                 .otherwise(F.lit(C.SEAT_RESCHEDULED)))
             .when(source == C.SOURCE_CONCIERGE, F.lit(C.SEAT_UNDECIDED))
             .otherwise(F.lit(C.SEAT_SALES)))


def comp_type(is_comped: Column, sales_order_id: Column) -> Column:
    """Comps by whether they have a sales order (a blank one counts as one here); else NULL."""
    return F.when(_comped(is_comped), F.when(sales_order_id.isNull(), F.lit(C.COMP_NO_ORDER))
                                       .otherwise(F.lit(C.COMP_ORDER)))
