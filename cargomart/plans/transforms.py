"""Pure DataFrame transforms of the four jobs (no writes, no actions).

The jobs in ``cargomart.plans.jobs`` wrap these with gates and sinks; the
registered driver queries call them over whole tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.functions.measures import run_stamp
from cargomart.functions.predicates import month_slice, slice_eq
from cargomart.operators.joins import enrich_latest
from cargomart.operators.rules import rule_violations, rule_violations_union
from cargomart.plans.definitions import (
    DQ_KEEP,
    MIN_DECLARED_VALUE,
    active_filter,
    dq_rules,
    ingest_filters,
    shipment_summary,
    with_dim_flags,
)
from cargomart.schemas import conform

EVENT_TAKE = {
    "event_type_cd": "last_event_type_cd",
    "event_facility_cd": "last_event_facility_cd",
    "event_ts": "last_event_ts",
}


def stage_shipments(
    src: DataFrame,
    events: DataFrame,
    trans_dt: str | None = None,
    min_declared_value: Decimal = MIN_DECLARED_VALUE,
    stamp: str | None = None,
    filters=None,
) -> DataFrame:
    """Job 1 transform: slice (B7) -> filter set (B12) -> latest event of the
    same day (E1 + C1) -> staging layout (B1, H8).

    With ``trans_dt=None`` every day is staged at once: the latest event is
    taken per (shipment, day) and matched on both, which is the per-day job
    applied to all days.
    """
    if trans_dt is not None:
        src = src.where(slice_eq("trans_dt", trans_dt))
        events = events.where(slice_eq("event_dt", trans_dt))
    filters = ingest_filters(min_declared_value) if filters is None else filters
    kept = filters.apply(src)
    enriched = enrich_latest(
        kept,
        events,
        on=[("shipment_id", "shipment_id"), ("trans_dt", "event_dt")],
        order_by=["event_ts"],
        tie_breakers=["event_id"],
        take=EVENT_TAKE,
    )
    return conform(enriched, schemas.STG_SHIPMENTS, {"load_timestamp": run_stamp(stamp)})


def build_dim(master: DataFrame, schema, load_dt: str, stamp: str | None = None) -> DataFrame:
    """Job 2 transform: active-as-of filter (B8) + dimension layout (B1, B2, H8)."""
    return conform(active_filter(load_dt).apply(master), schema, {"load_timestamp": run_stamp(stamp)})


def dq_errors(
    stg: DataFrame,
    dim_carrier: DataFrame,
    dim_route: DataFrame,
    stamp: str | None = None,
    one_pass: bool = True,
    strict_text: bool = True,
) -> DataFrame:
    """Job 3 DQ transform (G2) in the error table's layout."""
    flagged = with_dim_flags(stg, dim_carrier, dim_route)
    build = rule_violations if one_pass else rule_violations_union
    v = build(flagged, dq_rules(strict_text), keep=DQ_KEEP)
    return conform(v, schemas.SHIPMENT_DQ_ERRORS, {"load_timestamp": run_stamp(stamp)})


def summary_rows(
    stg: DataFrame,
    dim_carrier: DataFrame,
    dim_route: DataFrame,
    stamp: str | None = None,
    filters=None,
) -> DataFrame:
    """Job 3 summary transform in the summary table's layout.  report_month is
    derived from report_date (Q21)."""
    s = shipment_summary(stg, dim_carrier, dim_route, filters)
    return conform(s, schemas.SHIPMENT_SUMMARY, {
        "load_timestamp": run_stamp(stamp),
        "report_month": F.substring("report_date", 1, 7),
    })


def month_rows(summary: DataFrame, month: str, columns=schemas.EXPORT_COLUMNS) -> DataFrame:
    """Job 4 selection (A6 + B9): one month of the summary, partition-pruned."""
    return summary.where(month_slice("report_date", month, partition_col="report_month")).select(*columns)
