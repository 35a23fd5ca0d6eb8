"""The shipment mart's business definitions, built from the generic operators:
filter sets (B12), active-dimension rule (B8), DQ rules (G2) and the summary
shape (C2, D4-D7).  Shared by the jobs and by the registered driver queries.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargomart.functions.measures import describe_missing_key
from cargomart.functions.predicates import (
    active_as_of,
    any_missing,
    any_negative,
    at_least,
    exclude_value,
    include_values,
    is_present,
)
from cargomart.operators.aggregates import shipment_measures, summarize, with_approval_rate
from cargomart.operators.filters import FilterSet
from cargomart.operators.joins import DimSpec, key_presence, star_join
from cargomart.operators.rules import Rule

# Codes, lists, thresholds and message texts that must equal
# the reference's for identical results.
EXCLUDED_RECORD_TYPES = ("TEST", "INTERNAL")
KEPT_STATUSES = ("BOOKED", "IN_TRANSIT", "DELIVERED")
APPROVED_STATUS = "DELIVERED"
REJECTED_STATUSES = ("CANCELLED", "RETURNED")
EXCLUDED_SERVICE_LEVEL = "WAREHOUSE_TRANSFER"
ANALYTICS_RECORD_TYPES = ("RAW", "MANIFEST")
ACTIVE_STATUS = "A"
MIN_DECLARED_VALUE = Decimal("10.00")
ERR_NO_DIM_CARRIER = "ERR_NO_DIM_CARRIER"
ERR_NO_DIM_ROUTE = "ERR_NO_DIM_ROUTE"
ERR_NEG_VALUE = "ERR_NEG_VALUE"
ERR_NULL_MANDATORY = "ERR_NULL_MANDATORY"
NO_DIM_CARRIER_TEXT = ("Carrier id [", "] not present in dim_carrier")
NO_DIM_ROUTE_TEXT = ("Route id [", "] not present in dim_route")
NEG_VALUE_TEXT = ("Negative monetary value declared_value=", " shipping_charge=")
NULL_MANDATORY_TEXT = (
    "One or more mandatory fields are NULL "
    "(tracking_number, origin/destination facility, weight_kg)"
)

SUMMARY_KEYS = ["report_date", "carrier_id", "carrier_name", "route_id", "region_cd", "transit_mode", "service_level"]
SUMMARY_MEASURE_COLS = ["total_count", "approved_count", "rejected_count", "total_amount", "total_weight_kg"]
DQ_KEEP = [
    "shipment_id", "tracking_number", "carrier_id", "route_id", "record_type",
    "shipment_status_code", "weight_kg", "declared_value", "shipping_charge", "trans_dt",
]


def ingest_filters(min_declared_value: Decimal = MIN_DECLARED_VALUE) -> FilterSet:
    """Job 1's filter set (plus the always-on shipment_id presence test)."""
    return FilterSet.of("daily_shipment_ingest", {
        "shipment_id_present": is_present("shipment_id"),
        "excl_test_type": exclude_value("record_type", EXCLUDED_RECORD_TYPES[0]),
        "excl_internal_type": exclude_value("record_type", EXCLUDED_RECORD_TYPES[1]),
        "status_code": include_values("shipment_status_code", KEPT_STATUSES),
        "min_value": at_least("declared_value", min_declared_value),
        "non_null_carrier": is_present("carrier_id"),
    })


def summary_filters() -> FilterSet:
    """Job 3's summary filter set.  The reference's third filter
    (``dc.carrier_id IS NOT NULL``) is implied by the inner join (B14)."""
    return FilterSet.of("daily_shipment_summary", {
        "excl_internal_transfer": exclude_value("service_level", EXCLUDED_SERVICE_LEVEL),
        "record_type": include_values("record_type", ANALYTICS_RECORD_TYPES),
    })


def active_filter(as_of: str) -> FilterSet:
    return FilterSet.of("weekly_dim_refresh", {"active": active_as_of(as_of, active=ACTIVE_STATUS)})


def dq_rules(strict_text: bool = True) -> list[Rule]:
    """The four DQ rules.  Expects boolean columns ``has_carrier``/``has_route``
    (see ``with_dim_flags``).

    ``strict_text=True`` keeps the reference's ``CONCAT`` semantics: a NULL
    amount makes the ERR_NEG_VALUE description NULL (Q9).  ``False`` renders
    the missing amount as ``NULL`` inside the text instead.
    """
    def amount(c: str):
        s = F.col(c).cast("string")
        return s if strict_text else F.coalesce(s, F.lit("NULL"))

    return [
        Rule(ERR_NO_DIM_CARRIER, ~F.col("has_carrier"),
             describe_missing_key(NO_DIM_CARRIER_TEXT[0], "carrier_id", NO_DIM_CARRIER_TEXT[1])),
        Rule(ERR_NO_DIM_ROUTE, ~F.col("has_route"),
             describe_missing_key(NO_DIM_ROUTE_TEXT[0], "route_id", NO_DIM_ROUTE_TEXT[1])),
        Rule(ERR_NEG_VALUE, any_negative("declared_value", "shipping_charge"),
             F.concat(F.lit(NEG_VALUE_TEXT[0]), amount("declared_value"),
                      F.lit(NEG_VALUE_TEXT[1]), amount("shipping_charge"))),
        Rule(ERR_NULL_MANDATORY,
             any_missing(["tracking_number", "origin_facility_cd", "destination_facility_cd"], ["weight_kg"]),
             F.lit(NULL_MANDATORY_TEXT)),
    ]


def with_dim_flags(stg: DataFrame, dim_carrier: DataFrame, dim_route: DataFrame) -> DataFrame:
    out = key_presence(stg, dim_carrier, "carrier_id", "carrier_id", "has_carrier")
    return key_presence(out, dim_route, "route_id", "route_id", "has_route")


def shipment_summary(
    stg: DataFrame,
    dim_carrier: DataFrame,
    dim_route: DataFrame,
    filters: FilterSet | None = None,
) -> DataFrame:
    """Star join (C2) + summary filters (B12) + grouped measures.

    Grouped by ``trans_dt`` (as report_date) among the keys, so the same plan
    serves one day or many.
    """
    filters = summary_filters() if filters is None else filters
    joined = star_join(
        filters.apply(stg),
        [
            DimSpec(dim_carrier, "carrier_id", "carrier_id", ["carrier_name"]),
            DimSpec(dim_route, "route_id", "route_id", ["region_cd", "transit_mode"]),
        ],
    ).withColumnRenamed("trans_dt", "report_date")
    measures = shipment_measures(APPROVED_STATUS, REJECTED_STATUSES)
    return with_approval_rate(summarize(joined, SUMMARY_KEYS, measures))
