"""Registered driver queries: every operator of the inventory run over the
driver's whole test tables through the adapter views.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Run
stamps (``load_timestamp``) are left out of every output so results are
comparable across engines.  The equivalent DuckDB SQL is in ``oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.functions.measures import int_percent, percent_string
from cargomart.functions.predicates import any_missing, month_slice
from cargomart.operators.aggregates import (
    combined_count,
    dedupe,
    duplicate_key_count,
    duplicate_keys,
    duplicate_keys_hashed,
    rollup_levels,
    error_counts,
    missing_days,
    rollup_counts,
)
from cargomart.operators.joins import enrich_latest, orphan_rows, orphan_rows_by_keys, orphan_rows_left_join
from cargomart.operators.gates import run_report
from cargomart.operators.rules import violation_count
from cargomart.operators.sinks import HEADER_TAG, TRAILER_PREFIX, TRAILER_TAG, frame_lines
from cargomart.operators.windows import latest_per_key, latest_per_key_window, number_rows
from cargomart.plans.definitions import (
    SUMMARY_MEASURE_COLS, active_filter, dq_rules, ingest_filters, summary_filters, with_dim_flags,
)
from cargomart.plans.transforms import EVENT_TAKE, build_dim, dq_errors, stage_shipments, summary_rows
from cargomart.sources import testdata as td

# Fixed parameters of the driver queries.  10.00 would keep every adapter row,
# so the minimum value is raised to make the filter bite.
MIN_VALUE = Decimal("10000.00")
MONTH = "1996-12"
MONTH_DAYS = ("1996-12-01", "1997-01-01")
STAMP = td.RUN_STAMP
EXPORT_ORDER = ["report_date", "carrier_id", "route_id", "service_level"]

Query = Callable[[SparkSession, str], DataFrame]


def _drop_stamp(df: DataFrame) -> DataFrame:
    return df.drop("load_timestamp")


def src(spark: SparkSession, d: str) -> DataFrame:
    return td.src_shipments(spark, d)


def events(spark: SparkSession, d: str) -> DataFrame:
    return td.src_shipment_events(spark, d)


def staging(spark: SparkSession, d: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Staged rows of all days, or of those from one day to before another."""
    found = td.shipment_day_events(spark, d, days)
    return stage_shipments(td.src_shipments(spark, d, days=days), found, None, MIN_VALUE, STAMP)


def dim_carrier(spark: SparkSession, d: str) -> DataFrame:
    return build_dim(td.src_carrier_master(spark, d), schemas.DIM_CARRIER, td.LOAD_DT, STAMP)


def dim_route(spark: SparkSession, d: str) -> DataFrame:
    return build_dim(td.src_route_master(spark, d), schemas.DIM_ROUTE, td.LOAD_DT, STAMP)


def dq(spark: SparkSession, d: str, one_pass: bool = True) -> DataFrame:
    return dq_errors(staging(spark, d), dim_carrier(spark, d), dim_route(spark, d), STAMP, one_pass)


def summary(spark: SparkSession, d: str) -> DataFrame:
    return summary_rows(staging(spark, d), dim_carrier(spark, d), dim_route(spark, d), STAMP)


# --------------------------------------------------------------------------- queries


def q_ingest_filtered(spark, d):
    """The ingest filter set over every source row."""
    return ingest_filters(MIN_VALUE).apply(src(spark, d))


def q_ingest_staging(spark, d):
    """P1 transform over all days: filters + latest same-day event (E1, C1) + layout (B1)."""
    return _drop_stamp(staging(spark, d))


def q_duplicate_keys(spark, d):
    """(shipment_id, trans_dt) occurring more than once, blank ids ignored."""
    return duplicate_keys(src(spark, d), ["shipment_id", "trans_dt"], present=["shipment_id"])


def q_duplicate_key_count(spark, d):
    """D3: number of duplicated shipment ids."""
    return duplicate_key_count(src(spark, d), ["shipment_id"], present=["shipment_id"])


def q_latest_event_per_key(spark, d):
    """Latest event per shipment (event_ts DESC NULLS LAST, event_id DESC)."""
    return latest_per_key(
        events(spark, d), ["shipment_id"], ["event_ts"], ["event_id"],
        take=["event_id", "event_type_cd", "event_facility_cd", "event_ts", "event_dt"],
    )


def q_latest_event_per_key_window(spark, d):
    """E1, window form (row_number = 1); must equal the aggregate form."""
    return latest_per_key_window(
        events(spark, d), ["shipment_id"], ["event_ts"], ["event_id"],
        take=["event_id", "event_type_cd", "event_facility_cd", "event_ts", "event_dt"],
    )


def q_enrich_latest(spark, d):
    """Every order with its latest event (orders keep their cardinality)."""
    orders = td.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.col("o_orderkey").cast("string").alias("__key"),
    )
    out = enrich_latest(orders, events(spark, d), [("__key", "shipment_id")], ["event_ts"], EVENT_TAKE, ["event_id"])
    return out.drop("__key")


def q_active_carriers(spark, d):
    """B8 + B1/B2: the carrier dimension as of the load date."""
    return _drop_stamp(dim_carrier(spark, d))


def q_active_routes(spark, d):
    """B8 + B1/B2: the route dimension as of the load date."""
    return _drop_stamp(dim_route(spark, d))


def q_combined_active_count(spark, d):
    """Active rows of both masters and their sum."""
    f = active_filter(td.LOAD_DT)
    return combined_count({
        "carrier": f.apply(td.src_carrier_master(spark, d)),
        "route": f.apply(td.src_route_master(spark, d)),
    })


_ORPHAN_COLS = ["shipment_id", "carrier_id", "route_id", "trans_dt"]


def q_orphans_carrier(spark, d):
    """Staging rows whose carrier is not in dim_carrier."""
    return orphan_rows(staging(spark, d), dim_carrier(spark, d), "carrier_id", "carrier_id").select(*_ORPHAN_COLS)


def q_orphans_carrier_left_join(spark, d):
    """C3, literal left join + IS NULL form; must equal ``orphans_carrier``."""
    return orphan_rows_left_join(staging(spark, d), dim_carrier(spark, d), "carrier_id", "carrier_id").select(
        *_ORPHAN_COLS
    )


def q_orphans_route(spark, d):
    """C4: staging rows whose route is not in dim_route."""
    return orphan_rows(staging(spark, d), dim_route(spark, d), "route_id", "route_id").select(*_ORPHAN_COLS)


def q_orphans_carrier_by_keys(spark, d):
    """C3 without a shuffle of the staged rows, for a dimension of any size; must equal ``orphans_carrier``."""
    return orphan_rows_by_keys(staging(spark, d), dim_carrier(spark, d), "carrier_id", "carrier_id").select(*_ORPHAN_COLS)


def q_rule_violations(spark, d):
    """G2 one-pass (B10, B11, H1-H3): one row per (staging row, failed rule)."""
    return _drop_stamp(dq(spark, d, one_pass=True))


def q_error_counts(spark, d):
    """Error rows per day and code."""
    return error_counts(dq(spark, d))


def q_daily_summary(spark, d):
    """Flagship: star join (C2) + summary filters + grouped measures."""
    return _drop_stamp(summary(spark, d))


def q_monthly_summary(spark, d):
    """The daily summary rolled up by month, region, mode and service."""
    keys = ["report_month", "region_cd", "transit_mode", "service_level"]
    r = rollup_counts(summary(spark, d), keys, SUMMARY_MEASURE_COLS)
    return r.withColumn("approval_rate", percent_string("approved_count", "total_count"))


def q_month_slice(spark, d):
    """Staging rows of one month (the export's month selection).  The
    month's bounds reach the scan of the lines; the text test stays."""
    return _drop_stamp(staging(spark, d, MONTH_DAYS)).where(month_slice("trans_dt", MONTH))


def _rule_hits(spark, d) -> DataFrame:
    """Staging rows with the number of DQ rules each fails (one pass)."""
    flagged = with_dim_flags(staging(spark, d), dim_carrier(spark, d), dim_route(spark, d))
    return flagged.select("trans_dt", violation_count(dq_rules()).alias("hits"))


def _rate_columns():
    rate = int_percent("err_cnt", "stg_cnt")
    return ["err_cnt", "stg_cnt", rate.alias("err_rate_pct"), (rate > 5).alias("warn")]


def q_error_rate(spark, d):
    """H7 + K3: error rows vs staging rows as a truncating integer percent,
    both counted in one pass over staging."""
    both = _rule_hits(spark, d).agg(
        F.sum("hits").cast("bigint").alias("err_cnt"), F.count(F.lit(1)).cast("bigint").alias("stg_cnt")
    )
    return both.select(*_rate_columns())


def q_error_rate_by_day(spark, d):
    """K3 per day, as the daily job evaluates it (one pass over staging)."""
    per_day = _rule_hits(spark, d).groupBy("trans_dt").agg(
        F.sum("hits").cast("bigint").alias("err_cnt"), F.count(F.lit(1)).cast("bigint").alias("stg_cnt")
    )
    return per_day.select("trans_dt", *_rate_columns())


def q_framed_export_lines(spark, d):
    """Every month's framed export (header, rows, trailer) as lines
    with their places in the month's file.  The summary is computed once."""
    rows = number_rows(summary(spark, d).select(*schemas.EXPORT_COLUMNS), ["report_month"], EXPORT_ORDER, start=2)
    lines = frame_lines(rows, schemas.EXPORT_COLUMNS, order_by=["line_no"], group_by=["report_month"])
    n = F.substr("line", F.lit(len(TRAILER_PREFIX) + 1)).try_cast("long")
    place = F.when(F.col("line_tag") == HEADER_TAG, 1).when(F.col("line_tag") == TRAILER_TAG, n + 2).otherwise(F.col("line_no"))
    return lines.select(F.col("report_month").alias("export_month"), "line_tag", "line", place.cast("int").alias("line_no"))


def q_summary_levels(spark, d):
    """The summary by month, carrier and service level, and at three coarser
    levels, all from one pass."""
    levels = [["report_month", "carrier_id", "service_level"], ["report_month", "carrier_id"], ["report_month"], []]
    return rollup_levels(summary(spark, d), levels, ["total_count", "approved_count", "total_amount"])


def q_duplicate_keys_hashed(spark, d):
    """D2 by candidates: full keys are grouped only where their hashes repeat."""
    return duplicate_keys_hashed(src(spark, d), ["shipment_id", "trans_dt"], present=["shipment_id"])


def q_missing_days(spark, d):
    """Q12: calendar days between the first and last source day on which no
    staged row lacks a mandatory field.  Staging keeps rows of the source, so
    one grouping of the source by day says which days the target has."""
    lacking = any_missing(["tracking_number", "origin_facility_cd", "destination_facility_cd"], ["weight_kg"])
    kept = F.coalesce(ingest_filters(MIN_VALUE).condition() & lacking, F.lit(False))
    days = src(spark, d).groupBy("trans_dt").agg(F.max(kept).alias("there"))
    days = days.withColumn("there", F.when(F.col("there"), F.lit(True)))
    return missing_days(days, days.where("there"), "trans_dt")


def q_dedupe_latest(spark, d):
    """One lineitem per (orderkey, linenumber), deterministic survivor."""
    li = td.table(spark, d, "lineitem")
    return dedupe(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_run_report(spark, d):
    """K8: one reconciliation row per step.

    One grouping of the flagged source by the summary's keys carries the source,
    staging and DQ counts and whether the group is one of the summary's; the
    dimension counts are single-row aggregates.
    """
    dc, dr = dim_carrier(spark, d), dim_route(spark, d)
    kept = ingest_filters(MIN_VALUE).condition()
    flagged = with_dim_flags(src(spark, d), dc, dr)
    hits = violation_count(dq_rules())
    kept = F.coalesce(kept, F.lit(False))
    shown = kept & F.col("has_carrier") & F.col("has_route") & F.coalesce(summary_filters().condition(), F.lit(False))
    groups = flagged.groupBy("trans_dt", "carrier_id", "route_id", "service_level").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(kept, F.lit(1))).alias("kept"),
        F.sum(F.when(kept, hits).otherwise(F.lit(0))).alias("hits"),
        F.max(shown).alias("shown"),
    )
    one_pass = groups.agg(
        F.sum("n").cast("bigint").alias("src_shipments"),
        F.sum("kept").cast("bigint").alias("stg_shipments"),
        F.sum("hits").cast("bigint").alias("shipment_dq_errors"),
        F.count(F.when(F.col("shown"), F.lit(1))).cast("bigint").alias("shipment_summary"),
    )
    steps = {"src_shipments": "ingest", "stg_shipments": "ingest", "shipment_dq_errors": "summary",
             "shipment_summary": "summary"}
    rows = one_pass.select(F.explode(F.array(*[
        F.struct(F.lit(step).alias("step"), F.lit(label).alias("label"), F.col(label).alias("row_cnt"))
        for label, step in steps.items()
    ])).alias("r")).select("r.*")
    rest = run_report([
        ("dim_refresh", "dim_carrier", dc),
        ("dim_refresh", "dim_route", dr),
    ])
    return rows.unionByName(rest)


def q_summary_unfiltered(spark, d):
    """T14 over the unfiltered source: only here rejected_count can be > 0 (Q10)."""
    return _drop_stamp(summary_rows(src(spark, d), dim_carrier(spark, d), dim_route(spark, d), STAMP))


# These read what the ones above make; they are written in a module of their own.
from cargomart.plans.table_queries import TABLE_QUERIES  # noqa: E402

QUERIES: dict[str, Query] = {
    "ingest_filtered": q_ingest_filtered,
    "ingest_staging": q_ingest_staging,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_key_count": q_duplicate_key_count,
    "latest_event_per_key": q_latest_event_per_key,
    "latest_event_per_key_window": q_latest_event_per_key_window,
    "enrich_latest": q_enrich_latest,
    "active_carriers": q_active_carriers,
    "active_routes": q_active_routes,
    "combined_active_count": q_combined_active_count,
    "orphans_carrier": q_orphans_carrier,
    "orphans_carrier_left_join": q_orphans_carrier_left_join,
    "orphans_carrier_by_keys": q_orphans_carrier_by_keys,
    "orphans_route": q_orphans_route,
    "rule_violations": q_rule_violations,
    "error_counts": q_error_counts,
    "summary_levels": q_summary_levels,
    "duplicate_keys_hashed": q_duplicate_keys_hashed,
    "daily_summary": q_daily_summary,
    "monthly_summary": q_monthly_summary,
    "month_slice": q_month_slice,
    "error_rate": q_error_rate,
    "error_rate_by_day": q_error_rate_by_day,
    "framed_export_lines": q_framed_export_lines,
    "missing_days": q_missing_days,
    "dedupe_latest": q_dedupe_latest,
    "run_report": q_run_report,
    "summary_unfiltered": q_summary_unfiltered,
    **TABLE_QUERIES,
}
