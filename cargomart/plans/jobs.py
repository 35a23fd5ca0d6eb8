"""The four batch jobs (P1-P4), composed from operators, gates and sinks.

Each job runs in one Spark session: its gates are actions that return single
aggregate rows, its writes are static-partition or whole-table overwrites, and
a failed gate stops the job before the next target changes.  Written tables
are the lineage cuts between jobs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.functions.predicates import is_present, slice_eq
from cargomart.operators.gates import (
    GateError,
    audited,
    rate_gate,
    require_rows,
    require_rows_unique,
    run_report,
    snapshot_report,
    validate_framed_csv,
)
from cargomart.operators.aggregates import unloaded_days
from cargomart.operators.sinks import (
    ensure_table,
    overwrite_table,
    publish,
    restore_table,
    snapshot_table,
    table_exists,
    write_framed_csv,
)
from cargomart.operators.filters import FilterSet
from cargomart.operators.versions import folder_of, replace_partitions, stage_partitions
from cargomart.params import RunParams, check_day, check_month, report_month_of
from cargomart.plans.definitions import active_filter, dq_rules
from cargomart.sources.catalog import refresh_partitions
from cargomart.plans.transforms import build_dim, dq_errors, month_rows, stage_shipments, summary_rows

EXPORT_ORDER = ["report_date", "carrier_id", "route_id", "service_level"]


@dataclass(frozen=True)
class MartTables:
    """Fully qualified table names for one deployment."""

    landing_db: str
    uc_db: str
    dim_db: str

    @classmethod
    def of(cls, p: RunParams) -> MartTables:
        return cls(p.landing_db, p.uc_db, p.dim_db)

    def __getattr__(self, name: str) -> str:
        db = {
            "src_shipments": self.landing_db, "src_shipment_events": self.landing_db,
            "src_carrier_master": self.landing_db, "src_route_master": self.landing_db,
            "stg_shipments": self.uc_db, "shipment_summary": self.uc_db,
            "shipment_dq_errors": self.uc_db, "export_log": self.uc_db,
            "dim_carrier": self.dim_db, "dim_route": self.dim_db,
            "dim_carrier_bkp": self.dim_db, "dim_route_bkp": self.dim_db,
        }.get(name)
        if db is None:
            raise AttributeError(name)
        return f"{db}.{name}"


TARGETS = {
    "stg_shipments": schemas.STG_SHIPMENTS,
    "shipment_dq_errors": schemas.SHIPMENT_DQ_ERRORS,
    "shipment_summary": schemas.SHIPMENT_SUMMARY,
    "export_log": schemas.EXPORT_LOG,
    "dim_carrier": schemas.DIM_CARRIER,
    "dim_route": schemas.DIM_ROUTE,
}


def create_targets(spark: SparkSession, p: RunParams, locations: dict[str, str] | None = None) -> MartTables:
    """A5 for every target table (create if missing; never drop)."""
    t = MartTables.of(p)
    for db in {p.uc_db, p.dim_db}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, schema in TARGETS.items():
        ensure_table(spark, getattr(t, name), schema, schemas.PARTITIONS.get(name, []),
                     (locations or {}).get(name))
    return t


def _step_counts(entries: list[tuple[str, str, DataFrame]]) -> dict[str, int]:
    """K8: the job's reconciliation counts, by label."""
    return {r["label"]: r["row_cnt"] for r in run_report(entries).collect()}


def _replace_gated(df: DataFrame, table: str, spec: dict[str, str]) -> int:
    """K1 before the partition is replaced: the rows are staged and counted, and
    none at all leave the partition as it was."""
    staged = stage_partitions(df, table, [spec])
    (n,) = staged.counts.values()
    if n == 0:
        raise GateError(f"{table} {folder_of(spec)}: no rows")
    staged.commit()
    return n


def ingest_day(
    spark: SparkSession, p: RunParams, trans_dt: str | None = None, filters: FilterSet | None = None
) -> dict:
    """A4 -> K1(src) -> K2 -> filters + latest event -> staging partition ->
    K1(stg) -> K8.  ``filters`` replaces the ingest filter set (B12); day
    folders that arrived since the last run are registered first."""
    t = MartTables.of(p)
    day = check_day(trans_dt or p.trans_dt)
    for name in (t.src_shipments, t.src_shipment_events):
        refresh_partitions(spark, name)
    src = spark.table(t.src_shipments).where(slice_eq("trans_dt", day))
    src_cnt = require_rows_unique(src, ["shipment_id", "trans_dt"], present=["shipment_id"],
                                  label=f"{t.src_shipments} trans_dt={day}")
    events = spark.table(t.src_shipment_events)
    stg = stage_shipments(src, events, day, p.min_declared_value, p.run_stamp, filters)
    stg_cnt = _replace_gated(stg, t.stg_shipments, {"trans_dt": day})
    report = _step_counts([("ingest", "stg_shipments", spark.table(t.stg_shipments).where(slice_eq("trans_dt", day)))])
    return {"trans_dt": day, "src_cnt": src_cnt, "stg_cnt": stg_cnt, "report": report}


def refresh_dims(
    spark: SparkSession, p: RunParams, load_dt: str | None = None, filters: FilterSet | None = None
) -> dict:
    """Active counts (D8) + per-source and unique-key gates -> snapshots
    (A10, K4) -> full refresh (A9, rolled back on failure) -> K1."""
    t = MartTables.of(p)
    as_of = check_day(load_dt or p.load_dt)
    active = filters or active_filter(as_of)
    carriers = active.apply(spark.table(t.src_carrier_master))
    routes = active.apply(spark.table(t.src_route_master))
    # One pass per source: its active row count (Q8: each source must be
    # non-empty on its own, before anything is overwritten) and its duplicate
    # keys (Q16: duplicates would multiply facts in the star join).  Their sum
    # is the reference's combined active count.
    carrier_cnt = require_rows_unique(carriers, ["carrier_id"], label=f"active {t.src_carrier_master} as of {as_of}")
    route_cnt = require_rows_unique(routes, ["route_id"], label=f"active {t.src_route_master} as of {as_of}")
    report = {"load_dt": as_of, "carrier_cnt": carrier_cnt, "route_cnt": route_cnt,
              "active_cnt": carrier_cnt + route_cnt}
    snapshots = []
    for dim in ("dim_carrier", "dim_route"):
        if table_exists(spark, getattr(t, dim)):
            snapshot_table(spark, getattr(t, dim), getattr(t, dim + "_bkp"))
            report[dim + "_bkp"] = snapshot_report(spark, getattr(t, dim), getattr(t, dim + "_bkp")).value
            snapshots.append(dim)
    try:
        overwrite_table(build_dim(carriers, schemas.DIM_CARRIER, as_of, p.run_stamp), t.dim_carrier)
        overwrite_table(build_dim(routes, schemas.DIM_ROUTE, as_of, p.run_stamp), t.dim_route)
    except Exception:
        # A failed refresh rolls both dimensions back to this run's snapshots.
        for dim in snapshots:
            restore_table(spark, getattr(t, dim + "_bkp"), getattr(t, dim))
        raise
    report["dim_carrier"] = require_rows(spark.table(t.dim_carrier), t.dim_carrier)
    report["dim_route"] = require_rows(spark.table(t.dim_route), t.dim_route)
    # Q22: what was loaded and when, from the tables themselves.
    for dim in ("dim_carrier", "dim_route"):
        report[dim + "_loaded_at"] = spark.table(getattr(t, dim)).agg(F.max("load_timestamp")).first()[0]
    return report


def summarize_day(
    spark: SparkSession, p: RunParams, trans_dt: str | None = None, filters: FilterSet | None = None
) -> dict:
    """K1(stg) -> DQ rule table (G2) -> error partition -> summary
    -> summary day partition (Q1) -> K1(summary) -> K3 error-rate warning."""
    t = MartTables.of(p)
    day = check_day(trans_dt or p.trans_dt)
    month = report_month_of(day)
    stg = spark.table(t.stg_shipments).where(slice_eq("trans_dt", day))
    stg_cnt = require_rows(stg, f"{t.stg_shipments} trans_dt={day}")
    dim_c, dim_r = spark.table(t.dim_carrier), spark.table(t.dim_route)

    errors = dq_errors(stg, dim_c, dim_r, p.run_stamp)
    err_cnt = replace_partitions(errors, t.shipment_dq_errors, [{"trans_dt": day}])[f"trans_dt={day}"]
    summ = summary_rows(stg, dim_c, dim_r, p.run_stamp, filters)
    summary_cnt = _replace_gated(summ, t.shipment_summary, {"report_month": month, "report_date": day})
    gate = rate_gate(err_cnt, stg_cnt, p.err_rate_threshold)
    errors = spark.table(t.shipment_dq_errors).where(slice_eq("trans_dt", day))
    done = spark.table(t.shipment_summary).where(slice_eq("report_month", month) & slice_eq("report_date", day))
    report = _step_counts([("summary", "shipment_dq_errors", errors), ("summary", "shipment_summary", done),
                           ("summary", "failing_shipments", errors.select("shipment_id").distinct())])
    return {"trans_dt": day, "stg_cnt": stg_cnt, "summary_cnt": summary_cnt, "error_cnt": err_cnt,
            "failing_shipments": report["failing_shipments"], "error_rate": gate, "report": report}


def export_month(
    spark: SparkSession,
    p: RunParams,
    dest: str,
    month: str | None = None,
    single_file: bool = True,
    quote: str = "none",
) -> dict:
    """K1 -> month slice (A6, B9) -> K7 -> framed CSV (F1, A13) -> K5 ->
    publish (A15), inside an audit record (K6).

    The file is written next to ``dest`` on the same file system and renamed
    into place only after it validates, so a failed attempt never leaves a
    half-written export under the published name.  ``dest`` is one file, whose
    lines pass through one task (a month of the summary); with
    ``single_file=False`` it is a folder of ordered parts instead.
    """
    t = MartTables.of(p)
    m = check_month(month or p.export_month)
    # The audit's run_dt is the time the export ran, as text.
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    ran_at = p.run_stamp or datetime.now(zone).strftime("%Y-%m-%d %H:%M:%S")
    with audited(spark, t.export_log, p.job_name, ran_at, m, dest) as audit:
        rows = month_rows(spark.table(t.shipment_summary), m)
        if rows.isEmpty():  # K1 / K7
            raise GateError(f"{t.shipment_summary}: month {m} has nothing to export")
        staging_dir = f"{dest}.tmp-{uuid.uuid4().hex}"
        write_framed_csv(rows, staging_dir, schemas.EXPORT_COLUMNS, EXPORT_ORDER, single_file, quote)
        result = validate_framed_csv(spark, staging_dir, schemas.EXPORT_COLUMNS)
        publish(spark, staging_dir, dest, single_file)
        audit.record_cnt = result.value
    return {"export_month": m, "record_cnt": result.value, "file": dest}


def days_to_backfill(spark: SparkSession, p: RunParams) -> list[str]:
    """Q12: source days that never reached staging (e.g. a weekday the
    schedule skips), oldest first.  Only distinct day values reach the driver."""
    t = MartTables.of(p)
    gaps = unloaded_days(spark.table(t.src_shipments), spark.table(t.stg_shipments), "trans_dt")
    return sorted(r[0] for r in gaps.collect())


def gate_days(spark: SparkSession, p: RunParams, days: list[str]) -> DataFrame:
    """K1 and K2 for many days in one pass over the source: trans_dt, row_cnt,
    dup_cnt (duplicated shipment ids that are present) and gate: OK, NO_ROWS or
    DUPLICATES.  Every given day has a row."""
    src = spark.table(MartTables.of(p).src_shipments).where(F.col("trans_dt").isin(list(days)))
    twice = (F.col("_n") > 1) & is_present("shipment_id")
    per_day = (
        src.groupBy("trans_dt", "shipment_id").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("trans_dt").agg(F.sum("_n").alias("row_cnt"), F.count(F.when(twice, F.lit(1))).alias("dup_cnt"))
    )
    asked = spark.createDataFrame([(d,) for d in days], "trans_dt string")
    counted = asked.join(per_day, "trans_dt", "left").na.fill(0, ["row_cnt", "dup_cnt"])
    gate = F.when(F.col("row_cnt") == 0, "NO_ROWS").when(F.col("dup_cnt") > 0, "DUPLICATES").otherwise("OK")
    return counted.withColumn("gate", gate)


def _refuse(out: dict[str, dict], counts: dict[str, int], field: str, gate: str) -> None:
    """Notes the counts of staged partitions, and ``gate`` where there are none."""
    for name, n in counts.items():
        record = out[name.rsplit("=", 1)[-1]]
        record[field] = n
        if n == 0 and gate:
            record["gate"] = gate


def ingest_days(spark: SparkSession, p: RunParams, days: list[str]) -> list[dict]:
    """P1 for many days: the gates of all of them (K1, K2) in one pass, and one
    staging write that is committed at once.  A day that fails a gate keeps the
    partition it had and doesn't keep the others.  Returns one small record a
    day, in order of days: trans_dt, src_cnt, dup_cnt, stg_cnt and gate (OK,
    NO_ROWS, DUPLICATES or NOTHING_STAGED)."""
    t = MartTables.of(p)
    days = sorted({check_day(d) for d in days})
    if not days:
        return []
    for name in (t.src_shipments, t.src_shipment_events):
        refresh_partitions(spark, name)
    out = {
        r["trans_dt"]: {"trans_dt": r["trans_dt"], "src_cnt": r["row_cnt"], "dup_cnt": r["dup_cnt"], "stg_cnt": 0, "gate": r["gate"]}
        for r in gate_days(spark, p, days).collect()
    }
    good = [d for d in days if out[d]["gate"] == "OK"]
    if good:
        src = spark.table(t.src_shipments).where(F.col("trans_dt").isin(good))
        events = spark.table(t.src_shipment_events).where(F.col("event_dt").isin(good))
        stg = stage_shipments(src, events, None, p.min_declared_value, p.run_stamp)
        at_most = {f"trans_dt={d}": out[d]["src_cnt"] for d in good}
        staged = stage_partitions(stg, t.stg_shipments, [{"trans_dt": d} for d in good], at_most)
        _refuse(out, staged.counts, "stg_cnt", "NOTHING_STAGED")
        staged.commit([{"trans_dt": d} for d in good if out[d]["gate"] == "OK"])
    return [out[d] for d in days]


def summarize_days(spark: SparkSession, p: RunParams, staged: dict[str, int]) -> list[dict]:
    """P3 for many days, given with their staged rows: one write of errors and
    one of summaries, each committed at once.  Returns one small record a day, in
    order of days: trans_dt, stg_cnt, error_cnt, summary_cnt and gate (OK, or
    NO_SUMMARY for a day that keeps the summary it had)."""
    t = MartTables.of(p)
    days = sorted(check_day(d) for d in staged)
    out = {d: {"trans_dt": d, "stg_cnt": staged[d], "error_cnt": 0, "summary_cnt": 0, "gate": "OK"} for d in days}
    if days:
        stg = spark.table(t.stg_shipments).where(F.col("trans_dt").isin(days))
        dim_c, dim_r = spark.table(t.dim_carrier), spark.table(t.dim_route)
        rules = len(dq_rules())  # a row breaks each of them once at most
        errors = stage_partitions(dq_errors(stg, dim_c, dim_r, p.run_stamp), t.shipment_dq_errors, [{"trans_dt": d} for d in days],
                                  {f"trans_dt={d}": rules * staged[d] for d in days})
        _refuse(out, errors.counts, "error_cnt", "")
        errors.commit()
        spec = {d: {"report_month": report_month_of(d), "report_date": d} for d in days}
        summary = stage_partitions(summary_rows(stg, dim_c, dim_r, p.run_stamp), t.shipment_summary, list(spec.values()),
                                   {folder_of(spec[d]): staged[d] for d in days})
        _refuse(out, summary.counts, "summary_cnt", "NO_SUMMARY")
        summary.commit([spec[d] for d in days if out[d]["gate"] == "OK"])
    return [out[d] for d in days]


def load_days(spark: SparkSession, p: RunParams, days: list[str]) -> list[dict]:
    """P1 and then P3 for many days; a day's record has the fields of both."""
    out = {r["trans_dt"]: r | {"error_cnt": 0, "summary_cnt": 0} for r in ingest_days(spark, p, days)}
    for r in summarize_days(spark, p, {d: r["stg_cnt"] for d, r in out.items() if r["gate"] == "OK"}):
        out[r["trans_dt"]] |= r
    return list(out.values())


def backfill(spark: SparkSession, p: RunParams, days: list[str] | None = None) -> list[dict]:
    """Ingest and summary of each missing day, all of them in one pass; reruns
    are idempotent.  A day that fails a gate doesn't keep the others: the
    failures are raised at the end with the outcomes of all days as ``outcomes``."""
    out, failed = [], []
    for r in load_days(spark, p, days if days is not None else days_to_backfill(spark, p)):
        day = r["trans_dt"]
        if r["gate"] == "OK":
            ingest = {"trans_dt": day, "src_cnt": r["src_cnt"], "stg_cnt": r["stg_cnt"]}
            summary = {"trans_dt": day, "stg_cnt": r["stg_cnt"], "summary_cnt": r["summary_cnt"], "error_cnt": r["error_cnt"],
                       "error_rate": rate_gate(r["error_cnt"], r["stg_cnt"], p.err_rate_threshold)}
            out.append({"trans_dt": day, "ingest": ingest, "summary": summary})
        else:
            out.append({"trans_dt": day, "error": f"{day}: {r['gate']}"})
            failed.append(day)
    if failed:
        error = GateError(f"backfill failed for {len(failed)} day(s): {', '.join(failed)}")
        error.outcomes = out
        raise error
    return out
