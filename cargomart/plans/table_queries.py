"""Driver queries that write: sinks, delimited files, gates and the jobs.

Each runs over the whole source role, writes tables of a database of its own in
the session's warehouse (replaced when the query runs again), and returns the
rows read back.  They run jobs while they are built.
"""

from __future__ import annotations

import math
import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators import sinks
from cargomart.operators.aggregates import duplicate_keys
from cargomart.operators.buckets import bucket_count, write_bucketed
from cargomart.operators.gates import GateError, audited, compare_content, rate_gate, require_rows, snapshot_report, validate_framed_csv
from cargomart.operators.joins import enrich_latest
from cargomart.params import RunParams
from cargomart.plans import jobs
from cargomart.plans.transforms import EVENT_TAKE, build_dim, dq_errors, stage_shipments
from cargomart.session import checkpoint_dir, scanned_bytes, shuffles_removed
from cargomart.sources import testdata as td
from cargomart.sources.catalog import read_table, refresh_partitions
from cargomart.sources.delimited import ensure_landing_table, keep_rejects, read_checked, write_delimited

MIN_VALUE = Decimal("10000.00")
#: Bytes of tables that are joined and written at once, and how many slices they are cut into at most.
SLICE_BYTES, MAX_SLICES = 256 << 20, 4


def _database(spark: SparkSession, query: str) -> str:
    """An empty database of this session for a query."""
    name = re.sub(r"\W", "_", f"q_{query}_{spark.sparkContext.applicationId}")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    return name


def _slim(spark: SparkSession, d: str) -> DataFrame:
    return td.src_shipments(spark, d).select(
        "shipment_id", "carrier_id", "record_type", "declared_value", "trans_dt",
        F.substring("trans_dt", 1, 4).alias("ship_year"),
    )


def _partitioned(spark: SparkSession, d: str, query: str, by: list[str]) -> tuple[str, DataFrame]:
    table = f"{_database(spark, query)}.shipments"
    rows = _slim(spark, d)
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.select(*[c for c in rows.columns if c not in by], *by)
    sinks.ensure_table(spark, table, rows.schema, by)
    # Few files a partition: its rows meet before they are written, and a
    # partition larger than Spark's advisory size is split between tasks.
    rows.hint("rebalance", *by).write.insertInto(table, overwrite=True)
    return table, rows


def q_partition_overwrite(spark, d):
    """One year's partition is replaced, one cleared, the others stay."""
    table, rows = _partitioned(spark, d, "partition_overwrite", ["ship_year"])
    doubled = rows.withColumn("declared_value", (F.col("declared_value") * 2).cast("decimal(15,2)"))
    sinks.overwrite_partition(doubled.where("ship_year = '1995'"), table, {"ship_year": "1995"})
    sinks.overwrite_partition(rows.limit(0), table, {"ship_year": "1997"})
    return read_table(spark, table)


def q_partition_overwrite_two_level(spark, d):
    """One partition of two levels is replaced."""
    table, rows = _partitioned(spark, d, "partition_overwrite_two_level", ["ship_year", "record_type"])
    one = rows.where("ship_year = '1995' and record_type = 'RAW' and declared_value >= 20000")
    sinks.overwrite_partition(one, table, {"ship_year": "1995", "record_type": "RAW"})
    return read_table(spark, table)


def q_snapshot_restore(spark, d):
    """The carrier dimension is loaded, kept, overwritten, kept
    again, restored and appended to."""
    db = _database(spark, "snapshot_restore")
    dim, first, changed = (f"{db}.{x}" for x in ("dim", "first", "changed"))
    rows = build_dim(td.src_carrier_master(spark, d), schemas.DIM_CARRIER, td.LOAD_DT, td.RUN_STAMP)
    sinks.ensure_table(spark, dim, schemas.DIM_CARRIER)
    sinks.overwrite_table(rows, dim)
    sinks.snapshot_table(spark, dim, first)
    snapshot_report(spark, dim, first)
    sinks.overwrite_table(rows.where("region_cd = 'R1'"), dim)
    sinks.snapshot_table(spark, dim, changed)
    sinks.restore_table(spark, first, dim)
    sinks.append_rows(rows.where("region_cd = 'R2'"), dim)
    shown = ["carrier_id", "carrier_name", "region_cd"]
    state = lambda name, table: read_table(spark, table).select(F.lit(name).alias("state"), *shown)
    return state("changed", changed).unionByName(state("restored", dim))


def _with_year(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ship_year", F.substring("trans_dt", 1, 4))


def q_landing_round_trip(spark, d):
    """The source role as delimited files by year, declared as a landing
    table, its folders registered, and read back; blanks come back as nulls."""
    db = _database(spark, "landing_round_trip")
    path = f"{checkpoint_dir(spark).rstrip('/')}/{db}-{spark.sparkContext.startTime}"
    # Orders go through the join in slices, each slice's shuffle is removed when it
    # is written, and the tasks that join rows write them (a year's rows are split
    # between tasks), compressed: as plain text they are seven times their tables.
    rows = _with_year(td.src_shipments(spark, d))
    n = min(MAX_SLICES, max(1, math.ceil(scanned_bytes(rows) / SLICE_BYTES)))
    with shuffles_removed(spark):
        for k in range(n):
            part = rows if n == 1 else _with_year(td.src_shipments(spark, d, part=(k, n)))
            write_delimited(part, path, partition_by=["ship_year"], mode="append" if k else "overwrite", compression="gzip")
    ensure_landing_table(spark, f"{db}.landing", rows.schema, path, ["ship_year"])
    refresh_partitions(spark, f"{db}.landing")
    return read_table(spark, f"{db}.landing").drop("ship_year")


def q_gate_reports(spark, d):
    """K1-K3: row count, duplicated keys and the error rate as the gates see them."""
    src = td.src_shipments(spark, d)
    stg = stage_shipments(src, td.shipment_day_events(spark, d), None, MIN_VALUE, td.RUN_STAMP)
    dims = [build_dim(f(spark, d), s, td.LOAD_DT, td.RUN_STAMP)
            for f, s in ((td.src_carrier_master, schemas.DIM_CARRIER), (td.src_route_master, schemas.DIM_ROUTE))]
    n = require_rows(src, "src")
    rate = rate_gate(require_rows(dq_errors(stg, *dims, td.RUN_STAMP), "dq"), require_rows(stg, "stg"), 5)
    dups = duplicate_keys(src, ["shipment_id", "trans_dt"], present=["shipment_id"])
    one = lambda gate, label, v: spark.range(1).select(F.lit(gate).alias("gate"), F.lit(label).alias("label"), F.lit(v).cast("long").alias("value"))
    listed = dups.select(F.lit("duplicates").alias("gate"), F.concat_ws("|", "shipment_id", "trans_dt").alias("label"), F.col("cnt").alias("value"))
    return one("rows", "src", n).unionByName(one("error_rate", "percent", rate.value)).unionByName(listed)


def _landed(spark: SparkSession, d: str, query: str) -> RunParams:
    """Landing tables of the whole roles, and empty targets."""
    db = _database(spark, query)
    p = RunParams(run_dt="1996-12-09", landing_db=db, uc_db=db, dim_db=db,
                  min_declared_value=MIN_VALUE, run_stamp=td.RUN_STAMP)
    roles = {
        "src_shipments": td.src_shipments, "src_shipment_events": td.shipment_day_events,
        "src_carrier_master": td.src_carrier_master, "src_route_master": td.src_route_master,
    }
    for name, role in roles.items():
        role(spark, d).write.saveAsTable(f"{db}.{name}")
    jobs.create_targets(spark, p)
    return p


def _all_days(spark: SparkSession, p: RunParams) -> list[str]:
    """Every day of the landed source; names of days only reach the driver."""
    return sorted(r[0] for r in spark.table(f"{p.landing_db}.src_shipments").select("trans_dt").distinct().collect())


def q_job_ingest(spark, d):
    """P1 over every day of the source in one pass; the staged rows of the days
    that its gates let through."""
    p = _landed(spark, d, "job_ingest")
    jobs.ingest_days(spark, p, _all_days(spark, p))
    return read_table(spark, f"{p.uc_db}.stg_shipments").drop("load_timestamp")


def q_job_gates(spark, d):
    """K1 and K2 by day, refusals included (and a day that has no rows)."""
    p = _landed(spark, d, "job_gates")
    return jobs.gate_days(spark, p, [*_all_days(spark, p), "2031-01-01"])


def q_job_refresh(spark, d):
    """P2, twice (the second run keeps snapshots); both dimensions."""
    p = _landed(spark, d, "job_refresh")
    for _ in range(2):
        jobs.refresh_dims(spark, p, td.LOAD_DT)
    side = lambda dim, key: read_table(spark, f"{p.dim_db}.{dim}").select(
        F.lit(dim).alias("dim"), F.col(key).alias("id"), "status", "eff_dt", "exp_dt")
    return side("dim_carrier", "carrier_id").unionByName(side("dim_route", "route_id"))


def _summarized(spark: SparkSession, d: str, query: str) -> RunParams:
    p = _landed(spark, d, query)
    jobs.refresh_dims(spark, p, td.LOAD_DT)
    jobs.load_days(spark, p, _all_days(spark, p))
    return p


def q_job_summary(spark, d):
    """P1 and P3 over every day; the summary's rows and the error rows."""
    p = _summarized(spark, d, "job_summary")
    done = read_table(spark, f"{p.uc_db}.shipment_summary").select(
        "report_date", F.lit("summary").alias("kind"), "carrier_id", "route_id", "service_level",
        F.col("total_count").alias("n"), F.col("approval_rate").alias("shown"))
    errors = read_table(spark, f"{p.uc_db}.shipment_dq_errors").select(
        F.col("trans_dt").alias("report_date"), F.col("error_code").alias("kind"), "carrier_id", "route_id",
        F.col("shipment_id").alias("service_level"), F.lit(1).cast("long").alias("n"), F.col("error_description").alias("shown"))
    return done.unionByName(errors)


def _exports(spark: SparkSession, d: str, query: str) -> tuple[RunParams, str]:
    p = _summarized(spark, d, query)
    return p, f"{checkpoint_dir(spark).rstrip('/')}/{p.uc_db}-{spark.sparkContext.startTime}"


def q_job_export(spark, d):
    """P4 for one month: the published file's lines, with the audit record's
    status and count."""
    p, place = _exports(spark, d, "job_export")
    jobs.export_month(spark, p, f"{place}.csv", month="1996-12")
    log = read_table(spark, f"{p.uc_db}.export_log")
    lines = spark.read.text(f"{place}.csv").withColumnRenamed("value", "line")
    # The log has the one record of this run's database.
    return lines.select("line", log.select("status").scalar().alias("status"), log.select("record_cnt").scalar().alias("record_cnt"))


def q_job_export_outcomes(spark, d):
    """The audit records of an export that succeeds, of a month
    with nothing to export, and of one whose file isn't framed as it should be
    and whose error text is longer than a record holds."""
    p, place = _exports(spark, d, "job_export_outcomes")
    jobs.export_month(spark, p, f"{place}-good.csv", month="1996-12")
    log = f"{p.uc_db}.export_log"
    try:
        jobs.export_month(spark, p, f"{place}-none.csv", month="1890-01")
    except GateError:
        pass
    broken = f"{place}-broken"
    kept = read_table(spark, f"{p.uc_db}.shipment_summary").where("report_month = '1996-12'")
    sinks.write_framed_csv(kept, broken, schemas.EXPORT_COLUMNS, jobs.EXPORT_ORDER)
    lines = spark.read.text(broken).where(~F.col("value").startswith(sinks.TRAILER_PREFIX))
    lines.write.text(f"{broken}-cut")
    try:
        with audited(spark, log, p.job_name, p.run_stamp, "1996-12", f"{broken}-cut"):
            try:
                validate_framed_csv(spark, f"{broken}-cut", schemas.EXPORT_COLUMNS)
            except GateError as e:
                raise GateError(f"{e} " + "x" * 5000) from None
    except GateError:
        pass
    return read_table(spark, log).select(
        "job_name", "run_dt", "export_month", "record_cnt", "status", F.length("error_message").alias("error_chars"),
        F.regexp_extract("error_message", r"(nothing to export|0 trailer line)", 1).alias("error"),
    ).withColumn("error_chars", F.when(F.col("error") == "nothing to export", F.lit(None)).otherwise(F.col("error_chars")))


def q_snapshot_checks(spark, d):
    """K4, K8: a dimension and its snapshot by count and content: alike, with a
    changed value (equal counts), with a row less, and rows in another order."""
    db = _database(spark, "snapshot_checks")
    rows = td.src_shipments(spark, d)
    sinks.ensure_table(spark, f"{db}.now", rows.schema)
    sinks.overwrite_table(rows, f"{db}.now")
    sinks.snapshot_table(spark, f"{db}.now", f"{db}.kept")
    now, kept = spark.table(f"{db}.now"), spark.table(f"{db}.kept")
    first = F.col("shipment_id") == kept.agg(F.min(F.when(F.col("shipment_id") != "", F.col("shipment_id")))).scalar()
    sides = {
        "same": kept, "ordered": kept.orderBy(F.desc("shipment_id")), "without_first": kept.where(~first),
        "changed": kept.withColumn("tracking_number", F.when(first, F.lit("changed")).otherwise(F.col("tracking_number"))),
    }
    out = None
    for name, other in sides.items():
        r = compare_content(now, other).select(F.lit(name).alias("side"), "left_cnt", "right_cnt", "same_cnt", "same_content")
        out = r if out is None else out.unionByName(r)
    return out


def q_landing_rejects(spark, d):
    """A1, A2, K1: landing files some of whose lines have an amount that is none,
    a field too few or a field too many; what is read, and what is set aside."""
    db = _database(spark, "landing_rejects")
    path = f"{checkpoint_dir(spark).rstrip('/')}/{db}-{spark.sparkContext.startTime}"
    rows = td.src_shipments(spark, d)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.SRC_SHIPMENTS.names]
    at = schemas.SRC_SHIPMENTS.names.index("weight_kg")
    has = lambda number: F.col("tracking_number") == number
    spoiled = [F.when(has("11"), F.lit("n/a")).otherwise(c) if i == at else c for i, c in enumerate(cells)]
    line = F.concat_ws("\t", *spoiled)
    line = F.when(has("12"), F.concat_ws("\t", *cells[:-1])).when(has("13"), F.concat(line, F.lit("\tmore"))).otherwise(line)
    rows.select(line.alias("line")).write.text(path)
    good, bad = read_checked(spark, path, schemas.SRC_SHIPMENTS, header=False)
    kept = keep_rejects(bad, f"{db}.rejects", "src_shipments", td.RUN_STAMP)
    counts = good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"), F.sum("weight_kg").cast("decimal(18,2)").alias("weight"))
    return counts.unionByName(
        spark.table(kept).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).withColumn("weight", F.lit(None).cast("decimal(18,2)"))
    )


def q_enrich_latest_bucketed(spark, d):
    """C1 on tables bucketed by their key: no shuffle joins or groups them; must equal ``enrich_latest``."""
    db = _database(spark, "enrich_latest_bucketed")
    orders = td.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderkey").cast("string").alias("__key")
    )
    events = td.src_shipment_events(spark, d).select("shipment_id", "event_id", *EVENT_TAKE)
    n = bucket_count(orders, events)
    left, right = write_bucketed(orders, f"{db}.orders", ["__key"], n), write_bucketed(events, f"{db}.events", ["shipment_id"], n)
    return enrich_latest(left, right, [("__key", "shipment_id")], ["event_ts"], EVENT_TAKE, ["event_id"]).drop("__key")


TABLE_QUERIES = {
    "enrich_latest_bucketed": q_enrich_latest_bucketed,
    "partition_overwrite": q_partition_overwrite,
    "partition_overwrite_two_level": q_partition_overwrite_two_level,
    "snapshot_restore": q_snapshot_restore,
    "landing_round_trip": q_landing_round_trip,
    "gate_reports": q_gate_reports,
    "job_ingest": q_job_ingest,
    "job_gates": q_job_gates,
    "job_export_outcomes": q_job_export_outcomes,
    "snapshot_checks": q_snapshot_checks,
    "landing_rejects": q_landing_rejects,
    "job_refresh": q_job_refresh,
    "job_summary": q_job_summary,
    "job_export": q_job_export,
}
