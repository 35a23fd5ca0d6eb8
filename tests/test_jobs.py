"""P1-P4 end to end in a scratch warehouse, on FIXTURES.md rows."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators.gates import GateError
from cargomart.operators.sinks import ensure_table, overwrite_partition, overwrite_table
from cargomart.params import RunParams
from cargomart.plans import jobs
from tests import fixtures as fx


@pytest.fixture
def mart(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    p = RunParams(run_dt="2026-05-15", landing_db=f"land_{tag}", uc_db=f"uc_{tag}", dim_db=f"dim_{tag}",
                  run_stamp=fx.STAMP, job_name="monthly_shipment_export")
    spark.sql(f"CREATE DATABASE {p.landing_db}")
    t = jobs.create_targets(spark, p)
    ensure_table(spark, t.src_shipments, schemas.SRC_SHIPMENTS, ["trans_dt"])
    ensure_table(spark, t.src_shipment_events, schemas.SRC_SHIPMENT_EVENTS, ["event_dt"])
    ensure_table(spark, t.src_carrier_master, schemas.SRC_CARRIER_MASTER)
    ensure_table(spark, t.src_route_master, schemas.SRC_ROUTE_MASTER)
    overwrite_table(fx.carrier_master_df(spark), t.src_carrier_master)
    overwrite_table(fx.route_master_df(spark), t.src_route_master)
    events = spark.createDataFrame([
        fx.event("E1", "good", "2026-05-14 08:00:00", "PICKUP"),
        fx.event("E2", "good", "2026-05-14 18:00:00", "DELIVERED", "HEL"),
        fx.event("E3", "sailing", "2026-05-13 18:00:00", "OLD", day="2026-05-13"),
    ], fx.EVENT_SCHEMA)
    for d in ("2026-05-13", "2026-05-14"):
        overwrite_partition(events.where(F.col("event_dt") == d), t.src_shipment_events, {"event_dt": d})
    return p, t, str(tmp_path)


def load_source(spark, t, rows, day=fx.DAY):
    overwrite_partition(fx.source_df(spark, rows), t.src_shipments, {"trans_dt": day})


def test_ingest_aborts_on_duplicates(spark, mart):
    p, t, _ = mart
    load_source(spark, t, fx.SOURCE_ROWS)
    with pytest.raises(GateError, match="good"):
        jobs.ingest_day(spark, p)
    assert spark.table(t.stg_shipments).count() == 0  # nothing written


def test_ingest_empty_source_fails(spark, mart):
    p, _, _ = mart
    with pytest.raises(GateError, match="no rows"):
        jobs.ingest_day(spark, p, "2026-05-01")


def test_all_jobs(spark, mart):
    p, t, tmp = mart
    load_source(spark, t, fx.SOURCE_ROWS[:9])
    r = jobs.ingest_day(spark, p)
    assert (r["trans_dt"], r["src_cnt"], r["stg_cnt"]) == (fx.DAY, 9, 4)
    stg = {x["shipment_id"]: x for x in spark.table(t.stg_shipments).collect()}
    assert sorted(stg) == ["good", "sailing", "stray", "untracked"]
    assert stg["good"]["last_event_type_cd"] == "DELIVERED"
    assert stg["sailing"]["last_event_type_cd"] is None  # event of another day is ignored
    assert stg["good"]["load_timestamp"] == fx.STAMP
    # rerun is idempotent
    jobs.ingest_day(spark, p)
    assert spark.table(t.stg_shipments).count() == 4

    d = jobs.refresh_dims(spark, p)
    assert (d["carrier_cnt"], d["route_cnt"], d["dim_carrier"], d["dim_route"]) == (2, 2, 2, 2)
    d2 = jobs.refresh_dims(spark, p)  # second run snapshots the first
    assert d2["dim_carrier_bkp"] == 2 and d2["dim_route_bkp"] == 2

    s = jobs.summarize_day(spark, p)
    assert (s["stg_cnt"], s["summary_cnt"], s["error_cnt"]) == (4, 3, 2)
    assert s["failing_shipments"] == 2 and s["report"]["shipment_summary"] == 3
    assert s["error_rate"].value == 50 and not s["error_rate"].ok  # 2*100 div 4 = 50 > 5: warn
    errs = sorted((x["shipment_id"], x["error_code"]) for x in spark.table(t.shipment_dq_errors).collect())
    assert errs == [("stray", "ERR_NO_DIM_CARRIER"), ("untracked", "ERR_NULL_MANDATORY")]

    # a second day keeps the first (Q1)
    other = [tuple(list(r[:-1]) + ["2026-05-13"]) for r in fx.SOURCE_ROWS[:2]]
    overwrite_partition(fx.source_df(spark, other), t.src_shipments, {"trans_dt": "2026-05-13"})
    jobs.ingest_day(spark, p, "2026-05-13")
    jobs.summarize_day(spark, p, "2026-05-13")
    days = sorted(r[0] for r in spark.table(t.shipment_summary).select("report_date").distinct().collect())
    assert days == ["2026-05-13", fx.DAY]

    # export of May (run on June 1st): header, 4 rows, trailer
    pe = RunParams(run_dt="2026-06-01", landing_db=p.landing_db, uc_db=p.uc_db, dim_db=p.dim_db,
                   job_name="monthly_shipment_export")
    dest = os.path.join(tmp, "outbound", "shipment_summary_2026-05.csv")
    e = jobs.export_month(spark, pe, dest, single_file=True)
    assert e["record_cnt"] == 4 and e["export_month"] == "2026-05"
    lines = open(dest).read().splitlines()
    assert lines[0] == ",".join(schemas.EXPORT_COLUMNS) and lines[-1] == "TRAILER,4" and len(lines) == 6
    assert [ln.split(",")[0] for ln in lines[1:-1]] == sorted(ln.split(",")[0] for ln in lines[1:-1])
    # distributed (multi-part) export publishes ordered parts
    dest2 = os.path.join(tmp, "outbound", "parts_2026-05")
    jobs.export_month(spark, pe, dest2, single_file=False)
    body = []
    for f in sorted(glob.glob(os.path.join(dest2, "part-*"))):
        body += open(f).read().splitlines()
    assert body == lines
    # empty month: error and a FAILED audit row
    with pytest.raises(GateError):
        jobs.export_month(spark, pe, os.path.join(tmp, "outbound", "none.csv"), month="1999-12")
    log = sorted((r["export_month"], r["status"], r["record_cnt"]) for r in spark.table(t.export_log).collect())
    assert log == [("1999-12", "FAILED", 0), ("2026-05", "SUCCESS", 4), ("2026-05", "SUCCESS", 4)]
    import re
    assert all(re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", r["run_dt"]) for r in spark.table(t.export_log).collect())


def test_dim_refresh_gate_per_source(spark, mart):
    p, t, _ = mart
    overwrite_table(fx.route_master_df(spark).where("false"), t.src_route_master)
    with pytest.raises(GateError, match="route"):
        jobs.refresh_dims(spark, p)
    assert spark.table(t.dim_carrier).count() == 0  # nothing overwritten


def test_dim_refresh_rejects_duplicate_keys(spark, mart):
    p, t, _ = mart
    overwrite_table(fx.carrier_master_df(spark).unionByName(fx.carrier_master_df(spark)), t.src_carrier_master)
    with pytest.raises(GateError, match="carrier"):
        jobs.refresh_dims(spark, p)


def test_backfill_missing_days(spark, mart):
    p, t, _ = mart
    jobs.refresh_dims(spark, p)
    rows = fx.SOURCE_ROWS[:9]
    for day in ("2026-05-12", "2026-05-13", fx.DAY):
        load_source(spark, t, [tuple(list(r[:-1]) + [day]) for r in rows], day)
    jobs.ingest_day(spark, p, "2026-05-13")
    assert jobs.days_to_backfill(spark, p) == ["2026-05-12", fx.DAY]
    # a day that fails its gate doesn't keep the other from being loaded
    good = spark.table(t.src_shipments).where("trans_dt = '2026-05-12'").drop("trans_dt").collect()
    load_source(spark, t, [tuple(list(r[:-1]) + ["2026-05-12"]) for r in rows + rows[:1]], "2026-05-12")
    with pytest.raises(GateError, match="2026-05-12") as info:
        jobs.backfill(spark, p)
    assert [("error" in d) for d in info.value.outcomes] == [True, False] and len(good) == 9
    load_source(spark, t, [tuple(list(r[:-1]) + ["2026-05-12"]) for r in rows], "2026-05-12")
    done = jobs.backfill(spark, p, ["2026-05-12", fx.DAY])
    assert [d["ingest"]["trans_dt"] for d in done] == ["2026-05-12", fx.DAY]
    assert jobs.days_to_backfill(spark, p) == []
    assert spark.table(t.shipment_summary).select("report_date").distinct().count() == 2


def test_failed_dim_refresh_rolls_back(spark, mart, monkeypatch):
    p, t, _ = mart
    jobs.refresh_dims(spark, p)
    before = sorted(r[0] for r in spark.table(t.dim_route).select("route_id").collect())
    real = jobs.overwrite_table
    calls = []

    def failing(df, table):
        calls.append(table)
        if table == t.dim_route:
            raise RuntimeError("executor lost for good")
        return real(df, table)

    monkeypatch.setattr(jobs, "overwrite_table", failing)
    with pytest.raises(RuntimeError):
        jobs.refresh_dims(spark, p)
    assert calls == [t.dim_carrier, t.dim_route]
    assert sorted(r[0] for r in spark.table(t.dim_route).select("route_id").collect()) == before
    assert spark.table(t.dim_carrier).count() == 2


def test_a_filter_that_keeps_nothing_leaves_the_day(spark, mart):
    from dataclasses import replace
    from decimal import Decimal

    p, t, _ = mart
    load_source(spark, t, fx.SOURCE_ROWS[:9])
    jobs.refresh_dims(spark, p)
    jobs.ingest_day(spark, p)
    jobs.summarize_day(spark, p)
    before = [spark.table(x).count() for x in (t.stg_shipments, t.shipment_summary)]
    with pytest.raises(GateError, match="no rows"):
        jobs.ingest_day(spark, replace(p, min_declared_value=Decimal("1000000.00")))
    overwrite_table(spark.table(t.dim_carrier).where("false"), t.dim_carrier)
    with pytest.raises(GateError, match="no rows"):
        jobs.summarize_day(spark, p)
    assert [spark.table(x).count() for x in (t.stg_shipments, t.shipment_summary)] == before and min(before) > 0


def test_many_days_load_in_one_pass_as_day_by_day(spark, mart):
    p, t, _ = mart
    jobs.refresh_dims(spark, p)
    rows = fx.SOURCE_ROWS[:9]
    redated = lambda day, rows: [tuple(list(r[:-1]) + [day]) for r in rows]
    load_source(spark, t, redated("2026-05-12", rows), "2026-05-12")
    load_source(spark, t, redated("2026-05-13", rows + rows[:1]), "2026-05-13")  # a duplicate
    load_source(spark, t, redated(fx.DAY, rows), fx.DAY)
    load_source(spark, t, redated("2026-05-11", rows[1:3]), "2026-05-11")  # nothing that the filters keep
    days = ["2026-05-11", "2026-05-12", "2026-05-13", fx.DAY, "2026-05-20"]
    got = {r["trans_dt"]: r for r in jobs.load_days(spark, p, days)}
    assert {d: r["gate"] for d, r in got.items()} == {
        "2026-05-11": "NOTHING_STAGED", "2026-05-12": "OK", "2026-05-13": "DUPLICATES", fx.DAY: "OK", "2026-05-20": "NO_ROWS"}
    assert got["2026-05-13"]["dup_cnt"] == 1 and got["2026-05-13"]["src_cnt"] == 10
    shown = lambda: [sorted(map(str, spark.table(x).collect())) for x in (t.stg_shipments, t.shipment_dq_errors, t.shipment_summary)]
    at_once = shown()
    for day in ("2026-05-12", fx.DAY):
        one, two = jobs.ingest_day(spark, p, day), jobs.summarize_day(spark, p, day)
        assert (one["stg_cnt"], two["error_cnt"], two["summary_cnt"]) == tuple(got[day][k] for k in ("stg_cnt", "error_cnt", "summary_cnt"))
    assert shown() == at_once
    assert jobs.load_days(spark, p, []) == []
