"""Sinks (A5, A7-A15) and gates (K1-K7) in a scratch warehouse."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators import sinks
from cargomart.operators.gates import (
    GateError,
    audited,
    rate_gate,
    require_rows,
    require_unique,
    snapshot_report,
    validate_framed_csv,
)
from cargomart.sources.catalog import fetch_summary
from tests import fixtures as fx


def _db(spark):
    name = "t" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {name}")
    return name


def _lines(path):
    files = sorted(glob.glob(os.path.join(path, "part-*"))) if os.path.isdir(path) else [path]
    out = []
    for f in files:
        with open(f) as fh:
            out += fh.read().splitlines()
    return out


def test_partition_overwrite_static(spark):
    db = _db(spark)
    t = f"{db}.stg"
    sinks.ensure_table(spark, t, schemas.STG_SHIPMENTS, ["trans_dt"])
    sinks.ensure_table(spark, t, schemas.STG_SHIPMENTS, ["trans_dt"])  # idempotent, never drops
    stg = fx.staging_from(fx.source_df(spark))
    sinks.overwrite_partition(stg.where("shipment_status_code = 'DELIVERED'"), t, {"trans_dt": "2026-05-14"})
    sinks.overwrite_partition(stg, t, {"trans_dt": "2026-05-15"})
    assert spark.table(t).where("trans_dt = '2026-05-14'").count() == sum(r[7] == "DELIVERED" for r in fx.SOURCE_ROWS)
    # rerun replaces only that day
    sinks.overwrite_partition(stg.limit(2), t, {"trans_dt": "2026-05-14"})
    assert spark.table(t).where("trans_dt = '2026-05-14'").count() == 2
    assert spark.table(t).where("trans_dt = '2026-05-15'").count() == 10
    # an empty rerun clears the day (Q2), also in dynamic overwrite mode
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.overwrite_partition(stg.where("false"), t, {"trans_dt": "2026-05-14"})
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert spark.table(t).where("trans_dt = '2026-05-14'").count() == 0
    assert spark.table(t).count() == 10
    with pytest.raises(ValueError):
        sinks.overwrite_partition(stg, t, {"trans_dt": "x'; DROP TABLE y; --"})


def test_two_level_summary_partition_keeps_other_days(spark):
    db = _db(spark)
    t = f"{db}.summary"
    sinks.ensure_table(spark, t, schemas.SHIPMENT_SUMMARY, ["report_month", "report_date"])
    s = fx.summary_df(spark)
    for d in ("2026-04-03", "2026-04-11", "2026-04-29"):
        sinks.overwrite_partition(s.where(F.col("report_date") == d), t, {"report_month": "2026-04", "report_date": d})
    sinks.overwrite_partition(s.where("false"), t, {"report_month": "2026-04", "report_date": "2026-04-11"})
    assert sorted(r[0] for r in spark.table(t).select("report_date").collect()) == ["2026-04-03", "2026-04-29"]
    assert [c for c in spark.table(t).columns][-2:] == ["report_month", "report_date"]


def test_snapshot_restore_append(spark):
    db = _db(spark)
    dim, bkp = f"{db}.dim_carrier", f"{db}.dim_carrier_bkp"
    sinks.ensure_table(spark, dim, schemas.DIM_CARRIER)
    from cargomart.plans.transforms import build_dim

    d = build_dim(fx.carrier_master_df(spark), schemas.DIM_CARRIER, fx.LOAD_DT, fx.STAMP)
    sinks.overwrite_table(d, dim)
    sinks.snapshot_table(spark, dim, bkp)
    assert spark.table(bkp).schema == spark.table(dim).schema
    assert snapshot_report(spark, dim, bkp).value == 2
    sinks.overwrite_table(d.limit(1), dim)
    with pytest.raises(GateError):
        snapshot_report(spark, dim, bkp)
    sinks.restore_table(spark, bkp, dim)
    assert spark.table(dim).count() == 2
    sinks.append_rows(d.select(*reversed(d.columns)), dim)  # by name, not position
    assert spark.table(dim).where("carrier_name = 'Nordic Line'").count() == 2


@pytest.mark.parametrize("single_file", [True, False])
def test_framed_csv_matches_expected(spark, tmp_dir, single_file):
    rows = fx.summary_df(spark).where(F.col("report_date").startswith("2026-04-"))
    out = sinks.write_framed_csv(rows.select(*schemas.EXPORT_COLUMNS), os.path.join(tmp_dir, "x"),
                                 schemas.EXPORT_COLUMNS, ["report_date", "carrier_id", "route_id", "service_level"],
                                 single_file=single_file)
    assert _lines(out) == fx.export_lines("2026-04")
    res = validate_framed_csv(spark, out, schemas.EXPORT_COLUMNS)
    assert res.ok and res.value == 3
    dest = os.path.join(tmp_dir, "outbound", "summary_2026-04.csv")
    os.makedirs(dest)  # a stale export of either kind is replaced
    sinks.publish(spark, out, dest, single_file)
    assert os.path.isfile(dest) is single_file and os.listdir(os.path.dirname(dest)).count("summary_2026-04.csv") == 1
    assert _lines(dest) == fx.export_lines("2026-04")


def test_framed_csv_sort_nulls_first(spark, tmp_dir):
    s = fx.summary_df(spark).withColumn("report_date", F.lit("2026-04-01"))
    out = sinks.write_framed_csv(s.select(*schemas.EXPORT_COLUMNS), os.path.join(tmp_dir, "n"),
                                 schemas.EXPORT_COLUMNS, ["report_date", "carrier_id"], single_file=True)
    body = _lines(out)[1:-1]
    assert body[0].split(",")[2] == "" and _lines(out)[-1] == "TRAILER,4"


def test_framed_csv_comma_fails_or_quotes(spark, tmp_dir):
    s = fx.summary_df(spark).withColumn("carrier_name", F.lit('Baltic, "Ro-Ro"'))
    with pytest.raises(Exception):
        sinks.write_framed_csv(s.select(*schemas.EXPORT_COLUMNS), os.path.join(tmp_dir, "c"), schemas.EXPORT_COLUMNS,
                               single_file=True)
    out = sinks.write_framed_csv(s.select(*schemas.EXPORT_COLUMNS), os.path.join(tmp_dir, "q"), schemas.EXPORT_COLUMNS,
                                 ["report_date"], single_file=True, quote="minimal")
    assert '"Baltic, ""Ro-Ro"""' in _lines(out)[1]


def test_validate_framed_csv_failures(spark, tmp_dir):
    def write(name, lines):
        d = os.path.join(tmp_dir, name)
        os.makedirs(d)
        with open(os.path.join(d, "part-00000.txt"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        return d

    hdr = ",".join(schemas.EXPORT_COLUMNS)
    assert validate_framed_csv(spark, write("ok", [hdr, "a", "TRAILER,1"]), schemas.EXPORT_COLUMNS).ok
    for name, lines in [("short", [hdr, "TRAILER,0"]), ("count", [hdr, "a", "b", "TRAILER,1"]),
                        ("notrailer", [hdr, "a", "b"]), ("twohdr", [hdr, hdr, "a", "TRAILER,2"]),
                        ("garbage", [hdr, "a", "TRAILER," + "0" * 39 + "1GARBAGE"]), ("padded", [hdr, "a", "TRAILER,01"])]:
        with pytest.raises(GateError):
            validate_framed_csv(spark, write(name, lines), schemas.EXPORT_COLUMNS)


def test_require_rows_and_unique(spark):
    src = fx.source_df(spark)
    assert require_rows(src, "src") == 10
    with pytest.raises(GateError):
        require_rows(src.where("false"), "empty")
    with pytest.raises(GateError, match="good"):
        require_unique(src, ["shipment_id", "trans_dt"], ["shipment_id"])
    assert require_unique(src.dropDuplicates(), ["shipment_id"]) == 0
    from cargomart.operators.gates import require_rows_unique

    with pytest.raises(GateError, match="good"):
        require_rows_unique(src, ["shipment_id", "trans_dt"], ["shipment_id"], "src")
    assert require_rows_unique(src.dropDuplicates(), ["shipment_id", "trans_dt"], ["shipment_id"], "src") == 9
    with pytest.raises(GateError, match="no rows"):
        require_rows_unique(src.where("false"), ["shipment_id"], label="empty")
    blanks = fx.source_df(spark, [("",) + fx.SOURCE_ROWS[0][1:]] * 3)
    assert require_rows_unique(blanks, ["shipment_id"], ["shipment_id"], "blank ids") == 3


@pytest.mark.parametrize("e,b,rate,warn", [(2, 100, 2, False), (8, 100, 8, True), (5, 100, 5, False),
                                           (4, 99, 4, False), (3, 0, 0, False), (2, 5, 40, True)])
def test_rate_gate(e, b, rate, warn):
    g = rate_gate(e, b, 5)
    assert g.value == rate and g.ok is (not warn)


def test_audited_success_and_failure(spark):
    db = _db(spark)
    log = f"{db}.export_log"
    sinks.ensure_table(spark, log, schemas.EXPORT_LOG)
    with audited(spark, log, "job", "2026-05-01", "2026-04", "/x.csv") as a:
        a.record_cnt = 3
    with pytest.raises(RuntimeError):
        with audited(spark, log, "job", "2026-05-01", "2026-04", "/x.csv"):
            raise RuntimeError("boom" * 2000)
    rows = {r["status"]: r for r in spark.table(log).collect()}
    assert rows["SUCCESS"]["record_cnt"] == 3 and rows["SUCCESS"]["error_message"] == ""
    assert rows["FAILED"]["record_cnt"] == 0 and len(rows["FAILED"]["error_message"]) == 4000
    assert rows["FAILED"]["error_message"].startswith("RuntimeError: boom")
    assert spark.table(log).schema["load_timestamp"].dataType.typeName() == "timestamp"


def test_fetch_summary_prunes_partitions(spark):
    db = _db(spark)
    t = f"{db}.summary"
    sinks.ensure_table(spark, t, schemas.SHIPMENT_SUMMARY, ["report_month", "report_date"])
    s = fx.summary_df(spark)
    for r in s.select("report_month", "report_date").distinct().collect():
        sinks.overwrite_partition(s.where(F.col("report_date") == r[1]), t,
                                  {"report_month": r[0], "report_date": r[1]})
    df = fetch_summary(spark, t, "2026-04")
    assert df.count() == 3 and df.columns == schemas.EXPORT_COLUMNS
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "report_month" in plan.split("PartitionFilters")[1][:200]
    assert fetch_summary(spark, t, "1999-12").isEmpty()


def test_table_location_and_refresh_partitions(spark, tmp_dir):
    from cargomart.sources.catalog import read_table, refresh_partitions

    db = _db(spark)
    t = f"{db}.src_shipments"
    loc = os.path.join(tmp_dir, "src_shipments")
    sinks.ensure_table(spark, t, schemas.SRC_SHIPMENTS, ["trans_dt"], location=loc, comment="landing copy")
    assert read_table(spark, t).count() == 0
    # a day dropped into the table folder by another writer
    day = fx.source_df(spark).drop("trans_dt")
    day.write.parquet(os.path.join(loc, "trans_dt=2026-05-14"))
    refresh_partitions(spark, t)
    got = read_table(spark, t)
    assert got.where("trans_dt = '2026-05-14'").count() == 10
    assert got.schema["trans_dt"].dataType.typeName() == "string"


def test_failed_overwrite_keeps_previous_partition(spark):
    db = _db(spark)
    t = f"{db}.stg"
    sinks.ensure_table(spark, t, schemas.STG_SHIPMENTS, ["trans_dt"])
    stg = fx.staging_from(fx.source_df(spark))
    assert sinks.overwrite_partition(stg, t, {"trans_dt": "2026-05-14"}) == 10
    broken = stg.withColumn(
        "shipment_id",
        F.when(F.col("shipment_id") == "stray", F.raise_error(F.lit("task failed mid-write"))).otherwise(F.col("shipment_id")),
    )
    with pytest.raises(Exception, match="task failed mid-write"):
        sinks.overwrite_partition(broken, t, {"trans_dt": "2026-05-14"})
    assert spark.table(t).where("trans_dt = '2026-05-14'").count() == 10  # previous day intact
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_audit_failure_does_not_mask_job_error(spark):
    with pytest.raises(ValueError, match="the job's own error") as info:
        with audited(spark, "no_such_db.export_log", "job", "2026-05-01 07:00:00", "2026-04", "/x.csv"):
            raise ValueError("the job's own error")
    assert any("audit row could not be written" in n for n in getattr(info.value, "__notes__", []))


@pytest.mark.parametrize("rows", [5, 20_000])
@pytest.mark.parametrize("single_file", [True, False])
def test_what_is_published_does_not_depend_on_the_rows(spark, tmp_dir, rows, single_file):
    df = spark.range(rows).repartition(4).select(F.col("id").cast("string").alias("a"))
    out = sinks.write_framed_csv(df, os.path.join(tmp_dir, "x"), ["a"], ["a"], single_file)
    dest = sinks.publish(spark, out, os.path.join(tmp_dir, "pub"), single_file)
    assert os.path.isfile(dest) is single_file and len(_lines(dest)) == rows + 2


def test_a_failed_rename_keeps_the_old_export_and_the_new_one(spark, tmp_dir, monkeypatch):
    dest = os.path.join(tmp_dir, "out.csv")
    with open(dest, "w") as fh:
        fh.write("old\n")
    real = sinks._hadoop_fs

    class Failing:
        def __init__(self, fs, at):
            self.fs, self.left = fs, at

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.left -= 1
            return False if self.left == 0 else self.fs.rename(a, b)

    for step in (1, 2, 3):
        out = sinks.write_framed_csv(spark.range(3).select("id"), os.path.join(tmp_dir, f"x{step}"), ["id"], ["id"], True)
        want = _lines(out)
        failing = {}

        def fs(spark, path, step=step, failing=failing):
            found, p, jvm = real(spark, path)
            if path == dest:
                found = failing.setdefault("fs", Failing(found, step))
            return found, p, jvm

        monkeypatch.setattr(sinks, "_hadoop_fs", fs)
        with pytest.raises(OSError, match="publish failed"):
            sinks.publish(spark, out, dest, True)
        monkeypatch.setattr(sinks, "_hadoop_fs", real)
        assert _lines(dest) == ["old"] and _lines(out) == want
    sinks.publish(spark, out, dest, True)
    assert _lines(dest) == want and not [f for f in os.listdir(tmp_dir) if ".new-" in f or ".old-" in f]


def test_tables_of_another_schema_or_mode_are_refused(spark):
    db = _db(spark)
    sinks.ensure_table(spark, f"{db}.dim", schemas.DIM_CARRIER)
    with pytest.raises(ValueError, match="other columns"):
        sinks.ensure_table(spark, f"{db}.dim", schemas.DIM_ROUTE)
    spark.sql(f"CREATE TABLE {db}.plain (a INT, d STRING) USING parquet PARTITIONED BY (d)")
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        sinks.overwrite_partition(spark.range(1).select(F.col("id").cast("int").alias("a")), f"{db}.plain", {"d": "x"})


def test_a_quote_in_a_location_stays(spark, tmp_dir):
    db = _db(spark)
    loc = os.path.join(tmp_dir, "it's here")
    sinks.ensure_table(spark, f"{db}.dim", schemas.DIM_CARRIER, location=loc)
    d = spark.createDataFrame([], schemas.DIM_CARRIER)
    sinks.overwrite_table(d, f"{db}.dim")
    assert os.path.isdir(loc)
