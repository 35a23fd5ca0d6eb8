"""Plan-shape tests (SURVEY §5 (5)): the physical plans we rely on at scale."""

import uuid

import pytest
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators.sinks import ensure_table, overwrite_partition, overwrite_table
from cargomart.operators.windows import latest_per_key
from cargomart.params import RunParams
from cargomart.plans import jobs
from cargomart.plans.definitions import active_filter
from cargomart.plans.transforms import build_dim, dq_errors, month_rows, stage_shipments, summary_rows
from tests import fixtures as fx


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def mart(spark):
    tag = uuid.uuid4().hex[:8]
    p = RunParams(run_dt="2026-05-15", landing_db=f"pl_{tag}", uc_db=f"pu_{tag}", dim_db=f"pd_{tag}", run_stamp=fx.STAMP)
    spark.sql(f"CREATE DATABASE {p.landing_db}")
    t = jobs.create_targets(spark, p)
    ensure_table(spark, t.src_shipments, schemas.SRC_SHIPMENTS, ["trans_dt"])
    ensure_table(spark, t.src_shipment_events, schemas.SRC_SHIPMENT_EVENTS, ["event_dt"])
    overwrite_partition(fx.source_df(spark, fx.SOURCE_ROWS[:9]), t.src_shipments, {"trans_dt": fx.DAY})
    overwrite_partition(fx.source_df(spark, fx.SOURCE_ROWS[:9]), t.src_shipments, {"trans_dt": "2026-05-13"})
    overwrite_table(build_dim(fx.carrier_master_df(spark), schemas.DIM_CARRIER, fx.LOAD_DT), t.dim_carrier)
    overwrite_table(build_dim(fx.route_master_df(spark), schemas.DIM_ROUTE, fx.LOAD_DT), t.dim_route)
    return p, t


def test_ingest_scan_prunes_and_pushes(spark, mart):
    p, t = mart
    src = spark.table(t.src_shipments)
    stg = stage_shipments(src, spark.table(t.src_shipment_events), fx.DAY)
    text = plan(stg)
    scan = [ln for ln in text.splitlines() if "FileScan" in ln and "src_shipments" in ln][0]
    assert "PartitionFilters: [isnotnull(trans_dt" in scan and "= 2026-05-14" in scan
    for pushed in ("Not(EqualTo(record_type,TEST))", "Not(EqualTo(record_type,INTERNAL))",
                   "In(shipment_status_code", "GreaterThanOrEqual(declared_value,10.00)", "IsNotNull(carrier_id)"):
        assert pushed in scan
    # column pruning: source_system_cd is not part of staging
    assert "source_system_cd" not in scan.split("ReadSchema:")[1]


def test_summary_broadcasts_proven_dims_and_prunes(spark, mart):
    p, t = mart
    stg = spark.table(t.stg_shipments).where(F.col("trans_dt") == fx.DAY)
    text = plan(summary_rows(stg, spark.table(t.dim_carrier), spark.table(t.dim_route)))
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text
    assert "PartitionFilters: [isnotnull(trans_dt" in text
    # partial aggregation before the shuffle
    assert "partial_count" in text[text.index("Exchange hashpartitioning"):]


def test_one_pass_rules_scan_staging_once(spark, mart):
    p, t = mart
    stg = spark.table(t.stg_shipments).where(F.col("trans_dt") == fx.DAY)
    dc, dr = spark.table(t.dim_carrier), spark.table(t.dim_route)

    def stg_scans(df):
        return sum(1 for ln in plan(df).splitlines() if "FileScan" in ln and "stg_shipments" in ln)

    assert stg_scans(dq_errors(stg, dc, dr)) == 1
    assert stg_scans(dq_errors(stg, dc, dr, one_pass=False)) == 4


def test_export_month_prunes_partitions(spark, mart):
    p, t = mart
    text = plan(month_rows(spark.table(t.shipment_summary), "2026-05"))
    scan = [ln for ln in text.splitlines() if "FileScan" in ln][0]
    assert "PartitionFilters: [isnotnull(report_month" in scan and "= 2026-05" in scan


def test_latest_per_key_combines_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    text = plan(latest_per_key(df, ["k"], ["ts"]))
    assert "partial_max" in text
    assert text.index("Exchange hashpartitioning") < text.index("partial_max")  # partial sits below the exchange


def test_no_estimate_based_broadcast(spark):
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    a = spark.range(100).withColumnRenamed("id", "k")
    b = spark.range(100).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" not in plan(a.join(b, "k"))


def test_active_filter_is_one_predicate(spark):
    df = fx.carrier_master_df(spark)
    out = active_filter(fx.LOAD_DT).apply(df)
    assert out.count() == 2


def test_adapter_day_slice_reaches_parquet(spark):
    import os

    from cargomart.sources import testdata as td

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("driver test tables not present")
    day = td.src_shipments(spark, d, trans_dt="1996-12-01")
    scan = [ln for ln in plan(day).splitlines() if "FileScan" in ln and "lineitem" in ln][0]
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    whole = td.src_shipments(spark, d)
    assert day.count() == whole.where(F.col("trans_dt") == "1996-12-01").count()
    ev = td.src_shipment_events(spark, d, event_dt="2024-01-02")
    scan = [ln for ln in plan(ev).splitlines() if "FileScan" in ln and "events" in ln][0]
    assert "GreaterThanOrEqual(ts" in scan
