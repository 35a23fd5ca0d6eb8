"""Operators on FIXTURES.md rows: filter sets (B12), latest per key (E1), joins
(C1-C4), aggregates (D2-D11) and the rule table (G2), plus the equivalences of
SURVEY §5 (one-pass = UNION ALL, anti = left + IS NULL, aggregate = window)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cargomart import schemas
from cargomart.operators.aggregates import (
    combined_count,
    dedupe,
    duplicate_key_count,
    duplicate_keys,
    error_counts,
    rollup_counts,
)
from cargomart.operators.joins import (
    DimSpec,
    bounded_broadcast,
    enrich_latest,
    key_presence,
    orphan_rows,
    probe_size,
    star_join,
)
from cargomart.operators.windows import latest_per_key, latest_per_key_window
from cargomart.plans.definitions import active_filter, ingest_filters
from cargomart.plans.transforms import EVENT_TAKE, build_dim, dq_errors, summary_rows
from tests import fixtures as fx


@pytest.fixture(scope="module")
def src(spark):
    return fx.source_df(spark)


@pytest.fixture(scope="module")
def dims(spark):
    c = build_dim(fx.carrier_master_df(spark), schemas.DIM_CARRIER, fx.LOAD_DT, fx.STAMP)
    r = build_dim(fx.route_master_df(spark), schemas.DIM_ROUTE, fx.LOAD_DT, fx.STAMP)
    return c, r


@pytest.fixture(scope="module")
def stg(src):
    return fx.staging_from(ingest_filters().apply(src))


def shape(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def ids(df, col="shipment_id"):
    return sorted(r[0] for r in df.select(col).collect())


# ----------------------------------------------------------------- B12


def test_ingest_filter_survivors(src):
    out = ingest_filters().apply(src)
    assert ids(out) == fx.SURVIVORS


def test_filter_set_toggles(src):
    fs = ingest_filters()
    assert "refund" in ids(fs.without("min_value").apply(src))
    assert ids(fs.only("excl_test_type").apply(src)).count("probe") == 0
    with pytest.raises(KeyError):
        fs.only("nope")
    extra = fs.plus("priority_only", "service_level = 'PRIORITY'")
    assert ids(extra.apply(src)) == ["good", "good", "sailing", "stray"]


def test_filter_blank_and_null_carrier(spark):
    rows = [fx.SOURCE_ROWS[0][:4] + (c,) + fx.SOURCE_ROWS[0][5:] for c in (None, "", "nord")]
    out = ingest_filters().apply(fx.source_df(spark, rows))
    assert out.count() == 1


# ----------------------------------------------------------------- E1 / C1


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        fx.event("E01", "S1", "2026-05-14 08:00:00"),
        fx.event("E02", "S1", "2026-05-14 09:00:00", "DELIVER"),  # latest wins
        fx.event("E03", "S2", "2026-05-14 09:00:00", "A"),
        fx.event("E04", "S2", "2026-05-14 09:00:00", "B"),  # tie on ts: larger id wins
        fx.event("E05", "S3", None, "NULLTS"),
        fx.event("E06", "S3", "2026-05-14 07:00:00", "REAL"),  # real ts beats NULL
        fx.event("E07", "S1", "2026-05-15 23:00:00", "OTHERDAY", day="2026-05-15"),
        fx.event("E08", "S4", None, "ONLY_NULL_A"),
        fx.event("E09", "S4", None, "ONLY_NULL_B"),
    ]
    return spark.createDataFrame(rows, fx.EVENT_SCHEMA)


def test_latest_per_key_rules(events):
    day = events.where(F.col("event_dt") == fx.DAY)
    out = {r["shipment_id"]: r["event_type_cd"] for r in latest_per_key(day, ["shipment_id"], ["event_ts"], ["event_id"]).collect()}
    assert out == {"S1": "DELIVER", "S2": "B", "S3": "REAL", "S4": "ONLY_NULL_B"}


def test_latest_aggregate_equals_window(events):
    a = latest_per_key(events, ["shipment_id", "event_dt"], ["event_ts"], ["event_id"])
    w = latest_per_key_window(events, ["shipment_id", "event_dt"], ["event_ts"], ["event_id"])
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0 and a.count() == 5


def test_latest_equivalence_generated(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 37).alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 101).alias("ts"),
        F.col("id").alias("eid"),
        (F.col("id") % 5).cast("string").alias("v"),
    )
    a = latest_per_key(df, ["k"], ["ts"], ["eid"])
    w = latest_per_key_window(df, ["k"], ["ts"], ["eid"])
    assert a.count() == 37 and a.exceptAll(w).count() == 0


def test_enrich_latest_keeps_left(spark, events):
    left = spark.createDataFrame(
        [("S1", fx.DAY), ("S2", fx.DAY), ("S3", fx.DAY), ("S9", fx.DAY), ("S1", fx.DAY)],
        "shipment_id string, trans_dt string",
    )
    out = enrich_latest(left, events, [("shipment_id", "shipment_id"), ("trans_dt", "event_dt")],
                        ["event_ts"], EVENT_TAKE, ["event_id"])
    rows = sorted((r["shipment_id"], r["last_event_type_cd"]) for r in out.collect())
    assert rows == [("S1", "DELIVER"), ("S1", "DELIVER"), ("S2", "B"), ("S3", "REAL"), ("S9", None)]
    assert set(out.columns) == {"shipment_id", "trans_dt", *EVENT_TAKE.values()}


# ----------------------------------------------------------------- C2-C4


def test_star_join_inner(stg, dims):
    c, r = dims
    out = star_join(stg, [DimSpec(c, "carrier_id", "carrier_id", ["carrier_name"]),
                          DimSpec(r, "route_id", "route_id", ["region_cd", "transit_mode"])])
    assert ids(out) == ["good", "good", "sailing", "untracked"]
    assert "carrier_name" in out.columns and out.columns.count("carrier_id") == 1


def test_orphans_anti_equals_left_is_null(spark, dims):
    c, _ = dims
    rows = [fx.SOURCE_ROWS[0][:4] + (k,) + fx.SOURCE_ROWS[0][5:] for k in ("nord", "ghost", None, "")]
    fact = fx.source_df(spark, rows)
    anti = orphan_rows(fact, c, "carrier_id", "carrier_id")
    lj = fact.alias("s").join(c.alias("d"), F.col("s.carrier_id") == F.col("d.carrier_id"), "left") \
        .where(F.col("d.carrier_id").isNull()).select("s.*")
    assert anti.count() == 3
    assert anti.exceptAll(lj).count() == 0 and lj.exceptAll(anti).count() == 0


def test_key_presence_never_multiplies(spark, stg, dims):
    c, _ = dims
    doubled = c.unionByName(c)
    out = key_presence(stg, doubled, "carrier_id", "carrier_id", "has_carrier")
    assert out.count() == stg.count()
    flags = {r["shipment_id"]: r["has_carrier"] for r in out.collect()}
    assert flags["stray"] is False and flags["good"] is True


def test_bounded_broadcast_probe(spark):
    small = spark.range(10).withColumn("s", F.lit("abc"))
    p = probe_size(small, max_rows=100)
    assert p.rows == 10 and p.bounded and p.bytes >= 10 * 3
    assert "broadcast" in bounded_broadcast(small, max_rows=100)._jdf.queryExecution().analyzed().toString().lower()
    big = spark.range(1000)
    assert probe_size(big, max_rows=100).bounded is False
    assert bounded_broadcast(big, max_rows=100) is big
    assert bounded_broadcast(small, max_rows=100, max_bytes=10) is small


# ----------------------------------------------------------------- D*


def test_duplicate_key_counts(spark, src):
    assert duplicate_key_count(src, ["shipment_id", "trans_dt"], ["shipment_id"]).first()["dup_count"] == 1
    assert duplicate_key_count(src.dropDuplicates(["shipment_id"]), ["shipment_id"]).first()["dup_count"] == 0
    extra = fx.source_df(spark, fx.SOURCE_ROWS + [fx.SOURCE_ROWS[5]])
    assert duplicate_key_count(extra, ["shipment_id"]).first()["dup_count"] == 2
    blanks = fx.source_df(spark, [("",) + fx.SOURCE_ROWS[0][1:]] * 2 + [(None,) + fx.SOURCE_ROWS[0][1:]] * 2)
    assert duplicate_keys(blanks, ["shipment_id"], present=["shipment_id"]).count() == 0
    assert duplicate_keys(blanks, ["shipment_id"]).count() == 2  # without the presence rule


def test_summary_groups(stg, dims):
    c, r = dims
    out = summary_rows(stg, c, r, fx.STAMP)
    rows = sorted(
        (x["carrier_id"], x["carrier_name"], x["route_id"], x["region_cd"], x["transit_mode"], x["service_level"],
         x["total_count"], x["approved_count"], x["rejected_count"], x["total_amount"], x["total_weight_kg"],
         x["approval_rate"], x["report_month"], x["report_date"])
        for x in out.collect()
    )
    assert rows == [
        ("balt", "Baltic Ro-Ro", "gulf", "EAST", "SEA", "BULK", 1, 0, 0, Decimal("55.00"), Decimal("2.00"),
         "0.00%", "2026-05", fx.DAY),
        ("balt", "Baltic Ro-Ro", "strait", "WEST", "SEA", "PRIORITY", 1, 0, 0, Decimal("310.00"), Decimal("7.00"),
         "0.00%", "2026-05", fx.DAY),
        ("nord", "Nordic Line", "gulf", "EAST", "SEA", "PRIORITY", 2, 2, 0, Decimal("1800.00"), Decimal("80.50"),
         "100.00%", "2026-05", fx.DAY),
    ]
    assert shape(out.schema) == shape(schemas.SHIPMENT_SUMMARY)


def test_summary_filters_and_rejections(spark, dims):
    c, r = dims
    base = list(fx.SOURCE_ROWS[0])
    rows = []
    for sid, rt, st, svc in [("A", "RAW", "CANCELLED", "EXPRESS"), ("B", "RAW", "RETURNED", "EXPRESS"),
                             ("C", "MANIFEST", "DELIVERED", "EXPRESS"), ("D", "OTHER", "DELIVERED", "EXPRESS"),
                             ("E", "RAW", "DELIVERED", "WAREHOUSE_TRANSFER")]:
        row = base.copy()
        row[0], row[6], row[7], row[8] = sid, rt, st, svc
        rows.append(tuple(row))
    out = summary_rows(fx.staging_from(fx.source_df(spark, rows)), c, r).first()
    assert (out["total_count"], out["approved_count"], out["rejected_count"], out["approval_rate"]) == (3, 1, 2, "33.33%")


def test_combined_count(spark):
    f = active_filter(fx.LOAD_DT)
    r = combined_count({"carrier": f.apply(fx.carrier_master_df(spark)), "route": f.apply(fx.route_master_df(spark))}).first()
    assert (r["carrier_cnt"], r["route_cnt"], r["active_cnt"]) == (2, 2, 4)


def test_rollup_and_error_counts(spark):
    s = fx.summary_df(spark)
    r = {x["report_month"]: x for x in rollup_counts(s, ["report_month"], ["total_count", "approved_count"]).collect()}
    assert r["2026-04"]["total_count"] == 14 and r["2026-04"]["approved_count"] == 11
    assert r["2026-04"]["total_count"].__class__ is int


def test_dedupe_is_deterministic(spark):
    sch = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("w", StringType())])
    rows = [(1, "a", "x"), (1, "b", "x"), (1, "b", "y"), (2, "a", None), (2, "a", "z")]
    out = sorted(tuple(r) for r in dedupe(spark.createDataFrame(rows, sch), ["k"]).collect())
    assert out == [(1, "b", "y"), (2, "a", "z")]
    rev = sorted(tuple(r) for r in dedupe(spark.createDataFrame(rows[::-1], sch), ["k"]).collect())
    assert rev == out


# ----------------------------------------------------------------- G2


def test_dq_rows_on_survivors(stg, dims):
    c, r = dims
    out = sorted((x["shipment_id"], x["error_code"]) for x in dq_errors(stg, c, r, fx.STAMP).collect())
    assert out == [("stray", "ERR_NO_DIM_CARRIER"), ("untracked", "ERR_NULL_MANDATORY")]


def test_dq_unfiltered_texts_and_equivalence(spark, src, dims):
    c, r = dims
    rows = list(fx.SOURCE_ROWS)
    two = list(fx.SOURCE_ROWS[6])  # negative value AND missing route AND NULL charge
    two[0], two[5], two[14] = "lost", "nowhere", None
    rows.append(tuple(two))
    stg = fx.staging_from(fx.source_df(spark, rows))
    one = dq_errors(stg, c, r, fx.STAMP)
    union = dq_errors(stg, c, r, fx.STAMP, one_pass=False)
    assert one.exceptAll(union).count() == 0 and union.exceptAll(one).count() == 0
    got = {(x["shipment_id"], x["error_code"]): x["error_description"] for x in one.collect()}
    assert got[("refund", "ERR_NEG_VALUE")] == "Negative monetary value declared_value=-4.50 shipping_charge=61.30"
    assert got[("stray", "ERR_NO_DIM_CARRIER")] == "Carrier id [ghost] not present in dim_carrier"
    assert got[("lost", "ERR_NO_DIM_ROUTE")] == "Route id [nowhere] not present in dim_route"
    assert got[("lost", "ERR_NEG_VALUE")] is None  # strict CONCAT: NULL amount -> NULL text (Q9)
    lenient = {(x["shipment_id"], x["error_code"]): x["error_description"]
               for x in dq_errors(stg, c, r, fx.STAMP, strict_text=False).collect()}
    assert lenient[("lost", "ERR_NEG_VALUE")].endswith("shipping_charge=NULL")
    assert shape(one.schema) == shape(schemas.SHIPMENT_DQ_ERRORS)
    counts = {x["error_code"]: x["error_cnt"] for x in error_counts(one).collect()}
    assert counts == {"ERR_NEG_VALUE": 2, "ERR_NO_DIM_ROUTE": 1, "ERR_NO_DIM_CARRIER": 1, "ERR_NULL_MANDATORY": 1}
