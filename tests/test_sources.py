"""A1/A2 landing TSV reader: header skipped, empty = NULL, no quoting, bad
decimals NULL, partition column kept as STRING."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.sources.delimited import read_delimited, write_delimited
from tests import fixtures as fx


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_read_partitioned_tsv(spark, tmp_dir):
    cols = [f.name for f in schemas.SRC_SHIPMENTS.fields[:-1]]
    row = ['"ship', "", " GDN ", "HEL", "nord", "gulf", "RAW", "DELIVERED", "BULK", "DESK", "c-1",
           "12.50", "", "2.555", "abc", "2026-05-10", "2026-05-15", "", "SYS"]
    _write(os.path.join(tmp_dir, "trans_dt=2026-05-14", "part-0.tsv"), ["\t".join(cols), "\t".join(row)])
    df = read_delimited(spark, tmp_dir, schemas.SRC_SHIPMENTS)
    r = df.first()
    assert df.count() == 1  # header skipped
    assert r["shipment_id"] == '"ship'  # a leading quote is data
    assert r["tracking_number"] is None and r["delivery_dt"] is None  # empty field -> NULL
    assert r["origin_facility_cd"] == " GDN "  # spaces kept
    assert r["weight_kg"] == Decimal("12.50") and r["volume_cbm"] is None
    assert r["declared_value"] == Decimal("2.56")  # rounded to the column scale
    assert r["shipping_charge"] is None  # bad decimal -> NULL
    assert r["trans_dt"] == "2026-05-14" and df.schema["trans_dt"].dataType.typeName() == "string"


def test_unpartitioned_master_round_trip(spark, tmp_dir):
    src = fx.carrier_master_df(spark)
    path = os.path.join(tmp_dir, "carrier_master")
    write_delimited(src.coalesce(1), path)
    first = sorted(f for f in os.listdir(path) if f.startswith("part-"))[0]
    with open(os.path.join(path, first)) as fh:
        assert fh.readline().rstrip("\n").split("\t")[:3] == ["carrier_id", "carrier_code", "carrier_name"]
    back = read_delimited(spark, path, schemas.SRC_CARRIER_MASTER)
    # '' and NULL are the same thing in the landing format
    norm = src.na.replace("", None)
    assert back.exceptAll(norm).count() == 0 and norm.exceptAll(back).count() == 0


def test_landing_table_feeds_ingest(spark, tmp_dir):
    import uuid

    from cargomart.params import RunParams
    from cargomart.plans import jobs
    from cargomart.sources.catalog import refresh_partitions
    from cargomart.sources.delimited import ensure_landing_table

    tag = uuid.uuid4().hex[:8]
    p = RunParams(run_dt="2026-05-15", landing_db=f"tl_{tag}", uc_db=f"tu_{tag}", dim_db=f"td_{tag}", run_stamp=fx.STAMP)
    spark.sql(f"CREATE DATABASE {p.landing_db}")
    t = jobs.create_targets(spark, p)
    loc = os.path.join(tmp_dir, "landing", "src_shipments")
    ensure_landing_table(spark, t.src_shipments, schemas.SRC_SHIPMENTS, loc, ["trans_dt"])
    ensure_landing_table(spark, t.src_shipment_events, schemas.SRC_SHIPMENT_EVENTS,
                         os.path.join(tmp_dir, "landing", "events"), ["event_dt"])
    # the upstream system drops one day of tab-delimited text with a header line
    day = fx.source_df(spark, fx.SOURCE_ROWS[:9]).drop("trans_dt")
    write_delimited(day.coalesce(1), os.path.join(loc, "trans_dt=2026-05-14"))
    refresh_partitions(spark, t.src_shipments)
    src = spark.table(t.src_shipments)
    assert src.where("trans_dt = '2026-05-14'").count() == 9
    assert src.where("shipment_id = 'untracked'").first()["tracking_number"] is None
    r = jobs.ingest_day(spark, p)
    assert (r["src_cnt"], r["stg_cnt"]) == (9, 4)


def test_only_a_newline_ends_a_line(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a.tsv"), ["k\tv", "1\tone\rtwo", "2\t", "3\tthree"])
    schema = schemas._schema(("k", schemas.S), ("v", schemas.S))
    rows = sorted(tuple(r) for r in read_delimited(spark, tmp_dir, schema).collect())
    assert rows == [("1", "one\rtwo"), ("2", None), ("3", "three")]


@pytest.mark.parametrize("cell", ["a\tb", "a\nb", "a\rb"])
def test_a_cell_that_breaks_the_format_fails_the_write(spark, tmp_dir, cell):
    df = spark.createDataFrame([("1", cell)], schemas._schema(("k", schemas.S), ("v", schemas.S)))
    with pytest.raises(Exception, match="separator or a line end"):
        write_delimited(df, os.path.join(tmp_dir, "x"))
    write_delimited(df.withColumn("v", F.lit('"a "')), os.path.join(tmp_dir, "y"))
    assert read_delimited(spark, os.path.join(tmp_dir, "y"), df.schema).first()["v"] == '"a "'
