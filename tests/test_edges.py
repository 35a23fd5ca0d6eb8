"""Edge cases of the smaller APIs: conform, FilterSet text predicates, DDL
validation, multi-part framed output order, run-stamp literal in jobs."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators import sinks
from cargomart.operators.filters import FilterSet
from cargomart.operators.gates import GateError, validate_framed_csv
from cargomart.schemas import conform, pad_to
from tests import fixtures as fx


def test_conform_orders_casts_and_rejects_missing(spark):
    df = spark.createDataFrame([("1", "2.555", "x")], "b string, a string, extra string")
    target = schemas._schema(("a", schemas.D(10, 2)), ("b", schemas.L), ("c", schemas.S))
    out = conform(df, target, {"c": "upper(extra)"})
    assert out.columns == ["a", "b", "c"] and tuple(out.first()) == (Decimal("2.56"), 1, "X")
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in target.fields]
    with pytest.raises(KeyError):
        conform(df, schemas._schema(("missing", schemas.S)))
    padded = pad_to(df, target)
    assert padded.first()["c"] is None


def test_filter_set_sql_text_and_columns(spark):
    fs = FilterSet.of("t", {"a": "declared_value >= 50", "b": F.col("record_type") == "RAW"})
    out = fs.apply(fx.source_df(spark))
    assert sorted(r[0] for r in out.select("shipment_id").collect()) == fx.SURVIVORS
    assert FilterSet("empty").apply(fx.source_df(spark)).count() == 10
    with pytest.raises(KeyError):
        fs.plus("a", "true")


def test_ddl_validation(spark):
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, "bad name; drop", schemas.DIM_CARRIER)
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, "tmp_wrong_partition_order", schemas.STG_SHIPMENTS, ["shipment_id"])


def test_multi_part_output_keeps_order(spark, tmp_dir):
    df = spark.range(5000).select(
        F.format_string("2026-04-%02d", (F.col("id") % 28 + 1).cast("int")).alias("report_date"),
        F.col("id").cast("string").alias("carrier_id"),
    )
    out = sinks.write_framed_csv(df.repartition(7), os.path.join(tmp_dir, "parts"), ["report_date", "carrier_id"],
                                 ["report_date", "carrier_id"], single_file=False)
    parts = sinks.part_files(spark, out)
    lines = []
    for p in parts:
        with open(p.replace("file:", "")) as fh:
            lines += fh.read().splitlines()
    body = [tuple(ln.split(",")) for ln in lines[1:-1]]
    assert lines[0] == "report_date,carrier_id" and lines[-1] == "TRAILER,5000"
    assert body == sorted(body) and len(body) == 5000
    assert validate_framed_csv(spark, out, ["report_date", "carrier_id"]).value == 5000


def test_validate_detects_misplaced_trailer(spark, tmp_dir):
    d = os.path.join(tmp_dir, "misplaced")
    os.makedirs(d)
    hdr = ",".join(schemas.EXPORT_COLUMNS)
    with open(os.path.join(d, "part-00000.txt"), "w") as fh:
        fh.write(f"{hdr}\nTRAILER,1\n")
    with open(os.path.join(d, "part-00001.txt"), "w") as fh:
        fh.write("a\n")
    with pytest.raises(GateError, match="trailer is not the last line of the last part"):
        validate_framed_csv(spark, d, schemas.EXPORT_COLUMNS)


def test_validate_detects_header_not_first(spark, tmp_dir):
    d = os.path.join(tmp_dir, "late_header")
    os.makedirs(d)
    hdr = ",".join(schemas.EXPORT_COLUMNS)
    with open(os.path.join(d, "part-00000.txt"), "w") as fh:
        fh.write(f"a\n{hdr}\nb\nTRAILER,2\n")
    with pytest.raises(GateError, match="header is not the first line"):
        validate_framed_csv(spark, d, schemas.EXPORT_COLUMNS)
