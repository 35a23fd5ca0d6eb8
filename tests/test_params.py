"""H9 / Q11 / Q21: run-parameter derivations."""

import pytest
from pyspark.sql import functions as F

from cargomart.operators.aggregates import missing_days
from cargomart.params import (
    RunParams,
    check_day,
    days_between,
    export_month_for,
    report_month_of,
    trans_dt_for,
)


def test_daily_dates():
    assert trans_dt_for("2026-05-15") == "2026-05-14"
    assert trans_dt_for("2026-03-01") == "2026-02-28"
    assert report_month_of("2026-05-14") == "2026-05"
    p = RunParams(run_dt="2026-06-01")
    assert (p.trans_dt, p.report_month, p.load_dt, p.export_month) == ("2026-05-31", "2026-05", "2026-06-01", "2026-05")


@pytest.mark.parametrize("run,month", [("2026-05-01", "2026-04"), ("2026-05-31", "2026-04"),
                                       ("2026-03-31", "2026-02"), ("2026-01-15", "2025-12")])
def test_export_month_truncates_first(run, month):
    assert export_month_for(run) == month


def test_bad_values_rejected():
    for bad in ("2026-5-1", "2026-02-30", "x'; --", None):
        with pytest.raises((ValueError, TypeError)):
            check_day(bad)


def test_missing_days(spark):
    days = days_between("2026-05-09", "2026-05-16")
    src = spark.createDataFrame([(d,) for d in days if d != "2026-05-12"], "trans_dt string")
    stg = src.where(~F.col("trans_dt").isin("2026-05-10", "2026-05-16"))
    assert sorted(r[0] for r in missing_days(src, stg).collect()) == ["2026-05-10", "2026-05-12", "2026-05-16"]
