"""Table schemas (B1, B2) and ``conform`` — project a DataFrame onto a target layout.

All dates and run stamps are STRING, as in the landing and warehouse DDL; the
only TIMESTAMP is ``export_log.load_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import (
    DataType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()
L = LongType()
T = TimestampType()


def D(p: int, s: int) -> DecimalType:  # noqa: N802 - short type constructor
    return DecimalType(p, s)


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SRC_SHIPMENTS = _schema(
    ("shipment_id", S), ("tracking_number", S), ("origin_facility_cd", S),
    ("destination_facility_cd", S), ("carrier_id", S), ("route_id", S),
    ("record_type", S), ("shipment_status_code", S), ("service_level", S),
    ("booking_channel", S), ("customer_id", S), ("weight_kg", D(10, 2)),
    ("volume_cbm", D(10, 4)), ("declared_value", D(15, 2)), ("shipping_charge", D(15, 2)),
    ("pickup_dt", S), ("expected_delivery_dt", S), ("delivery_dt", S),
    ("source_system_cd", S), ("trans_dt", S),
)

SRC_SHIPMENT_EVENTS = _schema(
    ("event_id", S), ("shipment_id", S), ("event_type_cd", S), ("event_facility_cd", S),
    ("event_ts", S), ("event_status", S), ("exception_flag", S), ("scanner_user_id", S),
    ("carrier_id", S), ("comments", S), ("source_system_cd", S), ("event_dt", S),
)

SRC_CARRIER_MASTER = _schema(
    ("carrier_id", S), ("carrier_code", S), ("carrier_name", S), ("carrier_type", S),
    ("country_cd", S), ("region_cd", S), ("service_tier", S), ("contract_number", S),
    ("contact_phone", S), ("contact_email", S), ("max_weight_kg", D(10, 2)),
    ("insurance_limit", D(15, 2)), ("status", S), ("eff_dt", S), ("exp_dt", S),
)

SRC_ROUTE_MASTER = _schema(
    ("route_id", S), ("route_code", S), ("route_name", S), ("origin_facility_cd", S),
    ("destination_facility_cd", S), ("transit_mode", S), ("distance_km", D(10, 2)),
    ("standard_transit_days", L), ("base_cost", D(15, 2)), ("fuel_surcharge_pct", D(5, 2)),
    ("hazmat_allowed_flag", S), ("region_cd", S), ("status", S), ("eff_dt", S), ("exp_dt", S),
)

STG_SHIPMENTS = _schema(
    *[(f.name, f.dataType) for f in SRC_SHIPMENTS.fields[:18]],
    ("last_event_type_cd", S), ("last_event_facility_cd", S), ("last_event_ts", S),
    ("load_timestamp", S), ("trans_dt", S),
)

# B2: contract/contact columns are dropped on the way into the carrier dimension.
DIM_CARRIER = _schema(
    ("carrier_id", S), ("carrier_code", S), ("carrier_name", S), ("carrier_type", S),
    ("country_cd", S), ("region_cd", S), ("service_tier", S), ("max_weight_kg", D(10, 2)),
    ("insurance_limit", D(15, 2)), ("status", S), ("eff_dt", S), ("exp_dt", S),
    ("load_timestamp", S),
)

# B2: hazmat flag is dropped on the way into the route dimension.
DIM_ROUTE = _schema(
    ("route_id", S), ("route_code", S), ("route_name", S), ("origin_facility_cd", S),
    ("destination_facility_cd", S), ("transit_mode", S), ("distance_km", D(10, 2)),
    ("standard_transit_days", L), ("base_cost", D(15, 2)), ("fuel_surcharge_pct", D(5, 2)),
    ("region_cd", S), ("status", S), ("eff_dt", S), ("exp_dt", S), ("load_timestamp", S),
)

# Partitioned by (report_month, report_date): one run replaces one day (Q1).
SHIPMENT_SUMMARY = _schema(
    ("carrier_id", S), ("carrier_name", S), ("route_id", S), ("region_cd", S),
    ("transit_mode", S), ("service_level", S), ("total_count", L), ("approved_count", L),
    ("rejected_count", L), ("total_amount", D(18, 2)), ("total_weight_kg", D(18, 2)),
    ("approval_rate", S), ("load_timestamp", S), ("report_month", S), ("report_date", S),
)

SHIPMENT_DQ_ERRORS = _schema(
    ("shipment_id", S), ("tracking_number", S), ("carrier_id", S), ("route_id", S),
    ("error_code", S), ("error_description", S), ("record_type", S),
    ("shipment_status_code", S), ("weight_kg", D(10, 2)), ("declared_value", D(15, 2)),
    ("shipping_charge", D(15, 2)), ("load_timestamp", S), ("trans_dt", S),
)

EXPORT_LOG = _schema(
    ("job_name", S), ("run_dt", S), ("export_month", S), ("export_file", S),
    ("record_cnt", L), ("status", S), ("error_message", S), ("load_timestamp", T),
)

# The export file's column order, as consumed by partners.
EXPORT_COLUMNS = [
    "report_date", "report_month", "carrier_id", "carrier_name", "route_id",
    "region_cd", "transit_mode", "service_level", "total_count", "approved_count",
    "rejected_count", "total_amount", "total_weight_kg", "approval_rate",
]

PARTITIONS = {
    "stg_shipments": ["trans_dt"],
    "shipment_dq_errors": ["trans_dt"],
    "shipment_summary": ["report_month", "report_date"],
    "src_shipments": ["trans_dt"],
    "src_shipment_events": ["event_dt"],
}


def _sql_type(t: DataType) -> str:
    return t.simpleString()


def conform(df: DataFrame, schema: StructType, exprs: dict[str, Column | str] | None = None) -> DataFrame:
    """B1: select exactly ``schema``'s columns, in order, cast to its types.

    ``exprs`` supplies the target columns that are computed or renamed, as a
    Column or as SQL expression text; every other target column is taken by
    name from ``df``.  A target column that is neither in ``exprs`` nor in
    ``df`` is an error, not a silent NULL.  The projection is built in one
    call (Catalyst drops casts to the type a column already has).
    """
    exprs = dict(exprs or {})
    cols = {k: v for k, v in exprs.items() if isinstance(v, Column)}
    if cols:
        df = df.withColumns(cols)
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if isinstance(exprs.get(f.name), str):
            src = f"({exprs[f.name]})"
        elif f.name in have:
            src = f"`{f.name}`"
        else:
            raise KeyError(f"conform: no source for target column {f.name!r}")
        out.append(f"CAST({src} AS {_sql_type(f.dataType)}) AS `{f.name}`")
    return df.selectExpr(*out)


def pad_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Like ``conform`` but fills columns the input lacks with typed NULLs."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"CAST({'`' + f.name + '`' if f.name in have else 'NULL'} AS {_sql_type(f.dataType)}) AS `{f.name}`"
        for f in schema.fields
    ])
