"""Hand-made rows.  One good shipment is the base; each other row changes what
one rule looks at, and is named after it.  FIXTURES.md lists the rules."""

from __future__ import annotations

from decimal import Decimal as Dec

from cargomart import schemas
from cargomart.schemas import pad_to

DAY = "2026-05-14"
LOAD_DT = "2026-05-10"
STAMP = "2026-05-10 02:00:00"

BASE = {
    "shipment_id": "good", "tracking_number": "t-good", "origin_facility_cd": "GDN", "destination_facility_cd": "HEL",
    "carrier_id": "nord", "route_id": "gulf", "record_type": "RAW", "shipment_status_code": "DELIVERED",
    "service_level": "PRIORITY", "booking_channel": "DESK", "customer_id": "c-7", "weight_kg": Dec("40.25"),
    "volume_cbm": None, "declared_value": Dec("900.00"), "shipping_charge": Dec("61.30"), "pickup_dt": "2026-05-11",
    "expected_delivery_dt": "2026-05-16", "delivery_dt": "2026-05-14", "source_system_cd": "YARD", "trans_dt": DAY,
}


def shipment(name: str, **changes) -> tuple:
    row = BASE | {"shipment_id": name, "tracking_number": f"t-{name}"} | changes
    return tuple(row[f.name] for f in schemas.SRC_SHIPMENTS.fields)


SOURCE_ROWS = [
    shipment("good"),
    shipment("probe", record_type="TEST"),
    shipment("inhouse", record_type="INTERNAL", shipment_status_code="BOOKED"),
    shipment("dropped", shipment_status_code="CANCELLED", declared_value=Dec("41.00"), delivery_dt=""),
    shipment("cheap", declared_value=Dec("9.99")),
    shipment("sailing", shipment_status_code="IN_TRANSIT", carrier_id="balt", route_id="strait",
             declared_value=Dec("310.00"), weight_kg=Dec("7.00"), delivery_dt=""),
    shipment("refund", declared_value=Dec("-4.50")),
    shipment("untracked", tracking_number=None, shipment_status_code="BOOKED", carrier_id="balt", service_level="BULK",
             declared_value=Dec("55.00"), weight_kg=Dec("2.00")),
    shipment("stray", carrier_id="ghost"),
]
SOURCE_ROWS.append(SOURCE_ROWS[0])  # an exact repeat
#: What the ingest filters keep, and what is active on LOAD_DT.
SURVIVORS = ["good", "good", "sailing", "stray", "untracked"]


def _dated(fields, base: dict, cases: dict[str, tuple]) -> list[tuple]:
    rows = [base | dict(zip(("id", "name", "region_cd", "status", "eff_dt", "exp_dt"), (key, *rest))) for key, rest in cases.items()]
    return [tuple(r["id"] if n in ("carrier_id", "route_id") else r["name"] if n in ("carrier_name", "route_name") else r[n] for n in fields) for r in rows]


# Active without an end, active with a blank end, switched off, not begun, over.
CARRIER_MASTER_ROWS = _dated(
    [f.name for f in schemas.SRC_CARRIER_MASTER.fields],
    {"carrier_code": "x", "carrier_type": "FERRY", "country_cd": "FI", "service_tier": "ONE", "contract_number": None,
     "contact_phone": None, "contact_email": None, "max_weight_kg": Dec("750.00"), "insurance_limit": Dec("12000.00")},
    {
        "nord": ("Nordic Line", "NORTH", "A", "2023-03-01", None),
        "balt": ("Baltic Ro-Ro", "NORTH", "A", "2022-11-15", ""),
        "idle": ("Idle Ferries", "SOUTH", "I", "2019-02-01", "2027-01-01"),
        "soon": ("Soon Shipping", "SOUTH", "A", "2031-01-01", None),
        "past": ("Past Lines", "SOUTH", "A", "2011-05-05", "2016-05-05"),
    },
)
ROUTE_MASTER_ROWS = _dated(
    [f.name for f in schemas.SRC_ROUTE_MASTER.fields],
    {"route_code": "x", "origin_facility_cd": "GDN", "destination_facility_cd": "HEL", "transit_mode": "SEA",
     "distance_km": Dec("880.00"), "standard_transit_days": 2, "base_cost": Dec("33.00"), "fuel_surcharge_pct": Dec("2.25"),
     "hazmat_allowed_flag": "N"},
    {
        "gulf": ("Across the gulf", "EAST", "A", "2021-04-01", None),
        "strait": ("Through the strait", "WEST", "A", "2021-04-01", ""),
        "canal": ("Old canal", "WEST", "I", "2015-01-01", "2028-01-01"),
        "ice": ("Ice road", "EAST", "A", "2030-12-01", None),
        "bridge": ("Before the bridge", "WEST", "A", "2001-01-01", "2009-01-01"),
    },
)


def _month_row(date, carrier, n, ok, amount, service="PRIORITY"):
    name = "Nordic Line" if carrier == "nord" else "Baltic Ro-Ro"
    rate = f"{100 * ok / n:.2f}%"
    return (carrier, name, "gulf", "EAST", "SEA", service, n, ok, n - ok, Dec(amount), Dec("3.50") * n, rate, STAMP, date[:7], date)


SUMMARY_ROWS = [
    _month_row("2026-04-03", "nord", 8, 6, "7200.00"),
    _month_row("2026-04-11", "balt", 4, 4, "220.00", "BULK"),
    _month_row("2026-04-29", None, 2, 1, "96.10"),
    _month_row("2026-05-02", "nord", 3, 2, "2700.00"),
]


def export_lines(month: str) -> list[str]:
    """The framed export of SUMMARY_ROWS' month, by day."""
    names = [f.name for f in schemas.SHIPMENT_SUMMARY.fields]
    rows = [dict(zip(names, r)) for r in SUMMARY_ROWS if r[-1].startswith(month)]
    body = [",".join("" if r[c] is None else str(r[c]) for c in schemas.EXPORT_COLUMNS) for r in sorted(rows, key=lambda r: r["report_date"])]
    return [",".join(schemas.EXPORT_COLUMNS), *body, f"TRAILER,{len(body)}"]


def source_df(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else SOURCE_ROWS, schemas.SRC_SHIPMENTS)


def carrier_master_df(spark):
    return spark.createDataFrame(CARRIER_MASTER_ROWS, schemas.SRC_CARRIER_MASTER)


def route_master_df(spark):
    return spark.createDataFrame(ROUTE_MASTER_ROWS, schemas.SRC_ROUTE_MASTER)


def summary_df(spark):
    return spark.createDataFrame(SUMMARY_ROWS, schemas.SHIPMENT_SUMMARY)


def staging_from(df):
    """Source rows in the staging layout (no events)."""
    return pad_to(df, schemas.STG_SHIPMENTS)


EVENT_SCHEMA = schemas.SRC_SHIPMENT_EVENTS


def event(eid, sid, ts, etype="SCAN", fac="Q1", day=DAY):
    return (eid, sid, etype, fac, ts, "OK", "N", None, None, None, "YARD", day)
