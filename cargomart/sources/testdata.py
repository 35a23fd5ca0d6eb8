"""Adapter views: the driver's TPC-H-like tables playing the shipment roles.

| Role                | From                          |
|---------------------|-------------------------------|
| src_shipments       | lineitem ⋈ orders ⋈ customer  |
| src_shipment_events | events                        |
| src_carrier_master  | supplier                      |
| src_route_master    | nation ⋈ region               |

Every mapping is a pure column expression over whole tables, so the work of
each role grows with the input.  Status/validity dates of the masters are
derived from the key so that the active-as-of rule (B8) decides membership and
every boundary case (eff = load_dt, exp = load_dt, exp NULL or '') occurs.

Joins are ordered so the largest table (lineitem) is shuffled once: orders is
first joined to customer (broadcast only after a size probe), then the result
meets lineitem on the order key.  A day slice becomes a range predicate on the
raw ``l_shipdate`` column so it reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargomart import schemas
from cargomart.operators.joins import bounded_broadcast
from cargomart.params import check_day
from cargomart.schemas import conform

# Fixed values used by the adapters.
LOAD_DT = "2026-05-10"
RUN_STAMP = "2026-05-10 02:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's parquet table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _day_range(col: str, day: str) -> Column:
    start = _dt.date.fromisoformat(check_day(day))
    end = start + _dt.timedelta(days=1)
    return F.expr(
        f"{col} >= TIMESTAMP_NTZ'{start} 00:00:00' AND {col} < TIMESTAMP_NTZ'{end} 00:00:00'"
    )


# Column mappings as SQL expressions (each applied in one projection).
_DAY = "CAST(CAST({c} AS DATE) AS STRING)"
_SHIPMENT_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
_SHIPMENT_MAP = {
    # Blank ids and carriers (B6), a service level that the summary drops.
    "shipment_id": f"CASE WHEN l_partkey % 97 = 3 THEN '' ELSE {_SHIPMENT_ID} END",
    "tracking_number": "NULLIF(CAST(l_partkey % 50 AS STRING), '7')",
    "origin_facility_cd": "'FAC' || lpad(CAST(c_nationkey AS STRING), 2, '0')",
    "destination_facility_cd": "'FAC' || lpad(CAST(l_partkey % 25 AS STRING), 2, '0')",
    "carrier_id": "CASE WHEN l_partkey % 89 = 5 THEN '' WHEN l_partkey % 89 = 6 THEN NULL ELSE CAST(l_suppkey AS STRING) END",
    "route_id": "CAST(c_nationkey AS STRING)",
    "record_type": """CASE WHEN l_returnflag = 'N' THEN 'RAW' WHEN l_returnflag = 'A' THEN 'MANIFEST'
                           WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'TEST'
                           WHEN l_returnflag = 'R' THEN 'INTERNAL' END""",
    "shipment_status_code": """CASE WHEN l_linenumber = 7 THEN 'CANCELLED' WHEN l_linenumber = 6 THEN 'RETURNED'
                                    WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'BOOKED'
                                    WHEN o_orderstatus = 'P' THEN 'IN_TRANSIT' END""",
    "service_level": "CASE WHEN l_linenumber = 5 THEN 'WAREHOUSE_TRANSFER' ELSE o_orderpriority END",
    "booking_channel": "c_mktsegment",
    "customer_id": "CAST(o_custkey AS STRING)",
    "weight_kg": "NULLIF(CAST(l_quantity AS DECIMAL(10,2)), 1.00BD)",
    "volume_cbm": "CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(10,4)) / 100",
    "declared_value": "CAST(l_extendedprice AS DECIMAL(15,2))",
    "shipping_charge": """CAST(l_extendedprice AS DECIMAL(15,2))
                          * (CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)) + 0.05BD)""",
    "pickup_dt": _DAY.format(c="o_orderdate"),
    "expected_delivery_dt": _DAY.format(c="l_shipdate"),
    "delivery_dt": f"CASE WHEN l_linestatus = 'F' THEN {_DAY.format(c='l_shipdate')} ELSE '' END",
    "source_system_cd": "'ORDERS'",
    "trans_dt": _DAY.format(c="l_shipdate"),
}

_EVENT_MAP = {
    "event_id": "lpad(CAST(event_id AS STRING), 12, '0')",
    "shipment_id": "CAST(user_id AS STRING)",
    "event_type_cd": "event_type",
    "event_facility_cd": "'FAC' || lpad(CAST(event_id % 25 AS STRING), 2, '0')",
    "event_ts": "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
    "event_status": "'RECORDED'",
    "exception_flag": "CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END",
    "scanner_user_id": "NULL",
    "carrier_id": "NULL",
    "comments": "props",
    "source_system_cd": "'EVENTS'",
    "event_dt": _DAY.format(c="ts"),
}


def _validity(k: str, inactive: str) -> dict[str, str]:
    """status / eff_dt / exp_dt such that B8 (as of LOAD_DT) is false exactly
    when ``inactive``; inactive rows fail for one of three reasons (status,
    future start, past end); active rows cover the boundaries eff = load_dt,
    exp = load_dt and exp NULL or ''."""
    return {
        "status": f"CASE WHEN ({inactive}) AND {k} % 3 = 0 THEN 'I' ELSE 'A' END",
        "eff_dt": f"""CASE WHEN ({inactive}) AND {k} % 3 = 0 THEN '2020-01-01'
                           WHEN ({inactive}) AND {k} % 3 = 1 THEN '2099-01-01'
                           WHEN ({inactive}) THEN '2018-01-01'
                           WHEN {k} % 4 = 0 THEN '2024-06-01'
                           WHEN {k} % 4 = 1 THEN '{LOAD_DT}'
                           WHEN {k} % 4 = 2 THEN '2025-01-01'
                           ELSE '2019-03-15' END""",
        "exp_dt": f"""CASE WHEN ({inactive}) AND {k} % 3 = 0 THEN '2025-12-31'
                           WHEN ({inactive}) AND {k} % 3 = 1 THEN NULL
                           WHEN ({inactive}) THEN '2020-12-31'
                           WHEN {k} % 5 = 1 THEN ''
                           WHEN {k} % 5 = 2 THEN '{LOAD_DT}'
                           WHEN {k} % 5 = 3 THEN '2030-12-31'
                           ELSE NULL END""",
    }


_CARRIER_MAP = {
    "carrier_id": "CAST(s_suppkey AS STRING)",
    "carrier_code": "'CRR' || lpad(CAST(s_suppkey AS STRING), 5, '0')",
    "carrier_name": "s_name",
    "carrier_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'LTL' ELSE 'PARCEL' END",
    "country_cd": "'N' || CAST(s_nationkey AS STRING)",
    "region_cd": "'R' || CAST(s_nationkey % 5 AS STRING)",
    "service_tier": "CASE WHEN s_suppkey % 3 = 0 THEN 'GOLD' WHEN s_suppkey % 3 = 1 THEN 'SILVER' ELSE 'BRONZE' END",
    "contract_number": "'K' || lpad(CAST(s_suppkey AS STRING), 6, '0')",
    "contact_phone": "NULL",
    "contact_email": "NULL",
    "max_weight_kg": "1000 + s_suppkey % 100",
    "insurance_limit": "s_acctbal",
    **_validity("s_suppkey", "s_suppkey % 7 = 3"),
}

_ROUTE_MAP = {
    "route_id": "CAST(n_nationkey AS STRING)",
    "route_code": "'RT' || lpad(CAST(n_nationkey AS STRING), 3, '0')",
    "route_name": "n_name",
    "origin_facility_cd": "'FAC' || lpad(CAST(n_nationkey AS STRING), 2, '0')",
    "destination_facility_cd": "'FAC' || lpad(CAST((n_nationkey + 7) % 25 AS STRING), 2, '0')",
    "transit_mode": "CASE WHEN n_nationkey % 3 = 0 THEN 'AIR' WHEN n_nationkey % 3 = 1 THEN 'GROUND' ELSE 'SEA' END",
    "distance_km": "(n_nationkey + 1) * 100",
    "standard_transit_days": "n_nationkey % 7 + 1",
    "base_cost": "n_nationkey + 50",
    "fuel_surcharge_pct": "n_nationkey % 10",
    "hazmat_allowed_flag": "CASE WHEN n_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END",
    "region_cd": "r_name",
    **_validity("n_nationkey", "n_nationkey % 8 = 5"),
}


def src_shipments(
    spark: SparkSession, sf_dir: str, trans_dt: str | None = None, days: tuple[str, str] | None = None,
    part: tuple[int, int] | None = None,
) -> DataFrame:
    """All shipments, those of one day, or those from a day to before another.
    ``part``: only those whose order falls into slice k of n."""
    li = lines_between(spark, sf_dir, days)
    if trans_dt is not None:
        li = li.where(_day_range("l_shipdate", trans_dt))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    if part is not None:
        k, n = part
        within = lambda key: F.pmod(F.xxhash64(key.cast("long")), F.lit(n)) == k
        li, orders = li.where(within(li["l_orderkey"])), orders.where(within(orders["o_orderkey"]))
    cust = bounded_broadcast(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    )
    oc = orders.join(cust, orders["o_custkey"] == cust["c_custkey"], "inner")
    j = li.join(oc, li["l_orderkey"] == oc["o_orderkey"], "inner")
    return conform(j, schemas.SRC_SHIPMENTS, _SHIPMENT_MAP)


def src_shipment_events(spark: SparkSession, sf_dir: str, event_dt: str | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if event_dt is not None:
        ev = ev.where(_day_range("ts", event_dt))
    return conform(ev, schemas.SRC_SHIPMENT_EVENTS, _EVENT_MAP)


def shipment_day_events(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Events of shipments on their own day: each event is one of all lines of
    the order that its user id names.  The time is cut to the hour, so that
    many shipments have several events at their latest time."""
    li = lines_between(spark, sf_dir, days).select("l_orderkey", "l_linenumber", "l_shipdate")
    ev = table(spark, sf_dir, "events")
    both = ev.join(li, ev["user_id"] == li["l_orderkey"])
    day = _DAY.format(c="l_shipdate")
    return conform(both, schemas.SRC_SHIPMENT_EVENTS, {
        **_EVENT_MAP, "shipment_id": _SHIPMENT_ID, "event_dt": day, "event_ts": f"{day} || date_format(ts, ' HH:00:00')",
    })


def lines_between(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None) -> DataFrame:
    """Order lines shipped from the first day to before the second one."""
    li = table(spark, sf_dir, "lineitem")
    if days is None:
        return li
    first, end = (f"TIMESTAMP_NTZ'{check_day(x)} 00:00:00'" for x in days)
    return li.where(f"l_shipdate >= {first} AND l_shipdate < {end}")


def src_carrier_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "supplier"), schemas.SRC_CARRIER_MASTER, _CARRIER_MAP)


def src_route_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = bounded_broadcast(table(spark, sf_dir, "region"))
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner")
    return conform(j, schemas.SRC_ROUTE_MASTER, _ROUTE_MAP)
