"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark code as plain SQL over the driver's views
(``lineitem``, ``orders``, ``customer``, ``supplier``, ``nation``, ``region``,
``events``).  Parity rules for DuckDB: integer sums are cast to BIGINT, decimal
sums to DECIMAL(18,2); percentages use exact integer basis points with HALF_UP;
``||`` is used where NULL must propagate; NULL ordering is always explicit.
"""

from __future__ import annotations

# Fixed parameters (same as cargomart.plans.queries).
LOAD_DT = "2026-05-10"
MIN_VALUE = "10000.00"
MONTH = "1996-12"

_VALIDITY = """
  CASE WHEN {inactive} AND {k} % 3 = 0 THEN 'I' ELSE 'A' END AS status,
  CASE WHEN {inactive} AND {k} % 3 = 0 THEN '2020-01-01'
       WHEN {inactive} AND {k} % 3 = 1 THEN '2099-01-01'
       WHEN {inactive} THEN '2018-01-01'
       WHEN {k} % 4 = 0 THEN '2024-06-01'
       WHEN {k} % 4 = 1 THEN '{load_dt}'
       WHEN {k} % 4 = 2 THEN '2025-01-01'
       ELSE '2019-03-15' END AS eff_dt,
  CASE WHEN {inactive} AND {k} % 3 = 0 THEN '2025-12-31'
       WHEN {inactive} AND {k} % 3 = 1 THEN NULL
       WHEN {inactive} THEN '2020-12-31'
       WHEN {k} % 5 = 1 THEN ''
       WHEN {k} % 5 = 2 THEN '{load_dt}'
       WHEN {k} % 5 = 3 THEN '2030-12-31'
       ELSE NULL END AS exp_dt"""

SRC = f"""
src AS (
  SELECT
    CASE WHEN l_partkey % 97 = 3 THEN ''
         ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS shipment_id,
    NULLIF(CAST(l_partkey % 50 AS VARCHAR), '7') AS tracking_number,
    'FAC' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS origin_facility_cd,
    'FAC' || lpad(CAST(l_partkey % 25 AS VARCHAR), 2, '0') AS destination_facility_cd,
    CASE WHEN l_partkey % 89 = 5 THEN '' WHEN l_partkey % 89 = 6 THEN NULL
         ELSE CAST(l_suppkey AS VARCHAR) END AS carrier_id,
    CAST(c_nationkey AS VARCHAR) AS route_id,
    CASE WHEN l_returnflag = 'N' THEN 'RAW' WHEN l_returnflag = 'A' THEN 'MANIFEST'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'TEST'
         WHEN l_returnflag = 'R' THEN 'INTERNAL' END AS record_type,
    CASE WHEN l_linenumber = 7 THEN 'CANCELLED' WHEN l_linenumber = 6 THEN 'RETURNED'
         WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'BOOKED'
         WHEN o_orderstatus = 'P' THEN 'IN_TRANSIT' END AS shipment_status_code,
    CASE WHEN l_linenumber = 5 THEN 'WAREHOUSE_TRANSFER' ELSE o_orderpriority END AS service_level,
    c_mktsegment AS booking_channel,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    NULLIF(CAST(l_quantity AS DECIMAL(10,2)), 1) AS weight_kg,
    CAST(CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(10,4)) / 100 AS DECIMAL(10,4)) AS volume_cbm,
    CAST(l_extendedprice AS DECIMAL(15,2)) AS declared_value,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2))
         * (CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)) + CAST(0.05 AS DECIMAL(3,2)))
         AS DECIMAL(15,2)) AS shipping_charge,
    strftime(o_orderdate, '%Y-%m-%d') AS pickup_dt,
    strftime(l_shipdate, '%Y-%m-%d') AS expected_delivery_dt,
    CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m-%d') ELSE '' END AS delivery_dt,
    'ORDERS' AS source_system_cd,
    strftime(l_shipdate, '%Y-%m-%d') AS trans_dt
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
)"""

EVENTS = """
ev AS (
  SELECT
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id,
    CAST(user_id AS VARCHAR) AS shipment_id,
    event_type AS event_type_cd,
    'FAC' || lpad(CAST(event_id % 25 AS VARCHAR), 2, '0') AS event_facility_cd,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts,
    strftime(ts, '%Y-%m-%d') AS event_dt
  FROM events
)"""

DAY_EVENTS = """
sev AS (
  SELECT
    lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
    event_type AS event_type_cd,
    'FAC' || lpad(CAST(event_id % 25 AS VARCHAR), 2, '0') AS event_facility_cd,
    strftime(l_shipdate, '%Y-%m-%d') || strftime(ts, ' %H:00:00') AS event_ts,
    strftime(l_shipdate, '%Y-%m-%d') AS event_dt
  FROM events JOIN lineitem ON user_id = l_orderkey
)"""

CARRIER_MASTER = f"""
carrier_master AS (
  SELECT
    CAST(s_suppkey AS VARCHAR) AS carrier_id,
    'CRR' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS carrier_code,
    s_name AS carrier_name,
    CASE WHEN s_suppkey % 2 = 0 THEN 'LTL' ELSE 'PARCEL' END AS carrier_type,
    'N' || CAST(s_nationkey AS VARCHAR) AS country_cd,
    'R' || CAST(s_nationkey % 5 AS VARCHAR) AS region_cd,
    CASE WHEN s_suppkey % 3 = 0 THEN 'GOLD' WHEN s_suppkey % 3 = 1 THEN 'SILVER' ELSE 'BRONZE' END AS service_tier,
    CAST(1000 + s_suppkey % 100 AS DECIMAL(10,2)) AS max_weight_kg,
    CAST(s_acctbal AS DECIMAL(15,2)) AS insurance_limit,
    {_VALIDITY.format(inactive="s_suppkey % 7 = 3", k="s_suppkey", load_dt=LOAD_DT)}
  FROM supplier
)"""

ROUTE_MASTER = f"""
route_master AS (
  SELECT
    CAST(n_nationkey AS VARCHAR) AS route_id,
    'RT' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS route_code,
    n_name AS route_name,
    'FAC' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS origin_facility_cd,
    'FAC' || lpad(CAST((n_nationkey + 7) % 25 AS VARCHAR), 2, '0') AS destination_facility_cd,
    CASE WHEN n_nationkey % 3 = 0 THEN 'AIR' WHEN n_nationkey % 3 = 1 THEN 'GROUND' ELSE 'SEA' END AS transit_mode,
    CAST((n_nationkey + 1) * 100 AS DECIMAL(10,2)) AS distance_km,
    CAST(n_nationkey % 7 + 1 AS BIGINT) AS standard_transit_days,
    CAST(n_nationkey + 50 AS DECIMAL(15,2)) AS base_cost,
    CAST(n_nationkey % 10 AS DECIMAL(5,2)) AS fuel_surcharge_pct,
    r_name AS region_cd,
    {_VALIDITY.format(inactive="n_nationkey % 8 = 5", k="n_nationkey", load_dt=LOAD_DT)}
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

ACTIVE = f"status = 'A' AND eff_dt <= '{LOAD_DT}' AND (exp_dt IS NULL OR exp_dt = '' OR exp_dt >= '{LOAD_DT}')"

DIMS = f"""
dim_carrier AS (SELECT * FROM carrier_master WHERE {ACTIVE}),
dim_route AS (SELECT * FROM route_master WHERE {ACTIVE})"""

INGEST_WHERE = f"""
  shipment_id IS NOT NULL AND shipment_id <> ''
  AND record_type <> 'TEST' AND record_type <> 'INTERNAL'
  AND shipment_status_code IN ('BOOKED','IN_TRANSIT','DELIVERED')
  AND declared_value >= {MIN_VALUE}
  AND carrier_id IS NOT NULL AND carrier_id <> ''"""

STG = f"""
latest_ev AS (
  SELECT shipment_id, event_dt, event_type_cd, event_facility_cd, event_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY shipment_id, event_dt
                                 ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST,
                                          event_type_cd DESC NULLS LAST, event_facility_cd DESC NULLS LAST) AS rn
    FROM sev) WHERE rn = 1
),
stg AS (
  SELECT s.shipment_id, s.tracking_number, s.origin_facility_cd, s.destination_facility_cd,
         s.carrier_id, s.route_id, s.record_type, s.shipment_status_code, s.service_level,
         s.booking_channel, s.customer_id, s.weight_kg, s.volume_cbm, s.declared_value,
         s.shipping_charge, s.pickup_dt, s.expected_delivery_dt, s.delivery_dt,
         e.event_type_cd AS last_event_type_cd, e.event_facility_cd AS last_event_facility_cd,
         e.event_ts AS last_event_ts, s.trans_dt
  FROM (SELECT * FROM src WHERE {INGEST_WHERE}) s
  LEFT JOIN latest_ev e ON s.shipment_id = e.shipment_id AND s.trans_dt = e.event_dt
)"""

DQ = """
dq AS (
  SELECT s.shipment_id, s.tracking_number, s.carrier_id, s.route_id,
         'ERR_NO_DIM_CARRIER' AS error_code,
         'Carrier id [' || COALESCE(s.carrier_id, '') || '] not present in dim_carrier' AS error_description,
         s.record_type, s.shipment_status_code, s.weight_kg, s.declared_value, s.shipping_charge, s.trans_dt
  FROM stg s LEFT JOIN dim_carrier dc ON s.carrier_id = dc.carrier_id
  WHERE dc.carrier_id IS NULL
  UNION ALL
  SELECT s.shipment_id, s.tracking_number, s.carrier_id, s.route_id,
         'ERR_NO_DIM_ROUTE',
         'Route id [' || COALESCE(s.route_id, '') || '] not present in dim_route',
         s.record_type, s.shipment_status_code, s.weight_kg, s.declared_value, s.shipping_charge, s.trans_dt
  FROM stg s LEFT JOIN dim_route dr ON s.route_id = dr.route_id
  WHERE dr.route_id IS NULL
  UNION ALL
  SELECT shipment_id, tracking_number, carrier_id, route_id,
         'ERR_NEG_VALUE',
         'Negative monetary value declared_value=' || CAST(declared_value AS VARCHAR)
           || ' shipping_charge=' || CAST(shipping_charge AS VARCHAR),
         record_type, shipment_status_code, weight_kg, declared_value, shipping_charge, trans_dt
  FROM stg WHERE declared_value < 0 OR shipping_charge < 0
  UNION ALL
  SELECT shipment_id, tracking_number, carrier_id, route_id,
         'ERR_NULL_MANDATORY',
         'One or more mandatory fields are NULL (tracking_number, origin/destination facility, weight_kg)',
         record_type, shipment_status_code, weight_kg, declared_value, shipping_charge, trans_dt
  FROM stg
  WHERE tracking_number IS NULL OR tracking_number = ''
     OR origin_facility_cd IS NULL OR origin_facility_cd = ''
     OR destination_facility_cd IS NULL OR destination_facility_cd = ''
     OR weight_kg IS NULL
)"""


def _pct(a: str, b: str) -> str:
    """'NN.NN%' from exact HALF_UP basis points of a/b (0.00% when b = 0)."""
    bp = f"CASE WHEN ({b}) = 0 THEN 0 ELSE (CAST({a} AS HUGEINT) * 20000 + ({b})) // (2 * ({b})) END"
    return f"(CAST(({bp}) // 100 AS VARCHAR) || '.' || lpad(CAST(({bp}) % 100 AS VARCHAR), 2, '0') || '%')"


def _summary_from(fact: str) -> str:
    return f"""
summ AS (
  SELECT s.trans_dt AS report_date, s.carrier_id, dc.carrier_name, s.route_id, dr.region_cd,
         dr.transit_mode, s.service_level,
         CAST(COUNT(*) AS BIGINT) AS total_count,
         CAST(SUM(CASE WHEN s.shipment_status_code = 'DELIVERED' THEN 1 ELSE 0 END) AS BIGINT) AS approved_count,
         CAST(SUM(CASE WHEN s.shipment_status_code IN ('CANCELLED','RETURNED') THEN 1 ELSE 0 END) AS BIGINT) AS rejected_count,
         CAST(SUM(COALESCE(s.declared_value, 0)) AS DECIMAL(18,2)) AS total_amount,
         CAST(SUM(COALESCE(s.weight_kg, 0)) AS DECIMAL(18,2)) AS total_weight_kg
  FROM {fact} s
  JOIN dim_carrier dc ON s.carrier_id = dc.carrier_id
  JOIN dim_route dr ON s.route_id = dr.route_id
  WHERE s.service_level <> 'WAREHOUSE_TRANSFER' AND s.record_type IN ('RAW','MANIFEST')
  GROUP BY ALL
),
summary AS (
  SELECT report_date, substr(report_date, 1, 7) AS report_month, carrier_id, carrier_name, route_id,
         region_cd, transit_mode, service_level, total_count, approved_count, rejected_count,
         total_amount, total_weight_kg, {_pct('approved_count', 'total_count')} AS approval_rate
  FROM summ
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_BASE = (SRC, DAY_EVENTS, CARRIER_MASTER, ROUTE_MASTER, DIMS, STG)
_EXPORT = ("report_date", "report_month", "carrier_id", "carrier_name", "route_id", "region_cd",
           "transit_mode", "service_level", "total_count", "approved_count", "rejected_count",
           "total_amount", "total_weight_kg", "approval_rate")
_STG_COLS = (
    "shipment_id, tracking_number, origin_facility_cd, destination_facility_cd, carrier_id, route_id, "
    "record_type, shipment_status_code, service_level, booking_channel, customer_id, weight_kg, volume_cbm, "
    "declared_value, shipping_charge, pickup_dt, expected_delivery_dt, delivery_dt, last_event_type_cd, "
    "last_event_facility_cd, last_event_ts, trans_dt"
)

ORACLE: dict[str, str] = {
    "ingest_filtered": _with(SRC) + f" SELECT * FROM src WHERE {INGEST_WHERE}",
    "ingest_staging": _with(*_BASE) + f" SELECT {_STG_COLS} FROM stg",
    "duplicate_keys": _with(SRC) + """
      SELECT shipment_id, trans_dt, CAST(COUNT(*) AS BIGINT) AS cnt FROM src
      WHERE shipment_id IS NOT NULL AND shipment_id <> ''
      GROUP BY shipment_id, trans_dt HAVING COUNT(*) > 1""",
    "duplicate_key_count": _with(SRC) + """
      SELECT CAST(COUNT(*) AS BIGINT) AS dup_count FROM (
        SELECT shipment_id FROM src WHERE shipment_id IS NOT NULL AND shipment_id <> ''
        GROUP BY shipment_id HAVING COUNT(*) > 1)""",
    "latest_event_per_key": _with(EVENTS) + """
      SELECT shipment_id, event_id, event_type_cd, event_facility_cd, event_ts, event_dt FROM (
        SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY event_ts DESC NULLS LAST,
                                     event_id DESC NULLS LAST) AS rn FROM ev) WHERE rn = 1""",
    "enrich_latest": _with(EVENTS) + """,
      latest AS (
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY event_ts DESC NULLS LAST,
                                       event_id DESC NULLS LAST) AS rn FROM ev) WHERE rn = 1)
      SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
             l.event_type_cd AS last_event_type_cd, l.event_facility_cd AS last_event_facility_cd,
             l.event_ts AS last_event_ts
      FROM orders LEFT JOIN latest l ON CAST(o_orderkey AS VARCHAR) = l.shipment_id""",
    "active_carriers": _with(*_BASE) + """
      SELECT carrier_id, carrier_code, carrier_name, carrier_type, country_cd, region_cd, service_tier,
             max_weight_kg, insurance_limit, status, eff_dt, exp_dt FROM dim_carrier""",
    "active_routes": _with(*_BASE) + """
      SELECT route_id, route_code, route_name, origin_facility_cd, destination_facility_cd, transit_mode,
             distance_km, standard_transit_days, base_cost, fuel_surcharge_pct, region_cd, status,
             eff_dt, exp_dt FROM dim_route""",
    "combined_active_count": _with(CARRIER_MASTER, ROUTE_MASTER) + f"""
      SELECT carrier_cnt, route_cnt, carrier_cnt + route_cnt AS active_cnt FROM (
        SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM carrier_master WHERE {ACTIVE}) AS carrier_cnt,
               (SELECT CAST(COUNT(*) AS BIGINT) FROM route_master WHERE {ACTIVE}) AS route_cnt)""",
    "orphans_carrier": _with(*_BASE) + """
      SELECT s.shipment_id, s.carrier_id, s.route_id, s.trans_dt
      FROM stg s LEFT JOIN dim_carrier dc ON s.carrier_id = dc.carrier_id WHERE dc.carrier_id IS NULL""",
    "orphans_route": _with(*_BASE) + """
      SELECT s.shipment_id, s.carrier_id, s.route_id, s.trans_dt
      FROM stg s LEFT JOIN dim_route dr ON s.route_id = dr.route_id WHERE dr.route_id IS NULL""",
    "rule_violations": _with(*_BASE, DQ) + " SELECT * FROM dq",
    "error_counts": _with(*_BASE, DQ) + """
      SELECT trans_dt, error_code, CAST(COUNT(*) AS BIGINT) AS error_cnt FROM dq GROUP BY ALL""",
    "daily_summary": _with(*_BASE, _summary_from("stg")) + " SELECT * FROM summary",
    "monthly_summary": _with(*_BASE, _summary_from("stg")) + f""",
      m AS (
        SELECT report_month, region_cd, transit_mode, service_level,
               CAST(SUM(total_count) AS BIGINT) AS total_count,
               CAST(SUM(approved_count) AS BIGINT) AS approved_count,
               CAST(SUM(rejected_count) AS BIGINT) AS rejected_count,
               CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_amount,
               CAST(SUM(total_weight_kg) AS DECIMAL(18,2)) AS total_weight_kg
        FROM summary GROUP BY ALL)
      SELECT *, {_pct('approved_count', 'total_count')} AS approval_rate FROM m""",
    "month_slice": _with(*_BASE) + f" SELECT {_STG_COLS} FROM stg WHERE trans_dt LIKE '{MONTH}-%'",
    "error_rate": _with(*_BASE, DQ) + """,
      c AS (SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM dq) AS err_cnt,
                   (SELECT CAST(COUNT(*) AS BIGINT) FROM stg) AS stg_cnt)
      SELECT err_cnt, stg_cnt,
             CAST(CASE WHEN stg_cnt = 0 THEN 0 ELSE err_cnt * 100 // stg_cnt END AS BIGINT) AS err_rate_pct,
             (CASE WHEN stg_cnt = 0 THEN 0 ELSE err_cnt * 100 // stg_cnt END) > 5 AS warn
      FROM c""",
    "error_rate_by_day": _with(*_BASE, DQ) + """,
      s AS (SELECT trans_dt, CAST(COUNT(*) AS BIGINT) AS stg_cnt FROM stg GROUP BY trans_dt),
      e AS (SELECT trans_dt, CAST(COUNT(*) AS BIGINT) AS err_cnt FROM dq GROUP BY trans_dt)
      SELECT s.trans_dt, COALESCE(e.err_cnt, 0) AS err_cnt, s.stg_cnt,
             CAST(COALESCE(e.err_cnt, 0) * 100 // s.stg_cnt AS BIGINT) AS err_rate_pct,
             COALESCE(e.err_cnt, 0) * 100 // s.stg_cnt > 5 AS warn
      FROM s LEFT JOIN e ON s.trans_dt = e.trans_dt""",
    "framed_export_lines": _with(*_BASE, _summary_from("stg")) + """
      SELECT report_month AS export_month, 0 AS line_tag, '""" + ",".join(_EXPORT) + """' AS line, 1 AS line_no
      FROM summary GROUP BY report_month
      UNION ALL
      SELECT report_month, 1, """ + " || ',' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _EXPORT) + """,
        CAST(1 + row_number() OVER (PARTITION BY report_month ORDER BY report_date, carrier_id, route_id, service_level) AS INTEGER)
      FROM summary
      UNION ALL
      SELECT report_month, 2, 'TRAILER,' || CAST(COUNT(*) AS VARCHAR), CAST(COUNT(*) + 2 AS INTEGER)
      FROM summary GROUP BY report_month""",
    "missing_days": _with(*_BASE, DQ) + """,
      bounds AS (SELECT MIN(CAST(trans_dt AS DATE)) AS lo, MAX(CAST(trans_dt AS DATE)) AS hi FROM src),
      cal AS (SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS trans_dt
              FROM bounds, generate_series(lo, hi, INTERVAL 1 DAY) AS g(d))
      SELECT trans_dt FROM cal WHERE trans_dt NOT IN (SELECT trans_dt FROM dq WHERE error_code = 'ERR_NULL_MANDATORY')""",
    "dedupe_latest": """
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
             l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                   l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
                   l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
        FROM lineitem) WHERE rn = 1""",
    "run_report": _with(*_BASE, DQ, _summary_from("stg")) + """
      SELECT 'ingest' AS step, 'src_shipments' AS label, CAST(COUNT(*) AS BIGINT) AS row_cnt FROM src
      UNION ALL SELECT 'ingest', 'stg_shipments', CAST(COUNT(*) AS BIGINT) FROM stg
      UNION ALL SELECT 'dim_refresh', 'dim_carrier', CAST(COUNT(*) AS BIGINT) FROM dim_carrier
      UNION ALL SELECT 'dim_refresh', 'dim_route', CAST(COUNT(*) AS BIGINT) FROM dim_route
      UNION ALL SELECT 'summary', 'shipment_dq_errors', CAST(COUNT(*) AS BIGINT) FROM dq
      UNION ALL SELECT 'summary', 'shipment_summary', CAST(COUNT(*) AS BIGINT) FROM summary""",
    "summary_unfiltered": _with(SRC, CARRIER_MASTER, ROUTE_MASTER, DIMS, _summary_from("src"))
    + " SELECT * FROM summary",
}

# Equivalent forms share their oracle.
ORACLE["latest_event_per_key_window"] = ORACLE["latest_event_per_key"]
ORACLE["orphans_carrier_left_join"] = ORACLE["orphans_carrier"]
ORACLE["orphans_carrier_by_keys"] = ORACLE["orphans_carrier"]
ORACLE["enrich_latest_bucketed"] = ORACLE["enrich_latest"]
ORACLE["duplicate_keys_hashed"] = ORACLE["duplicate_keys"]
ORACLE["summary_levels"] = _with(*_BASE, _summary_from("stg")) + """
  SELECT report_month, carrier_id, service_level, CAST(GROUPING_ID(report_month, carrier_id, service_level) AS INT) AS level_id,
         CAST(SUM(total_count) AS BIGINT) AS total_count, CAST(SUM(approved_count) AS BIGINT) AS approved_count,
         CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total_amount
  FROM summary
  GROUP BY GROUPING SETS ((report_month, carrier_id, service_level), (report_month, carrier_id), (report_month), ())"""

# ---- tables, files, gates and jobs (cargomart.plans.table_queries)

_SLIM = "shipment_id, carrier_id, record_type, declared_value, trans_dt, substr(trans_dt, 1, 4) AS ship_year"
_NIL = "shipment_id, tracking_number, origin_facility_cd, destination_facility_cd, carrier_id, route_id, record_type, " \
       "shipment_status_code, service_level, booking_channel, customer_id, source_system_cd, pickup_dt, " \
       "expected_delivery_dt, delivery_dt, trans_dt"
# Days that the duplicate gate refuses.
BAD_DAYS = "bad AS (SELECT DISTINCT trans_dt FROM src WHERE shipment_id <> '' GROUP BY trans_dt, shipment_id HAVING COUNT(*) > 1)"
_GOOD = "trans_dt NOT IN (SELECT trans_dt FROM bad)"

ORACLE |= {
    "partition_overwrite": _with(SRC) + f"""
      SELECT shipment_id, carrier_id, record_type, trans_dt, substr(trans_dt, 1, 4) AS ship_year,
             CASE WHEN substr(trans_dt, 1, 4) = '1995' THEN CAST(declared_value * 2 AS DECIMAL(15,2)) ELSE declared_value END AS declared_value
      FROM src WHERE substr(trans_dt, 1, 4) <> '1997'""",
    "partition_overwrite_two_level": _with(SRC) + f"""
      SELECT {_SLIM} FROM src
      WHERE record_type IS NOT NULL AND NOT (substr(trans_dt, 1, 4) = '1995' AND record_type = 'RAW' AND declared_value < 20000)""",
    "snapshot_restore": _with(*_BASE) + """
      SELECT 'changed' AS state, carrier_id, carrier_name, region_cd FROM dim_carrier WHERE region_cd = 'R1'
      UNION ALL SELECT 'restored', carrier_id, carrier_name, region_cd FROM dim_carrier
      UNION ALL SELECT 'restored', carrier_id, carrier_name, region_cd FROM dim_carrier WHERE region_cd = 'R2'""",
    "landing_round_trip": _with(SRC) + " SELECT " + ", ".join(
        c if c == "trans_dt" else f"NULLIF({c}, '') AS {c}" for c in _NIL.split(", ")
    ) + ", weight_kg, volume_cbm, declared_value, shipping_charge FROM src",
    "gate_reports": _with(*_BASE, DQ) + """
      SELECT 'rows' AS gate, 'src' AS label, CAST(COUNT(*) AS BIGINT) AS value FROM src
      UNION ALL SELECT 'duplicates', CAST(s.shipment_id AS VARCHAR) || '|' || s.trans_dt, CAST(COUNT(*) AS BIGINT)
        FROM src s WHERE shipment_id <> '' GROUP BY s.shipment_id, s.trans_dt HAVING COUNT(*) > 1
      UNION ALL SELECT 'error_rate', 'percent', (SELECT CAST(COUNT(*) AS BIGINT) FROM dq) * 100 // (SELECT COUNT(*) FROM stg)""",
    "job_ingest": _with(*_BASE, BAD_DAYS) + f" SELECT {_STG_COLS} FROM stg WHERE {_GOOD}",
    "job_refresh": _with(*_BASE) + """
      SELECT 'dim_carrier' AS dim, carrier_id AS id, status, eff_dt, exp_dt FROM dim_carrier
      UNION ALL SELECT 'dim_route', route_id, status, eff_dt, exp_dt FROM dim_route""",
    "job_gates": _with(SRC) + """
      , k AS (SELECT trans_dt, shipment_id, COUNT(*) AS n FROM src GROUP BY ALL)
      SELECT trans_dt, CAST(SUM(n) AS BIGINT) AS row_cnt, CAST(SUM(CASE WHEN n > 1 AND shipment_id <> '' THEN 1 ELSE 0 END) AS BIGINT) AS dup_cnt,
             CASE WHEN SUM(CASE WHEN n > 1 AND shipment_id <> '' THEN 1 ELSE 0 END) > 0 THEN 'DUPLICATES' ELSE 'OK' END AS gate
      FROM k GROUP BY trans_dt
      UNION ALL SELECT '2031-01-01', 0, 0, 'NO_ROWS'""",
    "job_export_outcomes": _with(*_BASE, _summary_from("stg"), BAD_DAYS) + """
      SELECT 'cargomart' AS job_name, '2026-05-10 02:00:00' AS run_dt, '1996-12' AS export_month,
             CAST(COUNT(*) AS BIGINT) AS record_cnt, 'SUCCESS' AS status, 0 AS error_chars, '' AS error
      FROM summary WHERE report_date LIKE '1996-12-%' AND report_date NOT IN (SELECT trans_dt FROM bad)
      UNION ALL SELECT 'cargomart', '2026-05-10 02:00:00', '1890-01', 0, 'FAILED', NULL, 'nothing to export'
      UNION ALL SELECT 'cargomart', '2026-05-10 02:00:00', '1996-12', 0, 'FAILED', 4000, '0 trailer line'""",
    "snapshot_checks": _with(SRC) + """
      , n AS (SELECT CAST(COUNT(*) AS BIGINT) AS c, CAST(SUM(CASE WHEN shipment_id = (SELECT MIN(shipment_id) FROM src WHERE shipment_id <> '')
                     THEN 1 ELSE 0 END) AS BIGINT) AS f FROM src)
      SELECT 'same' AS side, c AS left_cnt, c AS right_cnt, TRUE AS same_cnt, TRUE AS same_content FROM n
      UNION ALL SELECT 'ordered', c, c, TRUE, TRUE FROM n
      UNION ALL SELECT 'without_first', c, c - f, FALSE, FALSE FROM n
      UNION ALL SELECT 'changed', c, c, TRUE, FALSE FROM n""",
    "landing_rejects": _with(SRC) + """
      SELECT 'good' AS reason, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(weight_kg) AS DECIMAL(18,2)) AS weight FROM src
      WHERE tracking_number IS NULL OR tracking_number NOT IN ('11', '12', '13')
      UNION ALL SELECT CASE WHEN tracking_number = '11' THEN 'UNPARSABLE_VALUE' ELSE 'FIELD_COUNT' END, CAST(COUNT(*) AS BIGINT), NULL
      FROM src WHERE tracking_number IN ('11', '12', '13') GROUP BY 1""",
    "job_summary": _with(*_BASE, DQ, _summary_from("stg"), BAD_DAYS) + """
      SELECT report_date, 'summary' AS kind, carrier_id, route_id, service_level, total_count AS n, approval_rate AS shown
      FROM summary WHERE report_date NOT IN (SELECT trans_dt FROM bad)
      UNION ALL SELECT trans_dt, error_code, carrier_id, route_id, shipment_id, 1, error_description
      FROM dq WHERE trans_dt NOT IN (SELECT trans_dt FROM bad)""",
    "job_export": _with(*_BASE, _summary_from("stg"), BAD_DAYS) + """
      , s AS (SELECT * FROM summary WHERE report_date LIKE '1996-12-%' AND report_date NOT IN (SELECT trans_dt FROM bad))
      SELECT '""" + ",".join(_EXPORT) + """' AS line, 'SUCCESS' AS status, (SELECT CAST(COUNT(*) AS BIGINT) FROM s) AS record_cnt
      UNION ALL SELECT """ + " || ',' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _EXPORT) + """,
        'SUCCESS', (SELECT CAST(COUNT(*) AS BIGINT) FROM s) FROM s
      UNION ALL SELECT 'TRAILER,' || CAST(COUNT(*) AS VARCHAR), 'SUCCESS', CAST(COUNT(*) AS BIGINT) FROM s""",
}
