"""Independent SQL (DuckDB dialect) for the correctness oracle.

``with_shipments(body)`` prefixes a query with the ``shipments`` order view
written in plain SQL over the driver tables, so each oracle starts from the
same input as the Spark operator but shares no code with it.
"""

from __future__ import annotations

SHIPMENTS_SQL = """
li AS (
  SELECT l_orderkey, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey, count(*) AS n_lines,
         max(l_quantity) AS max_qty, max(l_extendedprice) AS max_price, max(l_discount) AS max_disc,
         max(l_tax) AS max_tax, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
shipments AS (
SELECT o.o_orderkey AS order_id, o.o_orderdate AS order_date, o.o_orderdate AS order_timestamp,
  concat(CAST(year(o.o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o.o_orderdate) AS VARCHAR)) AS quarter,
  dayname(o.o_orderdate) AS day_of_week,
  p.p_type AS product_category, p.p_brand AS formulation, o.o_orderpriority AS temperature_requirement,
  sn.n_name AS manufacturing_site, cn.n_name AS distribution_center, r.r_name AS market_region,
  c.c_mktsegment AS shipping_mode, s.s_name AS api_supplier,
  CASE WHEN p.p_type IN ('ECONOMY','PROMO') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cold_chain_required,
  CASE WHEN o.o_orderkey % 10 < 9 THEN 1 ELSE 0 END AS gmp_compliant,
  CASE WHEN o.o_orderkey % 4 < 3 THEN 1 ELSE 0 END AS fda_approved,
  CASE WHEN o.o_orderkey % 3 < 2 THEN 1 ELSE 0 END AS ema_approved,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS serialization_required,
  CASE WHEN o.o_orderkey % 8 < 7 THEN 1 ELSE 0 END AS track_trace_compliant,
  p.p_retailprice AS api_cost_per_kg, p.p_retailprice * li.max_tax AS excipient_cost_per_kg,
  p.p_retailprice / 100 AS packaging_cost_per_unit, li.max_price AS manufacturing_cost_per_batch,
  li.max_price * (1 + li.max_tax) AS total_cost_per_batch, o.o_totalprice AS realistic_total_cost,
  li.max_qty * 1000 AS batch_size_units, CAST(li.n_lines * 24 AS DOUBLE) AS batch_release_time_hours,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(p.p_size AS DOUBLE) END AS api_lead_time_days,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE li.max_qty END AS manufacturing_lead_time_days,
  CAST(datediff('day', o.o_orderdate, li.first_ship) AS DOUBLE) AS total_lead_time_days,
  CAST(p.p_size AS DOUBLE) AS planned_delivery_days,
  CAST(datediff('day', o.o_orderdate, li.last_ship) - 10 AS DOUBLE) AS actual_delivery_days,
  CASE WHEN datediff('day', o.o_orderdate, li.last_ship) > 110 THEN 1 ELSE 0 END AS will_be_delayed,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE li.max_qty END AS current_stock_days,
  CAST(p.p_size AS DOUBLE) AS safety_stock_days, CAST(li.n_lines * 5 AS DOUBLE) AS reorder_point_days,
  CAST(li.n_lines AS DOUBLE) AS average_daily_unit_sales,
  c.c_acctbal AS defect_rate_ppm, li.max_disc * 100 AS quality_risk_score,
  s.s_acctbal / 100 AS supplier_risk_score, li.max_tax * 10 AS stock_out_risk,
  s.s_acctbal AS supplier_historical_performance,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Low_Risk' WHEN o.o_orderstatus = 'O' THEN 'Medium_Risk'
       ELSE 'High_Risk' END AS supply_chain_disruption_risk,
  li.max_qty + li.n_lines AS optimal_stock_days,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = li.partkey
LEFT JOIN supplier s ON s.s_suppkey = li.suppkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = cn.n_regionkey),
train AS (SELECT * EXCLUDE (split) FROM shipments WHERE split = 'train'),
test AS (SELECT * EXCLUDE (split) FROM shipments WHERE split = 'test')"""


def with_shipments(body: str, ctes: str = "") -> str:
    """``WITH <shipments view>[, extra ctes] <body>``."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {SHIPMENTS_SQL}{extra}\n{body.strip()}"
