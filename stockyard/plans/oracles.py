"""Reference answers as DuckDB SQL over the same Parquet tables.

The common tables below restate bronze, facts and marts in plain SQL; ``query`` puts those a text names, and those
they name in turn, in front of it.
"""

from __future__ import annotations

import re

from stockyard.functions.fixed import STATES, WMO_LABELS
from stockyard.operators.quality import MIN_ROWS, NEVER_NULL, TESTS


def r(x: str, digits: int) -> str:
    """Half-up rounding on decimal digits."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(15,2))) AS DOUBLE)"


def mean(x: str, digits: int) -> str:
    return r(f"CAST(SUM(CAST({x} AS DECIMAL(28,10))) AS DOUBLE) / COUNT({x})", digits)


UFS = "[" + ", ".join(f"'{s[0]}'" for s in STATES) + "]"
UF_CODES = "[" + ", ".join(f"'{s[6]}'" for s in STATES) + "]"
CODES = [*WMO_LABELS, 100]
LABELS = "CASE weather_code " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in WMO_LABELS.items()) + (
    " ELSE 'Código ' || weather_code END"
)
SECONDS = "date_diff('second', issued_at, delivered_at)"

COMMON = {
    "fct_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '1' AS doc_seq, CAST(o_orderkey AS VARCHAR) AS document_number,
               '1' AS document_series, o_orderpriority AS document_type, CAST(c_nationkey AS VARCHAR) AS company_id,
               CAST(o_custkey AS VARCHAR) AS depositor_id, o_orderdate AS issued_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_hours(CAST(o_orderkey % 97 AS INTEGER)) END
                 AS delivered_at,
               o_totalprice AS total_value
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "outbound": """
        SELECT l_orderkey || '-' || l_linenumber AS movement_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS warehouse_id, CAST(o_custkey AS VARCHAR) AS depositor_id,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS qty_before,
               CASE WHEN l_linestatus = 'F' THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS qty_after,
               CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END * CAST(l_quantity AS INTEGER) AS qty_delta,
               l_shipdate AS movement_date, CASE WHEN l_linestatus = 'F' THEN '8' ELSE '1' END AS movement_status,
               CAST(NULL AS VARCHAR) AS operator_user, l_returnflag AS notes
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fct_movements": """
        SELECT CAST(event_id AS VARCHAR) AS movement_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS product_id,
               CAST(user_id % 7 AS VARCHAR) AS warehouse_id, CAST(NULL AS VARCHAR) AS depositor_id,
               CASE WHEN event_type IN ('purchase', 'click', 'error') THEN CAST(ceil(value) AS INTEGER) ELSE 0 END
                 AS qty_before,
               CASE WHEN event_type IN ('purchase', 'click', 'error') THEN 0 ELSE CAST(ceil(value) AS INTEGER) END
                 AS qty_after,
               CASE WHEN event_type IN ('purchase', 'click', 'error') THEN -1 ELSE 1 END * CAST(ceil(value) AS INTEGER)
                 AS qty_delta,
               ts AS movement_date, '1' AS movement_status, CAST(user_id AS VARCHAR) AS operator_user,
               event_type AS notes
        FROM events""",
    "part_stock": """
        SELECT l_partkey, l_suppkey, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS ideal,
               MIN(l_quantity) AS least, COUNT(*) AS n, MAX(l_shipdate) AS loaded
        FROM lineitem GROUP BY 1, 2""",
    "fct_inventory_snapshot": """
        SELECT l_partkey || '-' || l_suppkey AS inventory_id, CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_suppkey AS VARCHAR) AS warehouse_id, CAST(l_suppkey % 5 AS VARCHAR) AS company_id,
               CAST(ideal AS INTEGER) AS ideal_stock_qty, CAST(least AS INTEGER) AS min_stock_qty,
               CAST(ideal * 2 AS INTEGER) AS max_stock_qty,
               CAST(floor(ideal * CAST(0.15 AS DOUBLE)) AS INTEGER) AS safety_stock_qty,
               CAST(floor(ideal * CAST(0.25 AS DOUBLE)) AS INTEGER) AS reorder_point,
               CASE WHEN l_partkey % 11 = 0 THEN CAST(0 AS DOUBLE)
                    ELSE floor(ideal * CAST(10000 AS DOUBLE) / (n * (l_partkey % 25 + 1))) / CAST(10000 AS DOUBLE) END
                 AS avg_consumption,
               p_type AS product_class
        FROM part_stock JOIN part ON l_partkey = p_partkey""",
    "geo": f"""
        SELECT 'company' AS entity_type, CAST(n_nationkey AS VARCHAR) AS entity_id, n_name AS localidade,
               {UFS}[n_nationkey + 1] AS uf, n_name AS estado, r_name AS regiao,
               CAST(n_nationkey * 1.5 - 20 AS DECIMAL(10,6)) AS latitude,
               CAST(n_nationkey * 2 - 60 AS DECIMAL(11,6)) AS longitude
        FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT 'warehouse', CAST(s_suppkey AS VARCHAR), n_name, {UFS}[n_nationkey + 1], n_name, r_name,
               CAST(n_nationkey * 1.5 - 20 AS DECIMAL(10,6)), CAST(n_nationkey * 2 - 60 AS DECIMAL(11,6))
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "weather_days": f"""
        SELECT {UFS}[s_nationkey + 1] AS location_uf, CAST(l_shipdate AS DATE) AS weather_date,
               {r("SUM(CAST(round(l_discount * 100) AS BIGINT)) / COUNT(*)", 2)} AS avg_temperature_c,
               CAST(MIN(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS min_temperature_c,
               CAST(MAX(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS max_temperature_c,
               {r("SUM(CAST(round(l_tax * 100) AS BIGINT)) / COUNT(*)", 2)} AS precipitation_mm,
               {r("SUM(CAST(l_quantity AS BIGINT)) / COUNT(*)", 2)} AS wind_speed_kmh,
               {CODES}[CAST(COUNT(*) % {len(CODES)} AS INTEGER) + 1] AS weather_code
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, CAST(l_shipdate AS DATE)""",
    "weather": f"""
        SELECT location_uf, weather_date, CAST(avg_temperature_c AS DECIMAL(5,2)) AS avg_temperature_c,
               CAST(precipitation_mm AS DECIMAL(8,2)) AS precipitation_mm,
               CAST(wind_speed_kmh AS DECIMAL(6,2)) AS wind_speed_kmh, {LABELS} AS weather_condition
        FROM weather_days""",
    "mart_order_sla": """
        SELECT order_id, document_number, document_type, company_id, depositor_id, issued_at, delivered_at,
               delivered_at_proxy, resolved_delivered_at, total_value, 48 AS sla_target_hours,
               CAST(date_trunc('day', issued_at) AS TIMESTAMP) AS issued_date,
               CAST(date_trunc('month', issued_at) AS TIMESTAMP) AS issued_month,
               hours AS cycle_time_hours,
               CASE WHEN hours IS NULL THEN 'pending' WHEN hours <= 24 THEN 'on_time_express'
                    WHEN hours <= 48 THEN 'on_time' WHEN hours <= 72 THEN 'at_risk' ELSE 'late' END AS sla_status,
               resolved_delivered_at IS NOT NULL AS sla_met
        FROM (SELECT *, date_diff('second', issued_at, resolved_delivered_at) / CAST(3600 AS DOUBLE) AS hours
              FROM (SELECT o.*, p.delivered_at_proxy, coalesce(o.delivered_at, p.delivered_at_proxy)
                             AS resolved_delivered_at
                    FROM fct_orders o JOIN asof_proxy p ON p.order_id = o.order_id))""",
    "asof_proxy": """
        SELECT o.order_id, MIN(m.movement_date) AS delivered_at_proxy
        FROM fct_orders o LEFT JOIN outbound m
          ON m.movement_status = '8' AND m.depositor_id = o.depositor_id AND m.movement_date > o.issued_at
        WHERE o.issued_at IS NOT NULL GROUP BY o.order_id""",
    "mart_inventory_health": f"""
        SELECT inventory_id, product_id, warehouse_id, company_id, product_class, min_stock_qty, max_stock_qty,
               ideal_stock_qty, safety_stock_qty, reorder_point, avg_consumption,
               CASE WHEN avg_consumption > 0 THEN {r("min_stock_qty / avg_consumption", 1)} END AS coverage_days,
               CASE WHEN ideal_stock_qty > 0 THEN {r("min_stock_qty / ideal_stock_qty", 2)} END
                 AS stock_utilization_rate,
               CASE WHEN avg_consumption = 0 AND min_stock_qty = 0 THEN 'critical'
                    WHEN avg_consumption = 0 THEN 'healthy'
                    WHEN min_stock_qty / avg_consumption <= 3 THEN 'critical'
                    WHEN min_stock_qty / avg_consumption <= 7 THEN 'high'
                    WHEN min_stock_qty / avg_consumption <= 14 THEN 'medium' ELSE 'healthy' END AS stockout_risk,
               CASE WHEN min_stock_qty <= safety_stock_qty THEN true ELSE false END AS below_safety_stock,
               CASE WHEN min_stock_qty <= reorder_point THEN true ELSE false END AS below_reorder_point
        FROM fct_inventory_snapshot""",
    "mart_stockout_risk": f"""
        SELECT *, CASE WHEN days_to_stockout IS NULL AND current_stock = 0 THEN 'stockout'
                       WHEN days_to_stockout IS NULL THEN 'low' WHEN days_to_stockout <= 0 THEN 'stockout'
                       WHEN days_to_stockout <= 3 THEN 'critical' WHEN days_to_stockout <= 7 THEN 'high'
                       WHEN days_to_stockout <= 14 THEN 'medium' ELSE 'low' END AS risk_level,
               DATE '2001-08-01' AS snapshot_date
        FROM (SELECT inventory_id, product_id, warehouse_id, company_id, product_class,
                     min_stock_qty AS current_stock, safety_stock_qty, reorder_point,
                     avg_consumption AS avg_daily_consumption,
                     CASE WHEN avg_consumption > 0 THEN {r("min_stock_qty / avg_consumption", 1)} END
                       AS days_to_stockout
              FROM fct_inventory_snapshot)""",
    "mart_operator_productivity": f"""
        SELECT *, {r("(outbound_count * 1.5 + inbound_count) / CAST(movement_count AS DOUBLE)", 3)} AS complexity_index,
               {r("total_qty_handled / CAST(movement_count AS DOUBLE)", 2)} AS avg_qty_per_move,
               rank() OVER (PARTITION BY warehouse_id, period_date ORDER BY movement_count DESC) AS daily_ranking
        FROM (SELECT operator_user, warehouse_id, CAST(date_trunc('day', movement_date) AS TIMESTAMP) AS period_date,
                     COUNT(*) AS movement_count, CAST(SUM(abs(qty_delta)) AS BIGINT) AS total_qty_handled,
                     COUNT(CASE WHEN qty_delta < 0 THEN 1 END) AS outbound_count,
                     COUNT(CASE WHEN qty_delta > 0 THEN 1 END) AS inbound_count,
                     COUNT(DISTINCT product_id) AS distinct_skus
              FROM fct_movements WHERE operator_user IS NOT NULL AND movement_date IS NOT NULL GROUP BY 1, 2, 3)""",
    "mart_picking_performance": f"""
        SELECT *, CASE WHEN active_hours > 0 THEN {r("picks_count / active_hours", 2)} END AS picks_per_hour
        FROM (SELECT operator_user, warehouse_id, CAST(date_trunc('day', movement_date) AS TIMESTAMP) AS shift_date,
                     CASE WHEN hour(movement_date) BETWEEN 6 AND 13 THEN 'morning'
                          WHEN hour(movement_date) BETWEEN 14 AND 21 THEN 'afternoon' ELSE 'night' END AS shift,
                     COUNT(*) AS picks_count, CAST(SUM(abs(qty_delta)) AS BIGINT) AS total_qty_picked,
                     COUNT(DISTINCT product_id) AS distinct_skus_picked, MIN(movement_date) AS shift_start,
                     MAX(movement_date) AS shift_end,
                     {r("date_diff('second', MIN(movement_date), MAX(movement_date)) / CAST(3600 AS DOUBLE)", 2)}
                       AS active_hours
              FROM fct_movements
              WHERE qty_delta < 0 AND operator_user IS NOT NULL AND movement_date IS NOT NULL GROUP BY 1, 2, 3, 4)""",
    "mart_geo_performance": f"""
        SELECT s.*, coalesce(c.localidade, d.localidade) AS cidade, coalesce(c.uf, d.uf) AS uf,
               coalesce(c.estado, d.estado) AS estado, coalesce(c.regiao, d.regiao) AS regiao,
               coalesce(c.latitude, d.latitude) AS latitude, coalesce(c.longitude, d.longitude) AS longitude
        FROM (SELECT company_id, depositor_id, CAST(date_trunc('month', issued_at) AS TIMESTAMP) AS issued_month,
                     COUNT(*) AS order_count, COUNT(delivered_at) AS delivered_count,
                     {money("total_value")} AS total_value,
                     CAST(SUM({SECONDS}) AS DOUBLE) / COUNT({SECONDS}) / CAST(3600 AS DOUBLE) AS avg_cycle_time_hours,
                     {r(f"100.0 * COUNT(CASE WHEN {SECONDS} <= 172800 THEN 1 END) / COUNT(*)", 2)}
                       AS sla_compliance_pct,
                     {r(f"100.0 * COUNT(CASE WHEN {SECONDS} > 172800 THEN 1 END) / COUNT(*)", 2)} AS late_delivery_pct
              FROM fct_orders WHERE issued_at IS NOT NULL GROUP BY 1, 2, 3) s
        LEFT JOIN geo c ON c.entity_type = 'company' AND c.entity_id = s.company_id
        LEFT JOIN geo d ON d.entity_type = 'warehouse' AND d.entity_id = s.depositor_id""",
    "mart_geo_inventory": f"""
        SELECT i.*, g.localidade AS cidade, g.uf, g.estado, g.regiao, g.latitude, g.longitude
        FROM (SELECT warehouse_id, company_id, product_class, COUNT(DISTINCT product_id) AS product_count,
                     CAST(SUM(min_stock_qty) AS BIGINT) AS total_current_stock,
                     CAST(SUM(safety_stock_qty) AS BIGINT) AS total_safety_stock,
                     CAST(SUM(ideal_stock_qty) AS BIGINT) AS total_ideal_stock,
                     {mean("CASE WHEN avg_consumption > 0 THEN min_stock_qty / avg_consumption END", 1)}
                       AS avg_coverage_days,
                     COUNT(CASE WHEN min_stock_qty <= safety_stock_qty THEN 1 END) AS stockout_count,
                     COUNT(CASE WHEN min_stock_qty <= reorder_point THEN 1 END) AS below_reorder_count,
                     {r("100.0 * COUNT(CASE WHEN min_stock_qty > safety_stock_qty THEN 1 END) / COUNT(*)", 2)}
                       AS stock_health_pct
              FROM fct_inventory_snapshot GROUP BY 1, 2, 3) i
        LEFT JOIN geo g ON g.entity_type = 'warehouse' AND g.entity_id = i.warehouse_id""",
    "mart_weather_impact": f"""
        SELECT o.*, w.weather_condition, w.avg_temperature_c, w.precipitation_mm, w.wind_speed_kmh
        FROM (SELECT company_id, depositor_id, CAST(issued_at AS DATE) AS issued_date,
                     CAST(date_trunc('month', issued_at) AS TIMESTAMP) AS issued_month, COUNT(*) AS order_count,
                     CAST(SUM({SECONDS}) AS DOUBLE) / COUNT({SECONDS}) / CAST(3600 AS DOUBLE) AS avg_cycle_time_hours,
                     COUNT(CASE WHEN {SECONDS} > 172800 THEN 1 END) AS delayed_order_count,
                     {r(f"100.0 * COUNT(CASE WHEN {SECONDS} > 172800 THEN 1 END) / COUNT(*)", 2)} AS delay_rate_pct
              FROM fct_orders WHERE issued_at IS NOT NULL GROUP BY 1, 2, 3, 4) o
        LEFT JOIN geo c ON c.entity_type = 'company' AND c.entity_id = o.company_id
        LEFT JOIN weather w ON w.location_uf = c.uf AND w.weather_date = o.issued_date""",
    "orphans": """
        SELECT m.* FROM outbound m
        LEFT JOIN (SELECT depositor_id AS d, MIN(issued_at) AS first_issued FROM fct_orders GROUP BY 1) ON d = depositor_id
        WHERE movement_status = '8' AND coalesce(first_issued > movement_date, true)""",
    "clients": """
        SELECT depositor_id, COUNT(*) FILTER (early) AS orders_a, COUNT(*) FILTER (NOT early) AS orders_b,
               COUNT(*) FILTER (early AND sla_status = 'late') AS late_a,
               COUNT(*) FILTER (early AND sla_status IN ('late', 'at_risk')) AS problem_a,
               CAST(MIN(issued_at) FILTER (early) AS DATE) AS first_a, CAST(MAX(issued_at) FILTER (early) AS DATE) AS last_a,
               CAST(MIN(issued_at) FILTER (NOT early) AS DATE) AS first_b,
               CAST(SUM(amount) FILTER (early) AS DOUBLE) AS sum_a, COUNT(amount) FILTER (early) AS priced_a,
               CAST(SUM(amount) FILTER (NOT early) AS DOUBLE) AS sum_b
        FROM (SELECT *, issued_at < '2001-04-01' AS early, CAST(total_value AS DECIMAL(15,2)) AS amount
              FROM mart_order_sla WHERE issued_at >= '2001-01-01' AND issued_at < '2001-05-01')
        GROUP BY depositor_id""",
    "dedup_outbound": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY movement_id ORDER BY product_id, warehouse_id, depositor_id,
                   qty_before, qty_after, qty_delta, movement_date, movement_status, notes) AS rn FROM outbound)
        WHERE rn = 1""",
    "place_sla": """
        SELECT g.*, coalesce(m.sla_compliance_pct, 0) AS sla, coalesce(m.order_count, 0) AS n,
               coalesce(m.late_delivery_pct, 0) AS late
        FROM geo g LEFT JOIN mart_geo_performance m ON m.company_id = g.entity_id AND g.entity_type = 'company'""",
    "items": """
        SELECT l_orderkey AS idpedido, CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE 'P' || l_orderkey END AS nrpedido,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_partkey AS VARCHAR) END AS cdproduto,
               CASE WHEN l_linenumber <> 7 THEN p_name END AS dsproduto, CAST(l_quantity AS BIGINT) AS qty,
               CASE WHEN l_linenumber = 6 THEN 0 ELSE l_partkey % 1000 + 1 END AS unit,
               CASE WHEN l_linenumber % 3 = 0
                    THEN CAST(floor(CAST(round(l_extendedprice * 100) AS BIGINT)
                                    * (100 - CAST(round(l_discount * 100) AS BIGINT)) / CAST(100 AS DOUBLE)) / 100
                              AS DECIMAL(15,2))
                    ELSE 0 END AS net
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "valued": """
        SELECT *, CASE WHEN net > 0 THEN net WHEN qty > 0 AND unit > 0 THEN CAST(qty * unit AS DECIMAL(28,6))
                       ELSE 0 END AS value FROM items""",
    "runs": """
        SELECT event_type AS job, 'task_' || user_id % 10 AS task,
               CASE WHEN event_id % 9 = 0 THEN 'failed' WHEN event_id % 97 = 1 THEN 'running'
                    WHEN event_id % 50 = 2 THEN 'up_for_retry' ELSE 'success' END AS state,
               'scheduled' AS run_type, ts AS started_at,
               CASE WHEN event_id % 97 <> 1 THEN ts + to_seconds(CAST(event_id % 300 AS INTEGER)) END AS ended_at,
               CAST(event_id % 3 + 1 AS INTEGER) AS attempt, CAST(event_id AS VARCHAR) AS run_id
        FROM events""",
    "states": "SELECT * FROM (VALUES " + ", ".join(
        f"('{s[0]}', '{s[1]}', '{s[2]}', {s[4]}, {s[5]})" for s in STATES
    ) + ") AS t(uf, estado, regiao, lat, lon)",
    "paragraphs": """
        SELECT doc_id, string_split_regex(trim(text, SPACE()), '\\n+') AS p FROM documents""",
    "folded": """
        SELECT doc_id, 0 AS i, '' AS cur, CAST(NULL AS VARCHAR) AS closed FROM paragraphs
        UNION ALL
        SELECT f.doc_id, f.i + 1,
               CASE WHEN length(cur) + length(p[f.i + 1]) + 2 > 800 AND cur <> ''
                    THEN right(cur, 100) || chr(10) || chr(10) || p[f.i + 1]
                    ELSE trim(cur || chr(10) || chr(10) || p[f.i + 1], SPACE()) END,
               CASE WHEN length(cur) + length(p[f.i + 1]) + 2 > 800 AND cur <> '' THEN trim(cur, SPACE()) END
        FROM folded f JOIN paragraphs g ON g.doc_id = f.doc_id WHERE f.i < len(p)""",
    "chunks": """
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, content
        FROM (SELECT doc_id, i, closed AS content FROM folded WHERE closed IS NOT NULL
              UNION ALL
              SELECT f.doc_id, f.i + 1, trim(cur, SPACE()) FROM folded f JOIN paragraphs g ON g.doc_id = f.doc_id
              WHERE f.i = len(p) AND cur <> '')
        WHERE length(content) > 50""",
}
_SPACE = " || ".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288,
))


def query(text: str) -> str:
    """``text`` behind the common tables it needs, in order of definition."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in COMMON:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                if name != "folded":
                    visit(COMMON[name])
                else:
                    visit(COMMON["paragraphs"] + " paragraphs")
                needed.append(name)

    visit(text)
    if not needed:
        return text
    recursive = "RECURSIVE " if "folded" in needed else ""
    ctes = ",\n".join(f"{n} AS ({COMMON[n]})" for n in dict.fromkeys(needed))
    return f"WITH {recursive}{ctes}\n{text}".replace("SPACE()", f"({_SPACE})")


def _tests() -> str:
    parts = []
    for model, (not_null, unique, accepted) in TESTS.items():
        table = model.replace("stg_", "fct_") if model != "stg_inventory" else "fct_inventory_snapshot"
        if model == "dim_products":
            table = "fct_inventory_snapshot"
        for c in not_null:
            parts.append(
                f"SELECT '{model}' AS model, 'not_null' AS test, '{c}' AS column_name, COUNT(*) AS failures "
                f"FROM {table} WHERE {c} IS NULL"
            )
        for c in unique:
            parts.append(
                f"SELECT '{model}', 'unique', '{c}', COUNT(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING COUNT(*) > 1)"
            )
        for c, values in accepted.items():
            known = ", ".join(f"'{v}'" for v in values)
            parts.append(
                f"SELECT '{model}', 'accepted_values', '{c}', COUNT(*) FROM {table} WHERE {c} NOT IN ({known})"
            )
    return "\nUNION ALL ".join(parts)


def _pct(condition: str, digits: int = 1) -> str:
    return r(f"100.0 * COUNT(CASE WHEN {condition} THEN 1 END) / COUNT(*)", digits)


ON_TIME = "sla_status IN ('on_time_express', 'on_time')"


def _places(keys: str, order: str) -> str:
    return f"""
        SELECT {keys}, {mean("sla", 1)} AS sla_pct, CAST(SUM(n) AS BIGINT) AS orders, {mean("late", 1)} AS late_pct
        FROM place_sla GROUP BY ALL ORDER BY {order}"""


ALL_MOVEMENTS = ", ".join((
    "movement_id", "product_id", "warehouse_id", "depositor_id", "qty_before", "qty_after", "qty_delta",
    "movement_date", "movement_status", "operator_user", "notes",
))

SQL = {
    # staging, facts, de-duplication
    "stg_orders": "SELECT * FROM fct_orders",
    "stg_inventory": "SELECT * FROM fct_inventory_snapshot",
    "stg_movements": f"SELECT {ALL_MOVEMENTS} FROM dedup_outbound",
    "fct_orders": "SELECT * FROM fct_orders",
    "fct_movements": "SELECT * FROM fct_movements",
    "fct_inventory_snapshot": "SELECT * FROM fct_inventory_snapshot",
    "dim_products": "SELECT DISTINCT product_id, warehouse_id, company_id, product_class FROM fct_inventory_snapshot",
    "dedup_latest": f"""
        SELECT {ALL_MOVEMENTS} FROM (
          SELECT *, row_number() OVER (PARTITION BY movement_id ORDER BY movement_date DESC, product_id, warehouse_id,
                   depositor_id, qty_before, qty_after, qty_delta, movement_status, notes) AS rn FROM outbound)
        WHERE rn = 1""",
    # marts
    **{m: f"SELECT * FROM {m}" for m in (
        "mart_order_sla", "mart_inventory_health", "mart_stockout_risk", "mart_operator_productivity",
        "mart_picking_performance", "mart_geo_performance", "mart_geo_inventory", "mart_weather_impact",
    )},
    "asof_proxy": "SELECT order_id, delivered_at_proxy FROM asof_proxy",
    "asof_proxy_heavy_key": """
        SELECT o.order_id, o.issued_at, MIN(m.movement_date) AS delivered_at_proxy
        FROM (SELECT order_id, issued_at, CASE WHEN CAST(depositor_id AS BIGINT) % 3 = 0 THEN '0' ELSE depositor_id END
                AS depositor_id FROM fct_orders) o
        ASOF LEFT JOIN (SELECT DISTINCT movement_date, CASE WHEN CAST(depositor_id AS BIGINT) % 3 = 0 THEN '0'
                          ELSE depositor_id END AS depositor_id FROM outbound WHERE movement_status = '8') m
          ON m.depositor_id = o.depositor_id AND o.issued_at < m.movement_date
        GROUP BY o.order_id, o.issued_at""",
    "orders_left_geo": """
        SELECT o.order_id, o.company_id, g.localidade AS cidade, g.uf, g.regiao FROM fct_orders o
        LEFT JOIN geo g ON g.entity_type = 'company' AND g.entity_id = o.company_id""",
    # audits
    "layer_summary": """
        SELECT 'bronze.orders_documento' AS table_name, COUNT(*) AS row_count, MIN(issued_at) AS first_date,
               MAX(issued_at) AS last_date, COUNT(CASE WHEN issued_at IS NULL THEN 1 END) AS null_watermarks
        FROM fct_orders
        UNION ALL SELECT 'bronze.movements_entrada_saida', COUNT(*), MIN(movement_date), MAX(movement_date),
               COUNT(CASE WHEN movement_date IS NULL THEN 1 END) FROM outbound
        UNION ALL SELECT 'bronze.products_snapshot', COUNT(*), NULL, NULL, 0 FROM part
        UNION ALL SELECT 'bronze.inventory_produtoestoque', COUNT(*), NULL, NULL, 0 FROM part_stock""",
    "ingestion_gaps": """
        SELECT d AS day, CASE WHEN o.day IS NULL THEN '❌ SEM DADOS' ELSE '✅ OK' END AS orders,
               CASE WHEN m.day IS NULL THEN '❌ SEM DADOS' ELSE '✅ OK' END AS movements
        FROM (SELECT CAST(range AS DATE) AS d FROM range(DATE '2001-10-01' - 90, DATE '2001-10-01', INTERVAL 1 DAY))
        LEFT JOIN (SELECT DISTINCT CAST(issued_at AS DATE) AS day FROM fct_orders) o ON o.day = d
        LEFT JOIN (SELECT DISTINCT CAST(movement_date AS DATE) AS day FROM outbound) m ON m.day = d
        WHERE o.day IS NULL OR m.day IS NULL ORDER BY d DESC LIMIT 20""",
    "duplicate_keys": """
        SELECT 'movements_entrada_saida' AS table_name, movement_id AS key, COUNT(*) AS occurrences
        FROM outbound GROUP BY movement_id HAVING COUNT(*) > 1 ORDER BY occurrences DESC, key LIMIT 10""",
    "orphan_count": "SELECT COUNT(*) AS orphan_movements FROM orphans",
    "orphan_by_month": """
        SELECT CAST(date_trunc('month', movement_date) AS DATE) AS month, movement_status, COUNT(*) AS total,
               COUNT(DISTINCT depositor_id) AS distinct_depositors, COUNT(DISTINCT product_id) AS distinct_products,
               CAST(MIN(movement_date) AS DATE) AS first_day, CAST(MAX(movement_date) AS DATE) AS last_day
        FROM orphans GROUP BY 1, 2""",
    "orphan_class": """
        SELECT CASE WHEN movement_date < (SELECT MIN(issued_at) FROM fct_orders)
                    THEN 'anterior_ao_periodo_de_extracao' ELSE 'dentro_do_periodo' END AS orphan_class,
               COUNT(*) AS total, CAST(MIN(movement_date) AS DATE) AS first_day,
               CAST(MAX(movement_date) AS DATE) AS last_day
        FROM orphans GROUP BY 1""",
    "delivery_coverage": f"""
        SELECT COUNT(*) AS orders, COUNT(delivered_at) AS with_delivery,
               COUNT(CASE WHEN delivered_at IS NULL AND delivered_at_proxy IS NOT NULL THEN 1 END) AS proxy_only,
               COUNT(CASE WHEN delivered_at IS NULL AND delivered_at_proxy IS NULL THEN 1 END) AS with_neither,
               {_pct("resolved_delivered_at IS NOT NULL")} AS resolved_pct
        FROM mart_order_sla""",
    "sla_distribution": f"""
        SELECT sla_status, COUNT(*) AS orders, {r("100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()", 1)} AS pct
        FROM mart_order_sla WHERE issued_at >= TIMESTAMP '2001-02-01' GROUP BY sla_status""",
    "active_clients": """
        SELECT CAST(date_trunc('month', issued_at) AS DATE) AS month, COUNT(DISTINCT depositor_id) AS active_clients,
               COUNT(*) AS orders
        FROM mart_order_sla WHERE issued_at >= TIMESTAMP '2001-02-01' GROUP BY 1""",
    "mart_counts": "\nUNION ALL ".join(
        f"SELECT '{m}' AS table_name, COUNT(*) AS row_count FROM {m}" for m in (
            "mart_order_sla", "mart_inventory_health", "mart_picking_performance", "mart_operator_productivity",
            "mart_stockout_risk",
        )
    ),
    "freshness": """
        SELECT *, date_diff('second', last_load, TIMESTAMP '2001-08-01') / CAST(3600 AS DOUBLE) AS age_hours,
               CASE WHEN last_load IS NULL THEN 'WARN'
                    WHEN date_diff('second', last_load, TIMESTAMP '2001-08-01') / 3600.0 <= limit_hours THEN 'OK'
                    ELSE 'STALE' END AS status
        FROM (SELECT 'bronze.orders_documento' AS table_name, MAX(issued_at) + INTERVAL 1 HOUR AS last_load,
                     COUNT(*) AS row_count, 26 AS limit_hours FROM fct_orders
              UNION ALL SELECT 'bronze.movements_entrada_saida', MAX(ts), COUNT(*), 26 FROM events
              UNION ALL SELECT 'bronze.inventory_produtoestoque', MAX(loaded), COUNT(*), 26 FROM part_stock)""",
    "recency": """
        SELECT *, date_diff('second', latest, TIMESTAMP '2001-08-01') / CAST(86400 AS DOUBLE) AS age_days,
               CASE WHEN latest IS NULL THEN 'WARN'
                    WHEN date_diff('second', latest, TIMESTAMP '2001-08-01') / 86400.0 <= 2 THEN 'OK'
                    ELSE 'STALE' END AS status
        FROM (SELECT 'fct_orders' AS table_name, MAX(issued_at) AS latest, COUNT(*) AS row_count FROM fct_orders
              UNION ALL SELECT 'fct_movements', MAX(movement_date), COUNT(*) FROM fct_movements)""",
    "freshness_summary": """
        SELECT 'orders_bronze' AS label, COUNT(*) AS row_count, MAX(issued_at) + INTERVAL 1 HOUR AS latest
        FROM fct_orders
        UNION ALL SELECT 'movements_bronze', COUNT(*), MAX(ts) FROM events
        UNION ALL SELECT 'orders_gold', COUNT(*), MAX(issued_at) FROM fct_orders
        UNION ALL SELECT 'movements_gold', COUNT(*), MAX(movement_date) FROM fct_movements
        UNION ALL SELECT 'mart_sla', COUNT(*), MAX(issued_at) FROM mart_order_sla""",
    "silver_metrics": """
        SELECT 'movements' AS entity, COUNT(*) AS rows_read, COUNT(DISTINCT movement_id) AS rows_written,
               COUNT(*) - COUNT(DISTINCT movement_id) AS rows_deduplicated, 'run-1' AS run_id FROM outbound""",
    "gold_counts": "\nUNION ALL ".join(
        f"SELECT '{m}' AS table_name, COUNT(*) AS row_count FROM {t}" for m, t in {
            "fct_orders": "fct_orders", "fct_movements": "fct_movements",
            "dim_products": "(SELECT DISTINCT product_id, warehouse_id, company_id, product_class "
                            "FROM fct_inventory_snapshot)",
            "mart_order_sla": "mart_order_sla", "mart_operator_productivity": "mart_operator_productivity",
            "mart_picking_performance": "mart_picking_performance", "mart_stockout_risk": "mart_stockout_risk",
            "mart_inventory_health": "mart_inventory_health", "mart_geo_performance": "mart_geo_performance",
        }.items()
    ),
    "date_profile": """
        SELECT COUNT(*) AS row_count, MIN(delivered_at) AS min_first, MAX(delivered_at) AS max_first,
               MIN(issued_at) AS min_second, MAX(issued_at) AS max_second,
               COUNT(CASE WHEN delivered_at IS NULL THEN 1 END) AS null_first,
               MIN(coalesce(delivered_at, issued_at)) AS min_either,
               MAX(coalesce(delivered_at, issued_at)) AS max_either
        FROM fct_orders""",
    "pending_alarm": """
        SELECT MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS days
        FROM (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS run
              FROM (SELECT CAST(issued_at AS DATE) AS day FROM mart_order_sla GROUP BY 1
                    HAVING COUNT(CASE WHEN sla_status = 'pending' THEN 1 END) / COUNT(*) > 0.05))
        GROUP BY run HAVING COUNT(*) > 3""",
    "lost_clients": f"""
        SELECT depositor_id, orders_a AS orders, first_a AS first_order, last_a AS last_order,
               {r("sum_a / priced_a", 2)} AS mean_ticket, sum_a AS total_value, late_a AS late_orders,
               {r("100.0 * late_a / orders_a", 1)} AS late_pct
        FROM clients WHERE orders_a > 0 AND orders_b = 0""",
    "churn_summary": f"""
        SELECT a AS active_before, b AS active_after, a - both_periods AS lost_clients, b - both_periods AS new_clients,
               {r("100.0 * (a - both_periods) / nullif(a, 0)", 1)} AS churn_pct
        FROM (SELECT COUNT(*) FILTER (orders_a > 0) AS a, COUNT(*) FILTER (orders_b > 0) AS b,
                     COUNT(*) FILTER (orders_a > 0 AND orders_b > 0) AS both_periods FROM clients)""",
    "lost_sla": f"""
        SELECT depositor_id, orders_a AS orders, problem_a AS problem_orders,
               {r("100.0 * problem_a / orders_a", 1)} AS problem_pct
        FROM clients WHERE orders_a > 0 AND orders_b = 0""",
    "new_clients": """
        SELECT depositor_id, orders_b AS orders, first_b AS first_order, sum_b AS total_value
        FROM clients WHERE orders_b > 0 AND orders_a = 0""",
    "gate_rows": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, {n} AS min_rows, "
        f"CASE WHEN COUNT(*) >= {n} THEN 'OK' ELSE 'FAIL' END AS status FROM {t}" for t, n in MIN_ROWS.items()
    ),
    "gate_nulls": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) AS null_count, "
        f"CASE WHEN COUNT(*) = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM {t} WHERE {c} IS NULL" for t, c in NEVER_NULL
    ),
    "test_results": _tests(),
    "test_unique": """
        SELECT movement_id, COUNT(*) AS n_records FROM outbound WHERE movement_id IS NOT NULL GROUP BY 1
        HAVING COUNT(*) > 1""",
    "test_not_null": "SELECT order_id, issued_at FROM fct_orders WHERE delivered_at IS NULL",
    "test_accepted_values": """
        SELECT notes AS value_field, COUNT(*) AS n_records FROM fct_movements
        WHERE notes NOT IN ('purchase', 'view') GROUP BY 1""",
    "test_relationship": """
        SELECT order_id, depositor_id FROM fct_orders
        WHERE depositor_id IS NOT NULL AND depositor_id NOT IN (SELECT warehouse_id FROM fct_inventory_snapshot)""",
    # panels
    "kpis": """
        SELECT COUNT(*) AS orders, COUNT(CASE WHEN sla_status = 'pending' THEN 1 END) AS open_orders,
               COUNT(CASE WHEN sla_status = 'late' THEN 1 END) AS late_orders FROM mart_order_sla""",
    "movement_count": "SELECT COUNT(*) AS movements FROM fct_movements",
    "items_at_risk": """
        SELECT COUNT(*) AS items_at_risk FROM mart_stockout_risk WHERE risk_level IN ('critical', 'stockout')""",
    "on_time_pct": f"SELECT {_pct(ON_TIME)} AS on_time_pct FROM mart_order_sla WHERE sla_status <> 'pending'",
    "moves_per_day": """
        SELECT CAST(date_trunc('day', movement_date) AS TIMESTAMP) AS time, COUNT(*) AS movements FROM fct_movements
        WHERE movement_date BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' GROUP BY 1""",
    "status_pivot": """
        SELECT COUNT(CASE WHEN sla_status = 'on_time_express' THEN 1 END) AS express,
               COUNT(CASE WHEN sla_status = 'on_time' THEN 1 END) AS on_time,
               COUNT(CASE WHEN sla_status = 'at_risk' THEN 1 END) AS at_risk,
               COUNT(CASE WHEN sla_status = 'late' THEN 1 END) AS late,
               COUNT(CASE WHEN sla_status = 'pending' THEN 1 END) AS pending FROM mart_order_sla""",
    "month_company": f"""
        SELECT strftime(issued_at, '%Y-%m') AS month, company_id, COUNT(*) AS orders, {money("total_value")} AS total_value,
               {_pct(ON_TIME)} AS sla_pct
        FROM mart_order_sla GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 24""",
    "monthly_revenue": f"""
        SELECT strftime(issued_at, '%Y-%m') AS month, {money("total_value")} AS revenue
        FROM fct_orders WHERE issued_at >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY GROUP BY 1""",
    "document_types": f"""
        SELECT document_type, company_id, COUNT(*) AS orders,
               {r("CAST(SUM(CAST(total_value AS DECIMAL(15,2))) AS DOUBLE) / COUNT(total_value)", 2)} AS mean_value
        FROM fct_orders GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    "top_operators": f"""
        SELECT operator_user, CAST(SUM(movement_count) AS BIGINT) AS movements,
               {mean("avg_qty_per_move", 2)} AS qty_per_move, {mean("complexity_index", 3)} AS complexity,
               MAX(daily_ranking) AS max_rank, MIN(daily_ranking) AS best_rank
        FROM mart_operator_productivity GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "backlog_ageing": """
        SELECT CASE WHEN age <= 7 THEN '1_0-7d' WHEN age <= 30 THEN '2_7-30d' WHEN age <= 90 THEN '3_30-90d'
                    ELSE '4_>90d' END AS age_class, COUNT(*) AS orders
        FROM (SELECT date_diff('second', issued_at, TIMESTAMP '2001-08-01') / 86400.0 AS age FROM mart_order_sla
              WHERE sla_status = 'pending') GROUP BY 1""",
    "oldest_open": f"""
        SELECT order_id, document_number, company_id, issued_at,
               {r("date_diff('second', issued_at, TIMESTAMP '2001-08-01') / CAST(3600 AS DOUBLE)", 1)} AS age_hours,
               {r("total_value", 2)} AS total_value
        FROM mart_order_sla WHERE sla_status = 'pending' ORDER BY issued_at, order_id LIMIT 15""",
    "stockout_table": f"""
        SELECT product_id, warehouse_id, product_class, current_stock,
               {r("avg_daily_consumption", 1)} AS daily_consumption, days_to_stockout, risk_level
        FROM mart_stockout_risk
        ORDER BY CASE risk_level WHEN 'stockout' THEN 0 WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3
                 ELSE 4 END, product_id, warehouse_id LIMIT 20""",
    "sla_by_place": _places("localidade AS name, uf, estado, regiao, latitude, longitude", "uf"),
    "state_rank": _places("uf, estado, regiao", "uf"),
    "region_sla": _places("regiao", "regiao"),
    "rain_by_day": f"""
        SELECT weather_date AS time, location_uf AS metric, {mean("precipitation_mm", 1)} AS value FROM weather
        WHERE weather_date >= DATE '2001-07-02' GROUP BY 1, 2""",
    "delay_by_day": f"""
        SELECT issued_date AS time, coalesce(g.uf, 'N/A') AS metric, {mean("delay_rate_pct", 1)} AS value
        FROM mart_weather_impact m LEFT JOIN geo g ON g.entity_id = m.company_id AND g.entity_type = 'company'
        WHERE issued_date >= DATE '2001-07-02' GROUP BY issued_date, g.uf""",
    "temperature_series": f"""
        SELECT weather_date AS time, location_uf AS metric, {r("avg_temperature_c", 1)} AS value FROM weather
        WHERE weather_date >= DATE '2001-07-02' AND location_uf IN ('SP', 'RJ', 'MG', 'PR', 'BA')""",
    "run_counts": """
        SELECT COUNT(CASE WHEN recent THEN 1 END) AS runs,
               COUNT(CASE WHEN recent AND state = 'success' THEN 1 END) AS succeeded,
               COUNT(CASE WHEN recent AND state = 'failed' THEN 1 END) AS failed,
               COUNT(CASE WHEN state = 'running' THEN 1 END) AS running
        FROM (SELECT *, started_at >= TIMESTAMP '2024-01-30' AS recent FROM runs)""",
    "run_history": f"""
        SELECT job, state, run_type, started_at, ended_at,
               {r("date_diff('second', started_at, coalesce(ended_at, TIMESTAMP '2024-01-31')) / CAST(60 AS DOUBLE)", 1)}
                 AS minutes, run_id
        FROM runs ORDER BY started_at DESC, run_id LIMIT 30""",
    "recent_failures": """
        SELECT job, task, state, started_at, CAST(date_diff('second', started_at, ended_at) AS DOUBLE) AS seconds,
               attempt, run_id
        FROM runs WHERE state IN ('failed', 'up_for_retry') ORDER BY started_at DESC, run_id LIMIT 20""",
    "task_durations": f"""
        SELECT job, task, COUNT(*) AS runs, {mean("s", 1)} AS mean_seconds, MAX(s) AS max_seconds,
               COUNT(CASE WHEN state = 'success' THEN 1 END) AS succeeded,
               COUNT(CASE WHEN state = 'failed' THEN 1 END) AS failed
        FROM (SELECT *, CAST(date_diff('second', started_at, ended_at) AS DOUBLE) AS s FROM runs)
        WHERE started_at >= TIMESTAMP '2024-01-24' AND ended_at IS NOT NULL
        GROUP BY 1, 2 ORDER BY mean_seconds DESC, job, task LIMIT 20""",
    # charts
    "chart_order_count": "SELECT COUNT(order_id) AS orders FROM fct_orders",
    "chart_movement_count": "SELECT COUNT(movement_id) AS movements FROM fct_movements",
    "chart_on_time_pct": f"SELECT coalesce({_pct(ON_TIME)}, 0) AS sla_pct FROM mart_order_sla WHERE sla_status <> 'pending'",
    "chart_open_orders": "SELECT COUNT(*) AS open_orders FROM mart_order_sla WHERE sla_status = 'pending'",
    "chart_moves_last_30_days": """
        SELECT CAST(date_trunc('day', movement_date) AS TIMESTAMP) AS movement_date, COUNT(*) AS movements
        FROM fct_movements AS f
        WHERE f.movement_date >= TIMESTAMP '2024-01-01' AND f.movement_date < TIMESTAMP '2024-01-31' GROUP BY 1""",
    "chart_moves_today_by_hour": """
        SELECT CAST(date_trunc('hour', f.movement_date) AS TIMESTAMP) AS movement_date, COUNT(*) AS movements
        FROM fct_movements AS f
        WHERE f.movement_date >= TIMESTAMP '2024-01-30' AND f.movement_date < TIMESTAMP '2024-01-31' GROUP BY 1""",
    "chart_orders_by_status": "SELECT sla_status, COUNT(*) AS orders FROM mart_order_sla GROUP BY 1",
    "chart_month_company": f"""
        SELECT issued_month, company_id, COUNT(*) AS orders, {money("total_value")} AS total_value,
               {_pct(ON_TIME)} AS sla_pct
        FROM mart_order_sla GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 24""",
    "chart_document_types": f"""
        SELECT document_type, company_id, COUNT(*) AS orders,
               {r("CAST(SUM(CAST(total_value AS DECIMAL(15,2))) AS DOUBLE) / COUNT(total_value)", 2)} AS mean_value,
               {money("total_value")} AS total_value
        FROM fct_orders GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    "chart_operators_by_warehouse": f"""
        SELECT operator_user, warehouse_id, CAST(SUM(movement_count) AS BIGINT) AS movements,
               {mean("avg_qty_per_move", 4)} AS qty_per_move, {mean("complexity_index", 4)} AS complexity
        FROM mart_operator_productivity GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    "chart_operator_ranking": f"""
        SELECT operator_user, CAST(SUM(movement_count) AS BIGINT) AS movements,
               {mean("avg_qty_per_move", 4)} AS qty_per_move, MAX(outbound_count) AS max_outbound
        FROM mart_operator_productivity GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "chart_stockout_by_product": f"""
        SELECT product_id, warehouse_id, risk_level, AVG(current_stock) AS current_stock,
               {mean("avg_daily_consumption", 4)} AS daily_consumption, {mean("days_to_stockout", 4)} AS days_to_stockout
        FROM mart_stockout_risk AS f GROUP BY 1, 2, 3 ORDER BY 4, 1, 2, 3 LIMIT 20""",
    "chart_items_by_risk": "SELECT risk_level, COUNT(*) AS items FROM mart_stockout_risk GROUP BY 1",
    "chart_inventory_health": f"""
        SELECT product_id, warehouse_id, stockout_risk, AVG(min_stock_qty) AS min_stock,
               {mean("f.coverage_days", 4)} AS coverage_days, {mean("stock_utilization_rate", 4)} AS utilization
        FROM mart_inventory_health AS f GROUP BY 1, 2, 3 ORDER BY 4, 1, 2, 3 LIMIT 20""",
    "chart_picking_by_shift": f"""
        SELECT shift, operator_user, warehouse_id, CAST(SUM(picks_count) AS BIGINT) AS picks,
               {mean("f.picks_per_hour", 4)} AS picks_per_hour, CAST(SUM(total_qty_picked) AS BIGINT) AS total_qty,
               {mean("distinct_skus_picked", 4)} AS skus_per_shift
        FROM mart_picking_performance AS f GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 20""",
    # summaries and revenue
    "summary_orders": f"""
        SELECT COUNT(*) AS orders,
               (SELECT CAST(SUM(-qty_delta) AS BIGINT) FROM fct_movements WHERE qty_delta < 0) AS units,
               {money("total_value")} AS revenue FROM fct_orders""",
    "summary_inventory": """
        SELECT COUNT(DISTINCT product_id) AS skus, CAST(SUM(min_stock_qty) AS BIGINT) AS on_hand
        FROM fct_inventory_snapshot""",
    "summary_movements": """
        SELECT COUNT(*) AS movements, CAST(SUM(abs(qty_delta)) AS BIGINT) AS units_moved FROM fct_movements""",
    "revenue_by_day": f"""
        SELECT CAST(issued_at AS DATE) AS day, COUNT(*) AS documents, {money("total_value")} AS revenue
        FROM fct_orders GROUP BY 1""",
    "newest_revenue_days": f"""
        SELECT CAST(issued_at AS DATE) AS day, COUNT(*) AS documents, {money("total_value")} AS revenue
        FROM fct_orders GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "revenue_of_day": f"""
        SELECT COUNT(*) AS documents, {money("total_value")} AS revenue FROM fct_orders
        WHERE CAST(issued_at AS DATE) = DATE '2001-06-15'""",
    "item_revenue": """
        SELECT COUNT(*) AS items, CAST(SUM(qty * unit) AS DOUBLE) AS revenue FROM items
        JOIN orders ON o_orderkey = idpedido WHERE CAST(o_orderdate AS DATE) = DATE '2001-06-15'""",
    "estimated_total": "SELECT COUNT(*) AS items, CAST(SUM(value) AS DOUBLE) AS revenue FROM valued",
    "estimated_by_product": """
        SELECT coalesce(cdproduto, 'SEM_PRODUTO') AS product_key, MIN(cdproduto) AS cdproduto,
               MIN(dsproduto) AS dsproduto, CAST(SUM(qty) AS DOUBLE) AS quantity, CAST(SUM(value) AS DOUBLE) AS revenue
        FROM valued GROUP BY 1 ORDER BY 5 DESC, 1 LIMIT 10""",
    "estimated_by_order": """
        SELECT coalesce(nullif(nrpedido, ''), CAST(idpedido AS VARCHAR)) AS order_key, COUNT(*) AS items,
               CAST(SUM(value) AS DOUBLE) AS revenue
        FROM valued GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
    "revenue_file": f"""
        SELECT strftime(CAST(issued_at AS DATE), '%Y-%m-%d %H:%M:%S') AS data, COUNT(*) AS documentos,
               {money("total_value")} AS faturamento
        FROM fct_orders GROUP BY 1""",
    "product_file": """
        SELECT MIN(cdproduto) AS cdproduto, MIN(dsproduto) AS dsproduto,
               CAST(CAST(SUM(qty) AS DECIMAL(28,2)) AS VARCHAR) AS qtd_total,
               CAST(CAST(SUM(value) AS DECIMAL(28,2)) AS VARCHAR) AS faturamento_total
        FROM valued GROUP BY coalesce(cdproduto, 'SEM_PRODUTO')""",
    "order_file": """
        SELECT coalesce(nullif(nrpedido, ''), CAST(idpedido AS VARCHAR)) AS pedido, COUNT(*) AS itens,
               CAST(CAST(SUM(value) AS DECIMAL(28,2)) AS VARCHAR) AS faturamento_total
        FROM valued GROUP BY 1""",
    "orders_per_day": """
        SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders FROM orders WHERE o_orderdate IS NOT NULL
        GROUP BY 1 ORDER BY 1 DESC LIMIT 15""",
    # load modes
    "merge_incremental": """
        SELECT * REPLACE (CASE WHEN issued_at >= TIMESTAMP '1999-07-01' THEN delivered_at END AS delivered_at)
        FROM fct_orders""",
    "watermark_scan": """
        SELECT order_id AS sequenciaintegracao, issued_at AS dataemissao, total_value AS valortotaldocumento
        FROM fct_orders WHERE issued_at >= TIMESTAMP '2001-01-01'""",
    "watermark_scan_movements": """
        SELECT l_orderkey || '-' || l_linenumber AS sequenciamovimento, l_shipdate AS datamovimento
        FROM lineitem WHERE l_shipdate >= '2001-06-01'""",
    "full_window_scan": """
        SELECT l_orderkey || '-' || l_linenumber AS sequenciamovimento, l_shipdate AS datamovimento
        FROM lineitem WHERE l_shipdate >= '2000-01-01' AND l_shipdate < '2000-03-31'""",
    "new_watermark": """
        SELECT 'orders_documento' AS entity_name, MAX(issued_at) AS last_successful_value FROM fct_orders
        WHERE issued_at >= TIMESTAMP '2001-01-01'""",
    "high_water_increment": """
        SELECT * FROM mart_operator_productivity
        WHERE period_date > (SELECT MAX(period_date) FROM mart_operator_productivity WHERE period_date < TIMESTAMP '2024-01-21')""",
    "test_volume": """
        WITH daily AS (SELECT CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1),
        span AS (SELECT CAST(UNNEST(generate_series((SELECT MIN(day) FROM daily), (SELECT MAX(day) FROM daily), INTERVAL 1 DAY)) AS DATE) AS day),
        counted AS (SELECT day, COALESCE(n, 0) AS row_count FROM span LEFT JOIN daily USING (day)),
        seen AS (SELECT *, COALESCE(LIST(row_count) OVER (PARTITION BY isodow(day) ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), []) AS l FROM counted),
        mid AS (SELECT *, list_aggregate(l, 'median') AS expected FROM seen),
        judged AS (SELECT *, list_aggregate(list_transform(l, lambda x: abs(x - expected)), 'median') AS spread FROM mid),
        bounds AS (SELECT *, 3.5 * greatest(spread * 1.4826, expected * 0.05, 1.0) AS most FROM judged)
        SELECT day, row_count, expected, spread,
            CASE WHEN len(l) < 4 THEN 'NEW' WHEN row_count - expected < -most THEN 'LOW' WHEN row_count - expected > most THEN 'HIGH' ELSE 'OK' END AS status
        FROM bounds""",
    "distinct_products_by_month": """
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, COUNT(DISTINCT l_partkey) AS exact, TRUE AS "within"
        FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""",
    "append_new": """
        SELECT order_id, issued_at FROM fct_orders WHERE issued_at >= TIMESTAMP '2000-01-01'""",
    "normalise_values": """
        SELECT order_id AS sequenciaintegracao, issued_at AS dataemissao, delivered_at AS dataentrega,
               CAST(CAST(issued_at AS DATE) AS TIMESTAMP) AS dia, total_value AS valortotaldocumento FROM fct_orders""",
    "mask_columns": """
        SELECT c_custkey, '***' AS "EMAIL", c_mktsegment AS segment,
               CASE WHEN c_nationkey % 2 = 0 THEN '***' END AS document_number FROM customer""",
    "bronze_envelope": """
        SELECT 'customers' AS entity_name, TIMESTAMP '2001-08-01' AS extraction_timestamp,
               'oracle_wms' AS source_system, 'CLIENTE' AS source_table, 'run-1' AS ingestion_run_id,
               '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}'
                 AS payload, DATE '2001-08-01' AS extraction_date
        FROM customer""",
    "evolve_schema": """
        SELECT order_id, issued_at, CASE WHEN issued_at >= TIMESTAMP '2000-01-01' THEN document_type END
          AS document_type
        FROM fct_orders""",
    # enrichment
    "geo_enrich": """
        SELECT 'warehouse' AS entity_type, CAST(s_suppkey AS VARCHAR) AS entity_id,
               lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cep,
               CASE WHEN s_suppkey % 4 <> 0 THEN 'Rua ' || s_suppkey END AS logradouro, 'Centro' AS bairro,
               n_name AS localidade, CASE WHEN s_suppkey % 7 = 6 THEN 'XX' ELSE """ + UFS + """[n_nationkey + 1] END AS uf,
               estado, regiao, """ + UF_CODES + """[n_nationkey + 1] || '00000' AS ibge_code,
               CAST(lat AS DECIMAL(10,6)) AS latitude, CAST(lon AS DECIMAL(11,6)) AS longitude
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        LEFT JOIN states ON states.uf = CASE WHEN s_suppkey % 7 = 6 THEN 'XX' ELSE """ + UFS + """[n_nationkey + 1] END
        WHERE s_suppkey % 13 <> 12 AND s_suppkey % 10 <> 9""",
    "state_of_ibge_code": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS entity_id, {UFS}[s_nationkey + 1] AS uf FROM supplier""",
    "weather_explode": f"""
        SELECT location_uf, weather_date, avg_temperature_c, min_temperature_c, max_temperature_c, precipitation_mm,
               wind_speed_kmh, weather_code, {LABELS} AS weather_condition
        FROM weather_days""",
    "weather_requests": """
        SELECT DISTINCT g.uf AS location_uf, lat, lon, DATE '2001-07-02' AS start_date, DATE '2001-07-31' AS end_date
        FROM geo g JOIN states s ON s.uf = g.uf""",
    # documents and vectors
    "chunk_documents": "SELECT doc_id, chunk_no, content FROM chunks",
    "index_documents": """
        SELECT md5(source || '#' || chunk_no) AS point_id, *
        FROM (SELECT CASE WHEN doc_id % 4 = 0 THEN 'adr' WHEN doc_id % 4 = 1 THEN 'runbook'
                    WHEN doc_id % 4 = 2 THEN 'architecture' ELSE 'doc' END AS doc_type,
               CASE WHEN doc_id % 4 = 2 THEN 'System Architecture ' ELSE 'Note ' END || doc_id AS title,
               'docs/' || CASE WHEN doc_id % 4 = 0 THEN 'adr/note-' WHEN doc_id % 4 = 1 THEN 'runbook/note-'
                    WHEN doc_id % 4 = 2 THEN 'system-architecture-' ELSE 'runbooks/note-' END || doc_id || '.md'
                 AS source,
               chunk_no, content
        FROM chunks)""",
    "cosine_topk": """
        SELECT vec_id, label, ROUND(list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))), 6)
                 AS score
        FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
                     (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1) AS q FROM embeddings)
        ORDER BY list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))) DESC, vec_id
        LIMIT 5""",
    "cosine_search": """
        WITH v AS (SELECT vec_id, source, lang, CAST(embedding AS DOUBLE[]) AS e FROM embeddings JOIN documents ON vec_id = doc_id),
        pairs AS (SELECT q.vec_id AS query_id, v.vec_id, v.source, v.lang,
                         list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))) AS score
                  FROM v JOIN v q ON q.vec_id % 10 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, source, lang, ROUND(score, 6) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""",
    "cosine_index_recall": """
        WITH q AS (SELECT COUNT(*) AS n FROM embeddings WHERE vec_id % 10 = 0), v AS (SELECT COUNT(*) AS n FROM embeddings)
        SELECT q.n AS questions, q.n * LEAST(5, v.n) AS neighbours, TRUE AS enough FROM q, v""",
    # stored tables
    "overlap_load": """
        WITH first AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-12-30' AND o_orderdate < TIMESTAMP '2000-01-01'),
        loaded AS (SELECT o_orderkey FROM first UNION ALL
                   SELECT o_orderkey FROM orders WHERE o_orderdate >= COALESCE((SELECT MAX(o_orderdate) FROM first), TIMESTAMP '1999-12-30'))
        SELECT CAST(o_orderkey AS VARCHAR) AS sequenciaintegracao, COUNT(*) AS times FROM loaded GROUP BY 1""",
    "checkpoint_rules": """
        WITH a AS (SELECT MAX(o_orderdate) AS m FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
        b AS (SELECT MAX(o_orderdate) AS m FROM orders)
        SELECT 'load' AS step, m AS last_value FROM a UNION ALL SELECT 'too few rows', m FROM a UNION ALL SELECT 'replay', m FROM a
        UNION ALL SELECT 'next load', m FROM b UNION ALL SELECT 'reset', NULL""",
    "snapshot_load": """
        SELECT CAST(p_partkey AS VARCHAR) AS codigoproduto, p_name AS descricaoproduto FROM part WHERE p_partkey % 2 = 0""",
    "upsert_places": """
        SELECT 'warehouse' AS entity_type, CAST(s_suppkey AS VARCHAR) AS entity_id,
               CASE WHEN s_suppkey % 7 = 6 THEN 'XX' ELSE """ + UFS + """[s_nationkey + 1] END AS uf,
               CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2001-08-01' ELSE TIMESTAMP '2000-01-01' END AS _enriched_at
        FROM supplier WHERE s_suppkey % 13 <> 12 AND s_suppkey % 10 <> 9""",
    "upsert_weather": """
        SELECT location_uf, weather_date, max_temperature_c, TIMESTAMP '2001-08-01' AS _enriched_at FROM weather_days""",
    "full_refresh": """
        SELECT * FROM mart_operator_productivity WHERE period_date >= TIMESTAMP '2024-01-10'""",
    "stored_increment": "SELECT * FROM mart_operator_productivity",
    "fact_by_loads": "SELECT * FROM fct_orders",
    "optional_source": """
        SELECT warehouse_id, company_id, product_class, CAST(NULL AS VARCHAR) AS cidade, CAST(NULL AS VARCHAR) AS uf
        FROM mart_geo_inventory""",
    "stored_failures": "SELECT order_id, issued_at FROM fct_orders WHERE delivered_at IS NULL",
    "stored_counts": """
        SELECT 'fct_orders' AS table_name, COUNT(*) AS row_count FROM fct_orders UNION ALL
        SELECT 'fct_movements', COUNT(*) FROM fct_movements""",
    "bronze_by_day": "SELECT c_custkey, c_name, c_acctbal, c_nationkey FROM customer WHERE c_custkey % 2 = 1",
    "appended_columns": """
        SELECT order_id, issued_at, CASE WHEN issued_at >= TIMESTAMP '2000-01-01' THEN document_type END AS document_type FROM fct_orders""",
    "time_zone_rule": """
        SELECT o_orderkey, o_orderdate AS plain, o_orderdate - INTERVAL 2 HOUR AS zoned FROM orders""",
}


def oracle_sql() -> dict[str, str]:
    return {name: query(text) for name, text in SQL.items()}
