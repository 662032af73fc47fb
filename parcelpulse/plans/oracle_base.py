"""DuckDB SQL of the canonical logs and layers, to check the Spark results against.

Written from the binding rules and the definitions of the layers; each entry is the
body of a CTE, and ``with_layers`` prepends those a query needs.
"""

from __future__ import annotations

import re

HIGH_SEASON = "substr(year_month, 6, 2) IN ('06', '10', '11', '12') AND year_month < '2002-01'"
MIN_DATE = "TIMESTAMP '1995-02-01'"


def hours(a: str, b: str) -> str:
    return f"(date_diff('microsecond', {a}, {b}) / 3600000000.0)"


LAYERS: dict[str, str] = {}

LAYERS["base_orders"] = """
    SELECT *, t0 + to_hours(CASE WHEN o_orderkey % 29 = 0 THEN -10 WHEN o_orderpriority LIKE '1%' THEN 200
                            WHEN o_orderpriority LIKE '2%' THEN 260 WHEN o_orderpriority LIKE '3%' THEN 330
                            WHEN o_orderpriority LIKE '4%' THEN 370 ELSE 420 END) AS promise
    FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                 o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t0,
                 strftime(o_orderdate, '%Y-%m') AS year_month,
                 CASE WHEN o_custkey % 50 = 0 THEN 'PE' ELSE 'CL' END AS country
          FROM orders)
"""

LAYERS["base_lines"] = """
    SELECT b.*, l.*,
           t0 + to_hours(CAST(1 + (7 * l_partkey) % 48 AS INTEGER)) AS packed_ts,
           t0 + to_hours(CAST(49 + (13 * l_suppkey + l_partkey) % 96 AS INTEGER)) AS sent_ts,
           t0 + to_hours(CAST(145 + 5 * l_quantity AS INTEGER)) AS done_ts
    FROM base_orders b JOIN lineitem l ON l.l_orderkey = b.o_orderkey
"""

LAYERS["log"] = """
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FULFILMENT_ORDER_CREATED' AS event_type, 'NEW' AS state, t0 AS ts,
           'c' || (o_custkey % 7) AS actor, 0 AS version FROM base_orders
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FULFILMENT_ORDER_ITEM_QUANTITY_PACKED', 'PROCESSING', packed_ts,
           'w' || (l_suppkey % 5), l_linenumber FROM base_lines WHERE l_returnflag <> 'R'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FULFILMENT_ORDER_PACKAGES_DISPATCHED', 'PROCESSING', sent_ts,
           's' || (l_suppkey % 5), l_linenumber FROM base_lines WHERE l_returnflag <> 'R'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FULFILMENT_ORDER_ITEM_QUANTITY_DISPATCHED', 'PROCESSING', sent_ts + INTERVAL 1 HOUR,
           's' || (l_suppkey % 5), l_linenumber FROM base_lines WHERE l_returnflag <> 'R'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FULFILMENT_ORDER_ITEM_QUANTITY_STATE_CHANGED', 'COMPLETED', done_ts,
           'd' || (l_partkey % 9), l_linenumber FROM base_lines
    WHERE l_returnflag <> 'R' AND o_orderstatus <> 'O'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, country, year_month,
           'FO_ITEMS_ANNULLED', 'CANCELLED', t0 + INTERVAL 12 HOUR,
           'a' || (l_suppkey % 3), l_linenumber FROM base_lines
    WHERE l_returnflag = 'R' AND l_linenumber = 1 AND o_orderstatus = 'O'
"""

LAYERS["stg_events"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, 'so-' || o_orderkey AS source_order_id,
           CAST(o_orderkey AS VARCHAR) AS d_logistic_order_id, event_type,
           'FULFILMENT_ORDER' AS entity_type, country, 'C' || (o_custkey % 4) AS commerce,
           ts AS event_at, CASE WHEN o_orderkey % 53 <> 0 THEN ts END AS executed_at,
           ts + INTERVAL 5 MINUTE AS published_at, state AS order_state, actor AS executed_by,
           'FT' || (o_custkey % 3) AS fulfillment_order_type, o_orderstatus AS source_order_type,
           o_custkey % 11 = 0 AS is_international, CAST(version AS INTEGER) AS order_version, year_month
    FROM log WHERE country = 'CL' AND ts >= {MIN_DATE}
"""

LAYERS["stg_packages"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, 'sh-' || o_orderkey AS shipment_id,
           o_orderkey || '-' || l_linenumber AS package_id,
           'FULFILMENT_ORDER_PACKAGES_DISPATCHED' AS event_type, sent_ts AS event_at, country,
           'SHIPMENT_CONFIRMED' AS package_status,
           CASE WHEN o_orderkey % 17 = 0 THEN 'por confirmar' ELSE strftime(promise, '%Y-%m-%d %H:%M:%S') END
               AS promised_date_to,
           strftime(promise - INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS promised_date_from,
           o_orderpriority AS service_category, '09:00' AS promised_time_from, '21:00' AS promised_time_to,
           CASE WHEN o_custkey % 10 = 0 THEN strftime(promise, '%Y-%m-%d %H:%M:%S') END
               AS collect_availability_date,
           o_custkey % 10 = 0 AS is_click_and_collect, year_month
    FROM base_lines WHERE l_returnflag <> 'R' AND country = 'CL' AND sent_ts >= {MIN_DATE}
"""

LAYERS["stg_items"] = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, 'FULFILMENT_ORDER_CREATED' AS event_type,
           t0 AS event_at, country, CAST(l_partkey AS VARCHAR) AS sku, CAST(l_suppkey AS VARCHAR) AS seller_id,
           l_quantity AS quantity_number, 'UN' AS quantity_unit,
           round(l_discount * 100, 0) AS reserved_quantity, l_tax > 0.04 AS has_insurance, year_month
    FROM base_lines WHERE country = 'CL' AND t0 >= {MIN_DATE}
"""

LAYERS["promise"] = """
    SELECT logistic_order_id, min(TRY_CAST(promised_date_to AS TIMESTAMP)) AS promised_date_to,
           min(TRY_CAST(promised_date_from AS TIMESTAMP)) AS promised_date_from,
           max(service_category) AS service_category, bool_or(is_click_and_collect) AS is_click_and_collect
    FROM stg_packages WHERE event_type = 'FULFILMENT_ORDER_PACKAGES_DISPATCHED' GROUP BY ALL
"""


def _stone(name: str, test: str, fn: str, actor: bool = True) -> str:
    at = f"{fn}(event_at) FILTER (WHERE {test}) AS {name}_at"
    return at + (f", max(executed_by) FILTER (WHERE {test}) AS {name}_by" if actor else "")


LAYERS["stones"] = f"""
    SELECT logistic_order_id, source_order_type, fulfillment_order_type, year_month,
           {_stone('created', "event_type = 'FULFILMENT_ORDER_CREATED'", 'min')},
           {_stone('packed', "event_type = 'FULFILMENT_ORDER_ITEM_QUANTITY_PACKED'", 'min')},
           {_stone('dispatched', "event_type = 'FULFILMENT_ORDER_PACKAGES_DISPATCHED'", 'min')},
           {_stone('item_dispatched', "event_type = 'FULFILMENT_ORDER_ITEM_QUANTITY_DISPATCHED'", 'min', False)},
           {_stone('completed', "order_state = 'COMPLETED'", 'max')},
           {_stone('cancelled', "event_type = 'FO_ITEMS_ANNULLED'", 'max')},
           max(event_at) AS last_event_at, max(order_state) AS last_state,
           arg_max(order_state, (event_at, order_state)) AS last_state_in_time,
           count(*) AS total_events, count(DISTINCT executed_by) AS total_actors,
           count(DISTINCT event_type) AS total_event_types
    FROM stg_events GROUP BY 1, 2, 3, 4
"""

LAYERS["timeline"] = f"""
    SELECT s.* EXCLUDE (total_events, total_actors, total_event_types),
           p.* EXCLUDE (logistic_order_id),
           completed_at IS NOT NULL AS is_completed, cancelled_at IS NOT NULL AS is_cancelled,
           dispatched_at IS NOT NULL AS is_dispatched, packed_at IS NOT NULL AS is_packed,
           created_at IS NOT NULL AND coalesce(dispatched_at, cancelled_at, completed_at) IS NULL AS is_stuck,
           {hours('created_at', 'packed_at')} AS hours_created_to_packed,
           {hours('packed_at', 'dispatched_at')} AS hours_packed_to_dispatched,
           {hours('dispatched_at', 'completed_at')} AS hours_dispatched_to_completed,
           {hours('created_at', 'completed_at')} AS hours_total_cycle,
           completed_at > promised_date_to AS is_sla_breach,
           {hours('promised_date_to', 'completed_at')} AS hours_sla_delta,
           {HIGH_SEASON} AS is_high_season,
           total_events, total_actors, total_event_types
    FROM stones s LEFT JOIN promise p ON p.logistic_order_id = s.logistic_order_id
"""


def _q(column: str, name: str, probs: tuple[int, ...]) -> str:
    return ", ".join(f"quantile_cont({column}, {p / 100}) AS p{p}_{name}" for p in probs)


LAYERS["baselines"] = f"""
    SELECT year_month,
           {_q('hours_created_to_packed', 'deposito', (50, 75, 90, 95))},
           {_q('hours_packed_to_dispatched', 'despacho', (50, 75, 90, 95))},
           {_q('hours_dispatched_to_completed', 'ultima_milla', (50, 75, 90, 95))},
           {_q('hours_total_cycle', 'total', (50, 90, 95))},
           round(100.0 * CAST(count(*) FILTER (WHERE is_sla_breach) AS DOUBLE) / count(*), 2) AS pct_sla_breach,
           count(*) AS ordenes_base
    FROM timeline
    WHERE is_completed AND NOT is_high_season AND hours_total_cycle BETWEEN 0 AND 720
      AND hours_created_to_packed IS NOT NULL
    GROUP BY year_month
"""

LAYERS["item_modes"] = """
    SELECT t.*, s.seller_id AS main_seller_id, k.sku AS main_sku
    FROM (SELECT logistic_order_id, sum(quantity_number) AS total_items, bool_or(has_insurance) AS has_insurance,
                 count(DISTINCT sku) AS distinct_skus FROM stg_items GROUP BY 1) t
    JOIN (SELECT logistic_order_id, seller_id FROM stg_items GROUP BY 1, 2
          QUALIFY row_number() OVER (PARTITION BY logistic_order_id ORDER BY count(*) DESC, seller_id) = 1) s
      USING (logistic_order_id)
    JOIN (SELECT logistic_order_id, sku FROM stg_items GROUP BY 1, 2
          QUALIFY row_number() OVER (PARTITION BY logistic_order_id ORDER BY count(*) DESC, sku) = 1) k
      USING (logistic_order_id)
"""

LAYERS["judged"] = """
    SELECT t.*, p95_deposito, p95_despacho, p95_ultima_milla,
           CASE WHEN hours_created_to_packed > p95_deposito
                     AND hours_created_to_packed >= greatest(coalesce(hours_packed_to_dispatched, 0),
                                                             coalesce(hours_dispatched_to_completed, 0))
                THEN 1
                WHEN hours_packed_to_dispatched > p95_despacho
                     AND hours_packed_to_dispatched >= greatest(coalesce(hours_created_to_packed, 0),
                                                                coalesce(hours_dispatched_to_completed, 0))
                THEN 2
                WHEN hours_dispatched_to_completed > p95_ultima_milla THEN 3 ELSE 0 END AS leg_no
    FROM timeline t LEFT JOIN baselines b ON b.year_month = t.year_month
"""

LAYERS["fact"] = """
    SELECT j.logistic_order_id, source_order_type, fulfillment_order_type, year_month, service_category,
           is_click_and_collect, is_high_season, created_by, packed_by, dispatched_by, completed_by, cancelled_by,
           created_at, packed_at, dispatched_at, completed_at, cancelled_at, last_event_at, last_state,
           promised_date_to, promised_date_from, is_completed, is_cancelled, is_dispatched, is_packed, is_stuck,
           is_sla_breach, hours_sla_delta,
           round(hours_created_to_packed, 2) AS hours_deposito,
           round(hours_packed_to_dispatched, 2) AS hours_despacho,
           round(hours_dispatched_to_completed, 2) AS hours_ultima_milla,
           round(hours_total_cycle, 2) AS hours_total,
           round(hours_created_to_packed - p95_deposito, 2) AS delta_deposito_vs_p95,
           round(hours_packed_to_dispatched - p95_despacho, 2) AS delta_despacho_vs_p95,
           round(hours_dispatched_to_completed - p95_ultima_milla, 2) AS delta_ultima_milla_vs_p95,
           CASE leg_no WHEN 1 THEN 'deposito' WHEN 2 THEN 'despacho' WHEN 3 THEN 'ultima_milla'
                       ELSE 'sin_disrupcion' END AS tramo_disruptivo,
           CASE leg_no WHEN 1 THEN packed_by WHEN 2 THEN dispatched_by WHEN 3 THEN completed_by END
               AS actor_responsable,
           (is_stuck OR is_sla_breach IS TRUE OR (hours_created_to_packed > p95_deposito) IS TRUE
               OR (hours_packed_to_dispatched > p95_despacho) IS TRUE
               OR (hours_dispatched_to_completed > p95_ultima_milla) IS TRUE) AS is_disrupted,
           total_events, total_actors, total_event_types,
           main_seller_id AS seller_id, main_sku, total_items, distinct_skus, has_insurance
    FROM judged j LEFT JOIN item_modes i ON i.logistic_order_id = j.logistic_order_id
"""

LAYERS["disruptions"] = """
    SELECT logistic_order_id, year_month, source_order_type, service_category, is_high_season,
           tramo_disruptivo, actor_responsable,
           CASE WHEN is_stuck THEN 'orden_atascada' WHEN is_sla_breach THEN 'sla_breach'
                WHEN tramo_disruptivo <> 'sin_disrupcion' THEN 'demora_' || tramo_disruptivo
                ELSE 'otro' END AS tipo_disrupcion,
           ['media', 'alta', 'critica'][sev] AS severidad, CAST(sev AS INTEGER) AS severity_rank,
           hours_deposito, hours_despacho, hours_ultima_milla, hours_total, hours_sla_delta,
           delta_deposito_vs_p95, delta_despacho_vs_p95, delta_ultima_milla_vs_p95,
           created_at, dispatched_at, completed_at, promised_date_to, seller_id, main_sku, total_items,
           is_completed, is_cancelled, is_stuck, is_sla_breach
    FROM (SELECT *, CASE WHEN is_stuck THEN 3
                         WHEN is_sla_breach THEN CASE WHEN hours_sla_delta > 48 THEN 2 ELSE 1 END
                         WHEN greatest(coalesce(delta_deposito_vs_p95, 0), coalesce(delta_despacho_vs_p95, 0),
                                       coalesce(delta_ultima_milla_vs_p95, 0)) > 48 THEN 2
                         ELSE 1 END AS sev
          FROM fact WHERE is_disrupted)
"""


# --- package status log ---

LAYERS["status_log"] = """
    SELECT CAST(user_id AS VARCHAR) AS logistic_order_id, 'sh-' || user_id AS shipment_id,
           CASE WHEN event_id % 97 <> 0 THEN user_id || '-' || (event_id % 3) END AS package_id,
           event_type, ts AS event_dt,
           CASE event_type WHEN 'signup' THEN 'SHIPMENT_CONFIRMED' WHEN 'view' THEN 'IN_TRANSIT'
                WHEN 'click' THEN 'OUT_FOR_DELIVERY' WHEN 'error' THEN 'DELIVERY_ATTEMPTED'
                WHEN 'purchase' THEN 'EXCEPTION' END AS package_status,
           props AS promised_date, strftime(ts, '%Y-%m') AS year_month, event_id
    FROM events
"""

LAYERS["gaps"] = f"""
    SELECT *, {hours('lag(event_dt) OVER (PARTITION BY logistic_order_id ORDER BY event_dt, event_id)', 'event_dt')} AS gap,
           first_value(event_dt) OVER (PARTITION BY logistic_order_id ORDER BY event_dt, event_id) AS t0
    FROM status_log
"""


def _flow(prefix: str = "") -> str:
    """Flow features over the rows of a group of ``gaps``."""
    reached = ", ".join(
        f"coalesce(min({hours('t0', prefix + 'event_dt')}) FILTER (WHERE {prefix}package_status = '{s}'), -1.0) AS {n}"
        for n, s in (("horas_a_shipment_confirmed", "SHIPMENT_CONFIRMED"), ("horas_a_out_for_delivery", "OUT_FOR_DELIVERY"))
    )
    last = f"arg_max({prefix}package_status, ({prefix}event_dt, {prefix}event_id))"
    ever = ", ".join(
        f"CAST(coalesce(bool_or({prefix}package_status = '{s}'), false) AS INTEGER) AS {n}"
        for n, s in (("tuvo_delivery_attempted", "DELIVERY_ATTEMPTED"), ("tuvo_exception", "EXCEPTION"),
                     ("tuvo_annulled", "ANNULLED"))
    )
    now = ", ".join(
        f"CAST({last} = '{s}' AS INTEGER) AS {n}"
        for n, s in (("esta_en_transito", "IN_TRANSIT"), ("esta_out_for_delivery", "OUT_FOR_DELIVERY"),
                     ("esta_shipment_confirmed", "SHIPMENT_CONFIRMED"))
    )
    return f"""{reached}, coalesce(max({prefix}gap), 0.0) AS horas_entre_eventos_max,
           CASE WHEN count(*) > 1 THEN {hours(f'min({prefix}event_dt)', f'max({prefix}event_dt)')} / (count(*) - 1)
                ELSE 0.0 END AS horas_entre_eventos_avg, count(*) AS n_eventos_total,
           count(DISTINCT {prefix}package_status) AS n_estados_distintos, {ever}, {now}, {last} AS ultimo_estado"""


LAYERS["flows"] = f"SELECT logistic_order_id, {_flow()} FROM gaps GROUP BY 1"

# --- carriers, from the columns rather than from the JSON ---

LAYERS["carrier_rows"] = """
    SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, l_linenumber AS n1, l_partkey AS n2, l_suppkey AS n3,
           'S' || (l_suppkey % 6) AS carrier_code,
           CASE WHEN l_partkey % 4 <> 0 THEN 'Carrier ' || (l_suppkey % 6) ELSE 'S' || (l_suppkey % 6) END AS carrier_name,
           year_month
    FROM base_lines
    WHERE l_linestatus = 'F' AND country = 'CL' AND l_linenumber <> 1 AND l_partkey % 101 <> 0
"""

LAYERS["carrier_counts"] = """
    SELECT logistic_order_id, carrier_code, count(*) AS n, min((n1, n2, n3, carrier_code, carrier_name)) AS first_seen,
           arg_min(carrier_name, (n1, n2, n3, carrier_code, carrier_name)) AS carrier_name, min(year_month) AS year_month
    FROM carrier_rows GROUP BY 1, 2
"""

LAYERS["order_carriers"] = """
    SELECT logistic_order_id, arg_min(carrier_code, (-n, first_seen)) AS carrier_code,
           arg_min(carrier_name, (-n, first_seen)) AS carrier_name, min(year_month) AS year_month,
           CAST(sum(n) AS BIGINT) AS n_envelopes
    FROM carrier_counts GROUP BY 1
"""

# --- feature tables ---

LAYERS["ml"] = f"""
    SELECT logistic_order_id, year_month,
           CASE WHEN year_month < '2000-01' THEN 'train' WHEN year_month < '2001-01' THEN 'val' ELSE 'test' END AS split_set,
           CAST(is_click_and_collect AS INTEGER) AS is_click_and_collect,
           CAST(is_high_season AS INTEGER) AS is_high_season, CAST(has_insurance AS INTEGER) AS has_insurance,
           total_items, distinct_skus, dayofweek(created_at) AS dia_semana_creacion,
           hour(created_at) AS hora_creacion, day(created_at) AS dia_mes_creacion,
           {hours('created_at', 'promised_date_to')} AS sla_horas_prometidas,
           service_category, source_order_type, seller_id, created_by,
           CASE WHEN hour(created_at) BETWEEN 6 AND 11 THEN 'manana' WHEN hour(created_at) BETWEEN 12 AND 19 THEN 'tarde'
                WHEN created_at IS NOT NULL THEN 'madrugada' END AS franja_horaria,
           CAST(is_disrupted AS INTEGER) AS target_binario, tramo_disruptivo AS target_tramo,
           actor_responsable AS target_actor, hours_total AS target_horas_totales,
           CAST(hours_total IS NOT NULL AS INTEGER) AS ciclo_completo
    FROM fact
"""


def _rate(name: str, keys: str, extra: str = "") -> None:
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    LAYERS[name] = f"""
    SELECT {keys}, {extra} avg(target_binario) AS rate FROM ml WHERE split_set = 'train' AND {present} GROUP BY {keys}
"""


_rate("rate_seller", "seller_id", "count(*) AS volume,")
_rate("rate_category", "service_category")
_rate("rate_category_cac", "service_category, is_click_and_collect")
_rate("rate_day", "dia_semana_creacion")
_rate("rate_band", "franja_horaria")

LAYERS["hist"] = """
    SELECT m.logistic_order_id, m.year_month, s.volume AS seller_n_ordenes, m.franja_horaria,
           s.rate AS seller_tasa_disrupcion, c.rate AS categoria_tasa_disrupcion,
           cc.rate AS categoria_cac_tasa_disrupcion, d.rate AS dia_semana_tasa_disrupcion,
           b.rate AS franja_tasa_disrupcion
    FROM ml m
    LEFT JOIN rate_seller s ON s.seller_id = m.seller_id
    LEFT JOIN rate_category c ON c.service_category = m.service_category
    LEFT JOIN rate_category_cac cc ON cc.service_category = m.service_category
         AND cc.is_click_and_collect = m.is_click_and_collect
    LEFT JOIN rate_day d ON d.dia_semana_creacion = m.dia_semana_creacion
    LEFT JOIN rate_band b ON b.franja_horaria = m.franja_horaria
"""

LAYERS["pop"] = """
    SELECT *, CASE target_binario WHEN 0 THEN 'OK' WHEN 1 THEN 'DISRUPTED' END AS clase,
           coalesce(service_category, '(NULL)') AS category, target_horas_totales - sla_horas_prometidas AS desvio
    FROM ml WHERE ciclo_completo = 1 AND target_horas_totales > 0
"""

LAYERS["sampled"] = """
    SELECT logistic_order_id, clase, target_horas_totales FROM pop
    QUALIFY row_number() OVER (PARTITION BY clase ORDER BY md5('42:' || logistic_order_id), logistic_order_id) <= 1000
"""

LAYERS["requests"] = """
    SELECT m.logistic_order_id AS pedido,
           CASE WHEN CAST(m.logistic_order_id AS BIGINT) % 7 = 0 THEN 'nuevo-' || m.seller_id ELSE m.seller_id END AS seller_id,
           CASE WHEN CAST(m.logistic_order_id AS BIGINT) % 35 = 0 THEN 'CATEGORIA NUEVA' ELSE m.service_category END
               AS service_category,
           f.created_at, m.sla_horas_prometidas AS sla_horas
    FROM ml m JOIN fact f ON f.logistic_order_id = m.logistic_order_id AND f.year_month = m.year_month
    WHERE m.split_set = 'test'
"""

LAYERS["hist_rows"] = """
    SELECT m.seller_id, m.service_category, h.seller_tasa_disrupcion AS seller_tasa, h.categoria_tasa_disrupcion AS cat_tasa,
           h.categoria_cac_tasa_disrupcion AS cat_cac_tasa, h.dia_semana_tasa_disrupcion AS dia_tasa,
           h.franja_tasa_disrupcion AS franja_tasa, h.seller_n_ordenes
    FROM ml m JOIN hist h ON h.logistic_order_id = m.logistic_order_id AND h.year_month = m.year_month
"""

LAYERS["hist_pair"] = """
    SELECT seller_id, service_category, count(*) AS n, avg(seller_tasa) AS seller_tasa, avg(cat_tasa) AS cat_tasa,
           avg(cat_cac_tasa) AS cat_cac_tasa, avg(dia_tasa) AS dia_tasa, avg(franja_tasa) AS franja_tasa,
           max(seller_n_ordenes) AS seller_n
    FROM hist_rows WHERE seller_id IS NOT NULL GROUP BY 1, 2
"""

LAYERS["hist_category"] = """
    SELECT service_category, count(*) AS n, avg(cat_tasa) AS cat_tasa, avg(cat_cac_tasa) AS cat_cac_tasa
    FROM hist_rows GROUP BY 1
"""

LAYERS["looked_up"] = """
    SELECT r.*, CASE WHEN p.n IS NOT NULL THEN 'seller+category' WHEN c.n IS NOT NULL THEN 'category' ELSE 'global' END AS fuente,
           coalesce(p.n, c.n, 0) AS n_ordenes,
           round(CASE WHEN p.n IS NOT NULL THEN coalesce(p.seller_tasa, 0.4) WHEN c.n IS NOT NULL THEN 0.4 ELSE 0.39 END, 6)
               AS seller_tasa,
           round(CASE WHEN p.n IS NOT NULL THEN coalesce(p.cat_tasa, 0.4) WHEN c.n IS NOT NULL THEN coalesce(c.cat_tasa, 0.4)
                      ELSE 0.39 END, 6) AS cat_tasa,
           round(CASE WHEN p.n IS NOT NULL THEN coalesce(p.cat_cac_tasa, 0.4)
                      WHEN c.n IS NOT NULL THEN coalesce(c.cat_cac_tasa, 0.4) ELSE 0.39 END, 6) AS cat_cac_tasa,
           round(CASE WHEN p.n IS NOT NULL THEN coalesce(p.dia_tasa, 0.4) ELSE 0.42 END, 6) AS dia_tasa,
           round(CASE WHEN p.n IS NOT NULL THEN coalesce(p.franja_tasa, 0.4) ELSE 0.4 END, 6) AS franja_tasa,
           coalesce(p.seller_n, 0) AS seller_n_ordenes
    FROM requests r
    LEFT JOIN hist_pair p ON p.seller_id = r.seller_id AND p.service_category = r.service_category
    LEFT JOIN hist_category c ON c.service_category = r.service_category
"""

LAYERS["broken_pair"] = """
    SELECT seller_id, service_category, tramo_disruptivo, actor_responsable, count(*) AS n
    FROM disruptions WHERE tramo_disruptivo <> 'sin_disrupcion' GROUP BY ALL
"""

LAYERS["broken_category"] = """
    SELECT service_category, tramo_disruptivo, actor_responsable, count(*) AS n
    FROM disruptions WHERE tramo_disruptivo <> 'sin_disrupcion' GROUP BY ALL
"""

# --- predictions without a model ---

LAYERS["scored"] = """
    SELECT *, CAST(p1 >= 500 AS INTEGER) AS pred, CAST(p2 >= 500 AS INTEGER) AS pred2, p1 / 1000.0 AS prob,
           CAST((p1 >= 500) = (target = 1) AS INTEGER) AS hit
    FROM (SELECT logistic_order_id, split_set, service_category, target_binario AS target,
                 (CAST(logistic_order_id AS BIGINT) * 7919) % 1000 AS p1,
                 (CAST(logistic_order_id AS BIGINT) * 104729) % 1000 AS p2,
                 target_horas_totales AS horas,
                 CASE WHEN CAST(logistic_order_id AS BIGINT) % 101 = 0 THEN CAST('nan' AS DOUBLE)
                      ELSE target_horas_totales + (CAST(logistic_order_id AS BIGINT) % 97 - 48) END AS horas_pred
          FROM ml)
"""


def _class_layers(suffix: str, pred: str) -> None:
    LAYERS[f"class_sums{suffix}"] = f"""
    SELECT split_set, c.clase, count(*) FILTER (WHERE target = c.clase AND {pred} = c.clase) AS tp,
           count(*) FILTER (WHERE target = c.clase) AS support, count(*) FILTER (WHERE {pred} = c.clase) AS predicted
    FROM scored, (VALUES (0), (1)) c(clase) GROUP BY 1, 2
"""
    LAYERS[f"class_prf{suffix}"] = f"""
    SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f
    FROM (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
                 CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM class_sums{suffix})
"""


_class_layers("", "pred")
_class_layers("2", "pred2")


def _auc_layer(name: str, score: str) -> None:
    LAYERS[name] = f"""
    SELECT split_set, any_value(np) AS n_pos, any_value(nn) AS n_neg,
           (sum(rk) FILTER (WHERE target = 1) - any_value(np) * (any_value(np) + 1) / 2.0)
               / (any_value(np) * any_value(nn)) AS auc
    FROM (SELECT split_set, target,
                 rank() OVER (PARTITION BY split_set ORDER BY {score})
                     + (count(*) OVER (PARTITION BY split_set, {score}) - 1) / 2.0 AS rk,
                 count(*) FILTER (WHERE target = 1) OVER (PARTITION BY split_set) AS np,
                 count(*) FILTER (WHERE target = 0) OVER (PARTITION BY split_set) AS nn
          FROM scored) GROUP BY 1
"""


_auc_layer("auc1", "p1")
_auc_layer("auc2", "p2")

# --- replay ---

LAYERS["stones_of_status"] = f"""
    SELECT *, {hours('lag(event_dt) OVER (PARTITION BY logistic_order_id ORDER BY event_dt, tie)', 'event_dt')} AS since,
           row_number() OVER (PARTITION BY logistic_order_id ORDER BY event_dt, tie) AS n_hito
    FROM (SELECT *, lag(package_status) OVER (PARTITION BY logistic_order_id ORDER BY event_dt, tie) AS prev
          FROM (SELECT logistic_order_id, event_dt, package_status, min(event_id) AS tie FROM status_log GROUP BY 1, 2, 3))
    WHERE package_status IS DISTINCT FROM prev
"""

LAYERS["prefixes"] = f"""
    SELECT m.logistic_order_id, m.n_hito, any_value(m.event_dt) AS event_dt, any_value(m.package_status) AS package_status,
           any_value(m.since) AS since, {_flow('g.')}
    FROM stones_of_status m JOIN gaps g ON g.logistic_order_id = m.logistic_order_id AND g.event_dt <= m.event_dt
    GROUP BY 1, 2
"""

LAYERS["risk_path"] = """
    SELECT *, round(least(1.0, n_estados_distintos * 0.12 + tuvo_delivery_attempted * 0.2 + tuvo_exception * 0.15
                          + least(horas_entre_eventos_max, 100.0) / 1000.0), 4) AS prob
    FROM prefixes
"""

LAYERS["alerts"] = """
    SELECT logistic_order_id, max(n_hito) AS n_hitos, min(n_hito) FILTER (WHERE prob >= 0.7) AS alerta_hito,
           arg_min(event_dt, n_hito) FILTER (WHERE prob >= 0.7) AS alerta_en,
           arg_min(package_status, n_hito) FILTER (WHERE prob >= 0.7) AS alerta_estado,
           arg_min(prob, n_hito) FILTER (WHERE prob >= 0.7) AS alerta_prob,
           arg_max(prob, n_hito) AS prob_final, max(n_eventos_total) AS n_eventos
    FROM risk_path GROUP BY 1
"""


def with_layers(select: str) -> str:
    """Prepend, in order, every layer that the query names, directly or through another."""
    order = list(LAYERS)
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in order:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(LAYERS[name])

    visit(select)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({LAYERS[n]})" for n in order if n in needed)
    if not ctes:
        return select
    own = select.strip()
    return f"WITH {ctes},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {ctes}\n{select}"
