"""Check SQL of each registered query, for DuckDB. Queries of trained models have none."""

from __future__ import annotations

from parcelpulse.plans.oracle_base import HIGH_SEASON, hours, with_layers
from parcelpulse.sources import schemas as S

_FLOW_ROUNDED = """* REPLACE (round(horas_a_shipment_confirmed, 6) AS horas_a_shipment_confirmed,
    round(horas_a_out_for_delivery, 6) AS horas_a_out_for_delivery,
    round(horas_entre_eventos_max, 6) AS horas_entre_eventos_max,
    round(horas_entre_eventos_avg, 6) AS horas_entre_eventos_avg)"""

_RATES = ["seller_tasa_disrupcion", "categoria_tasa_disrupcion", "categoria_cac_tasa_disrupcion",
          "dia_semana_tasa_disrupcion", "franja_tasa_disrupcion"]
_RATES_ROUNDED = ", ".join(f"round(h.{c}, 6) AS {c}" for c in _RATES)

_LEG_CLASS = """CASE WHEN target_tramo = 'ultima_milla' THEN 'ultima_milla'
    WHEN target_tramo IN ('deposito', 'despacho') THEN 'deposito_despacho' ELSE 'sin_disrupcion' END"""


def _quantiles(probs: tuple[int, ...]) -> str:
    return ", ".join(f"round(quantile_cont(target_horas_totales, {p / 100}), 6) AS p{p:02d}" for p in probs)


def _code(column: str, name: str) -> str:
    """Rank of a value among the labels of one month and the unknown label, unseen values as unknown."""
    text = f"coalesce({column}, 'DESCONOCIDO')"
    labels = f"""(SELECT list_sort(list_distinct(list_append(list({text}), 'DESCONOCIDO')))
                  FROM ml WHERE split_set = 'train' AND year_month = '1995-02')"""
    return f"""CAST(coalesce(nullif(list_position({labels}, {text}), 0), list_position({labels}, 'DESCONOCIDO')) - 1 AS INTEGER)
               AS {name}"""


_NUMERIC = ["is_click_and_collect", "is_high_season", "has_insurance", "total_items", "distinct_skus",
            "dia_semana_creacion", "hora_creacion", "dia_mes_creacion", "sla_horas_prometidas"]


def _metrics(suffix: str, auc: str) -> str:
    return f"""
    SELECT split_set, unnest(['accuracy', 'precision', 'recall', 'f1', 'auc']) AS metric,
           unnest([round(acc, 4), round(p, 4), round(r, 4), round(f, 4), round(auc, 4)]) AS value
    FROM (SELECT split_set, sum(tp) / sum(support) AS acc, max(p) FILTER (WHERE clase = 1) AS p,
                 max(r) FILTER (WHERE clase = 1) AS r, max(f) FILTER (WHERE clase = 1) AS f
          FROM class_prf{suffix} GROUP BY 1) JOIN {auc} USING (split_set)"""


def _histogram(scale: str, x: str) -> str:
    return f"""
    SELECT clase, '{scale}' AS escala, bin, count(*) AS n,
           round(lo + bin * w, 6) AS desde, round(lo + (bin + 1) * w, 6) AS hasta
    FROM (SELECT clase, lo, w, CAST(CASE WHEN w > 0 THEN least(79, floor((x - lo) / w)) ELSE 0 END AS INTEGER) AS bin
          FROM (SELECT clase, x, min(x) OVER (PARTITION BY clase) AS lo,
                       (max(x) OVER (PARTITION BY clase) - min(x) OVER (PARTITION BY clase)) / 80 AS w
                FROM (SELECT clase, {x} AS x FROM pop)))
    GROUP BY clase, bin, lo, w"""


_PACKAGES = "SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, * FROM base_lines WHERE l_returnflag <> 'R'"

_SQL: dict[str, str] = {
    "stg_events": "SELECT * FROM stg_events",
    "stg_packages": "SELECT * FROM stg_packages",
    "stg_items": "SELECT * FROM stg_items",
    "promise_per_order": "SELECT * FROM promise",
    "order_timeline": "SELECT * FROM timeline",
    "stage_baselines": "SELECT * FROM baselines ORDER BY year_month",
    "item_modes": "SELECT * FROM item_modes",
    "fact_orders": "SELECT * FROM fact",
    "order_disruptions": "SELECT * FROM disruptions ORDER BY severidad DESC, hours_total DESC NULLS LAST",
    "order_timeline_by_order": f"""
        SELECT t.* EXCLUDE (source_order_type, fulfillment_order_type, year_month, is_high_season),
               strftime(t.created_at, '%Y-%m') AS year_month,
               coalesce((SELECT {HIGH_SEASON} FROM (SELECT strftime(t.created_at, '%Y-%m') AS year_month)), false)
                   AS is_high_season
        FROM timeline t""",
    "conform_scan": """
        SELECT CAST(o_orderkey AS VARCHAR) AS logistic_order_id, 'sh-' || o_orderkey AS shipment_id,
               o_orderkey || '-' || l_linenumber AS package_id,
               'FULFILMENT_ORDER_PACKAGES_DISPATCHED' AS event_type, sent_ts AS event_dt,
               'SHIPMENT_CONFIRMED' AS package_status,
               '{"dateTo":"' || CASE WHEN o_orderkey % 17 = 0 THEN 'por confirmar'
                                     ELSE strftime(promise, '%Y-%m-%d %H:%M:%S') END
               || '","dateFrom":"' || strftime(promise - INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S')
               || '","serviceCategory":"' || o_orderpriority || '","timeRangeFrom":"09:00","timeRangeTo":"21:00"'
               || CASE WHEN o_custkey % 10 = 0
                       THEN ',"collectAvailabilityDate":"' || strftime(promise, '%Y-%m-%d %H:%M:%S') || '"' ELSE '' END
               || '}' AS promised_date,
               CAST(NULL AS DOUBLE) AS carrier, CAST(NULL AS DOUBLE) AS tracking_number, year_month
        FROM base_lines WHERE l_returnflag <> 'R'""",
    "month_scan": """
        SELECT country, year_month, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders FROM base_lines
        WHERE l_returnflag <> 'R' AND country = 'CL' AND year_month IN ('1996-03', '1997-04', '1998-05') GROUP BY 1, 2""",
    "month_reload_roundtrip": """
        SELECT year_month, count(*) AS source_rows, CASE WHEN year_month = '1997-03' THEN 0 ELSE count(*) END AS target_rows,
               CASE WHEN year_month = '1997-03' THEN 'MISMATCH' ELSE 'OK' END AS status
        FROM base_lines WHERE l_returnflag <> 'R' GROUP BY 1""",
    "month_versions_roundtrip": """
        SELECT year_month, count(*) AS source_rows, CASE WHEN year_month = '1997-03' THEN 0 ELSE count(*) END AS target_rows,
               CASE WHEN year_month = '1997-03' THEN 'MISMATCH' ELSE 'OK' END AS status
        FROM base_lines WHERE l_returnflag <> 'R' GROUP BY 1""",
    "bucketed_upsert": """
        SELECT logistic_order_id, carrier_code, year_month FROM carrier_rows
        QUALIFY row_number() OVER (PARTITION BY logistic_order_id ORDER BY year_month, n1, n2, n3, carrier_code) = 1""",
    "carrier_months_merged": """
        WITH filed AS (
            SELECT * REPLACE (CASE WHEN n2 % 3 = 0 THEN strftime(strptime(year_month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH, '%Y-%m')
                                   ELSE year_month END AS year_month) FROM carrier_rows),
        codes AS (
            SELECT logistic_order_id, carrier_code, count(*) AS n, min(year_month) AS month, min((n1, n2, n3)) AS seen,
                   arg_min(carrier_name, (n1, n2, n3)) AS carrier_name
            FROM filed GROUP BY 1, 2)
        SELECT logistic_order_id, arg_min(carrier_code, (-n, seen, carrier_code)) AS carrier_code,
               arg_min(carrier_name, (-n, seen, carrier_code)) AS carrier_name, min(month) AS year_month, sum(n)::BIGINT AS n_envelopes
        FROM codes GROUP BY 1""",
    "missing_months_append": """
        SELECT year_month, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders
        FROM base_lines WHERE l_returnflag <> 'R' GROUP BY 1""",
    "first_wins_upsert": """
        SELECT logistic_order_id, carrier_code, carrier_name, year_month FROM carrier_rows
        QUALIFY row_number() OVER (PARTITION BY logistic_order_id
                                   ORDER BY year_month, n1, n2, n3, carrier_code, carrier_name) = 1""",
    "text_roundtrip": """
        SELECT formato, count(*) AS n, count(actor_responsable) AS n_actor, count(hours_total) AS n_hours,
               round(sum(hours_total), 2) AS sum_hours, count(*) AS n_nota
        FROM fact, (VALUES ('csv'), ('tsv'), ('json')) f(formato) GROUP BY 1""",
    "layer_materialisation": """
        SELECT year_month, count(*) AS source_rows, count(*) AS target_rows, 'OK' AS status FROM disruptions GROUP BY 1""",
    "replace_predictions": """
        SELECT split_set, count(*) AS n, CAST(sum(hit) AS BIGINT) AS n_hit, round(sum(p1) / 1000.0, 4) AS sum_prob
        FROM scored GROUP BY 1""",
    "nested_to_json": f"""
        SELECT logistic_order_id, o_orderkey || '-' || l_linenumber AS package_id,
               strftime(sent_ts, '%Y-%m-%d %H:%M:%S') AS event_dt, o_orderpriority AS service_category,
               CASE WHEN o_orderkey % 17 = 0 THEN 'por confirmar' ELSE strftime(promise, '%Y-%m-%d %H:%M:%S') END AS date_to,
               CASE WHEN o_custkey % 10 = 0 THEN strftime(promise, '%Y-%m-%d %H:%M:%S') END AS collect_date
        FROM ({_PACKAGES})""",
    "reconcile_counts": """
        SELECT year_month, source_rows, coalesce(target_rows, 0) AS target_rows,
               CASE WHEN source_rows = coalesce(target_rows, 0) THEN 'OK' ELSE 'MISMATCH' END AS status
        FROM (SELECT year_month, count(*) AS source_rows FROM base_orders GROUP BY 1)
        LEFT JOIN (SELECT year_month, count(*) AS target_rows FROM timeline GROUP BY 1) USING (year_month)""",
    "load_report": """
        SELECT year_month, count(*) AS n_rows, count(DISTINCT id) AS n_orders, count(DISTINCT status) AS n_statuses
        FROM (SELECT year_month, CAST(o_orderkey AS VARCHAR) AS id, 'SHIPMENT_CONFIRMED' AS status
              FROM base_lines WHERE l_returnflag <> 'R'
              UNION ALL SELECT year_month, logistic_order_id, package_status FROM status_log) GROUP BY 1""",
    "not_null_report": """
        SELECT 'events' AS table_name, unnest(['h_logistic_order_id', 'h_event_type', 'h_country', 'h_datetime'])
                   AS column_name, count(*) AS n_rows, 0 AS n_null, true AS passed FROM log
        UNION ALL SELECT 'event_items', 'logistic_order_id', count(*), 0, true FROM base_lines
        UNION ALL SELECT 'event_items', 'has_insurance', count(*), count(*) FILTER (WHERE NOT l_tax > 0),
                         count(*) FILTER (WHERE NOT l_tax > 0) = 0 FROM base_lines
        UNION ALL SELECT 'event_packages', 'logistic_order_id', count(*), 0, true FROM base_lines WHERE l_returnflag <> 'R'
        UNION ALL SELECT 'event_packages', 'carrier', count(*), count(*), count(*) = 0
                  FROM base_lines WHERE l_returnflag <> 'R'""",
    "accepted_values": "SELECT 'AR' AS h_country, count(*) AS n_rows FROM log WHERE o_orderkey % 97 = 0 HAVING count(*) > 0",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "key_report": """
        SELECT rows_per_key, count(*) AS n_keys FROM (SELECT count(*) AS rows_per_key FROM fact GROUP BY logistic_order_id)
        GROUP BY 1""",
    "flow_features": f"SELECT {_FLOW_ROUNDED} FROM flows",
    "flow_attached": f"""
        SELECT {_FLOW_ROUNDED} FROM (
            SELECT m.logistic_order_id, m.year_month,
                   COLUMNS(f.* EXCLUDE (logistic_order_id, ultimo_estado)), ultimo_estado
            FROM (SELECT logistic_order_id, year_month FROM fact) m JOIN flows f USING (logistic_order_id)
            UNION ALL
            SELECT logistic_order_id, year_month, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, -1, 'DESCONOCIDO'
            FROM fact WHERE logistic_order_id NOT IN (SELECT logistic_order_id FROM flows))""",
    "flow_from_array": f"""
        SELECT {_FLOW_ROUNDED} FROM (
            SELECT pedido,
                   coalesce(min({hours('t0', 'ts')}) FILTER (WHERE st = 'SHIPMENT_CONFIRMED' AND nth = 1), -1.0)
                       AS horas_a_shipment_confirmed,
                   coalesce(min({hours('t0', 'ts')}) FILTER (WHERE st = 'OUT_FOR_DELIVERY' AND nth = 1), -1.0)
                       AS horas_a_out_for_delivery,
                   CASE WHEN count(pos) = 0 THEN -1.0 ELSE coalesce(max(gap) FILTER (WHERE gap >= 0), 0.0) END
                       AS horas_entre_eventos_max,
                   CASE WHEN count(pos) = 0 THEN -1.0 ELSE coalesce(avg(gap) FILTER (WHERE gap >= 0), 0.0) END
                       AS horas_entre_eventos_avg,
                   count(pos) AS n_eventos_total, greatest(1, count(DISTINCT st)) AS n_estados_distintos,
                   CAST(coalesce(bool_or(st = 'DELIVERY_ATTEMPTED'), false) AS INTEGER) AS tuvo_delivery_attempted,
                   0 AS tuvo_exception, 0 AS tuvo_annulled,
                   CAST(coalesce(arg_max(st, pos) = 'IN_TRANSIT', false) AS INTEGER) AS esta_en_transito,
                   CAST(coalesce(arg_max(st, pos) = 'OUT_FOR_DELIVERY', false) AS INTEGER) AS esta_out_for_delivery,
                   CAST(coalesce(arg_max(st, pos) = 'SHIPMENT_CONFIRMED', false) AS INTEGER) AS esta_shipment_confirmed,
                   coalesce(arg_max(st, pos), 'SHIPMENT_CONFIRMED') AS ultimo_estado
            FROM (SELECT pedido, pos, ts, st, first_value(ts) OVER w AS t0, {hours('lag(ts) OVER w', 'ts')} AS gap,
                         row_number() OVER (PARTITION BY pedido, st ORDER BY pos) AS nth
                  FROM (SELECT f.logistic_order_id AS pedido, s.pos, s.ts, s.st FROM fact f LEFT JOIN (
                            SELECT logistic_order_id AS id, u.p AS pos, u.ts AS ts, u.st AS st
                            FROM fact, unnest(CASE WHEN CAST(logistic_order_id AS BIGINT) % 3 = 0 THEN
                                [{{'p': 1, 'ts': packed_at, 'st': 'IN_TRANSIT'}}, {{'p': 2, 'ts': dispatched_at, 'st': 'OUT_FOR_DELIVERY'}},
                                 {{'p': 3, 'ts': created_at, 'st': 'SHIPMENT_CONFIRMED'}}, {{'p': 4, 'ts': completed_at, 'st': 'DELIVERY_ATTEMPTED'}},
                                 {{'p': 5, 'ts': dispatched_at, 'st': 'OUT_FOR_DELIVERY'}}]
                                ELSE [{{'p': 1, 'ts': created_at, 'st': 'SHIPMENT_CONFIRMED'}}, {{'p': 2, 'ts': packed_at, 'st': 'IN_TRANSIT'}},
                                 {{'p': 3, 'ts': dispatched_at, 'st': 'OUT_FOR_DELIVERY'}}, {{'p': 4, 'ts': completed_at, 'st': 'DELIVERY_ATTEMPTED'}}]
                                END) AS t(u)
                            WHERE u.ts IS NOT NULL) s ON s.id = f.logistic_order_id)
                  WINDOW w AS (PARTITION BY pedido ORDER BY pos))
            GROUP BY pedido)""",
    "carrier_first": "SELECT * FROM carrier_rows",
    "carrier_mode": "SELECT * FROM order_carriers",
    "carrier_earliest_month": "SELECT * EXCLUDE (n_envelopes) FROM order_carriers",
    "carrier_coverage": """
        SELECT split_set, count(*) AS n_orders, count(c.carrier_code) AS n_known,
               round(100.0 * CAST(count(c.carrier_code) AS DOUBLE) / count(*), 2) AS pct_known
        FROM ml LEFT JOIN order_carriers c ON c.logistic_order_id = ml.logistic_order_id GROUP BY 1""",
    "top_carriers": """
        SELECT carrier_code, carrier_name, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS n_total
        FROM order_carriers GROUP BY 1, 2
        ORDER BY n DESC, carrier_code, carrier_name LIMIT 10""",
    "carrier_search": """
        SELECT logistic_order_id, carrier_code AS carrier, year_month FROM carrier_rows WHERE carrier_code = 'S3'""",
    "ml_dataset": "SELECT * FROM ml",
    "historical_rates": f"""
        SELECT logistic_order_id, year_month, seller_n_ordenes, franja_horaria, {_RATES_ROUNDED} FROM hist h""",
    "dataset_join_history": f"""
        SELECT m.logistic_order_id, m.split_set, coalesce(c.carrier_code, 'DESCONOCIDO') AS carrier_code, m.target_binario,
               h.seller_n_ordenes, {_RATES_ROUNDED}
        FROM ml m JOIN hist h ON h.logistic_order_id = m.logistic_order_id AND h.year_month = m.year_month
        LEFT JOIN order_carriers c ON c.logistic_order_id = m.logistic_order_id""",
    "leg_population": f"""
        SELECT logistic_order_id, split_set, hours_deposito, hours_despacho, hours_ultima_milla, {_LEG_CLASS} AS clase_tramo
        FROM ml JOIN (SELECT logistic_order_id, hours_deposito, hours_despacho, hours_ultima_milla, hours_total FROM fact)
             USING (logistic_order_id)
        WHERE ciclo_completo = 1 AND hours_total > 0 AND target_tramo IS NOT NULL""",
    "hours_population": """
        SELECT logistic_order_id, split_set, target_horas_totales, sla_horas_prometidas, desvio AS desvio_sla FROM pop""",
    "read_by_month": """
        SELECT logistic_order_id, year_month, split_set, total_items FROM ml
        WHERE year_month IN ('1999-01', '1999-02', '2000-05', '2001-03')""",
    "dist_by_class": f"""
        SELECT target_binario, clase, count(*) AS n, round(avg(target_horas_totales), 6) AS media,
               min(target_horas_totales) AS min_h, max(target_horas_totales) AS max_h,
               round(stddev_samp(target_horas_totales), 6) AS std_h, {_quantiles((5, 25, 50, 75, 90, 95, 99))}
        FROM pop GROUP BY 1, 2""",
    "dist_by_category": f"""
        SELECT category AS service_category, clase, count(*) AS n, round(avg(target_horas_totales), 6) AS media,
               {_quantiles((50, 90, 99))}
        FROM pop GROUP BY 1, 2""",
    "pivot_ratio": """
        SELECT service_category, round(ok, 6) AS ok, round(dis, 6) AS disrupted, round(round(dis, 6) / round(ok, 6), 6) AS ratio_disrupted_ok
        FROM (SELECT category AS service_category, avg(target_horas_totales) FILTER (WHERE clase = 'OK') AS ok,
                     avg(target_horas_totales) FILTER (WHERE clase = 'DISRUPTED') AS dis FROM pop GROUP BY 1)""",
    "stratified_sample": "SELECT * FROM sampled",
    "histogram": _histogram(
        "lineal", "least(greatest(target_horas_totales, 0), (SELECT quantile_cont(target_horas_totales, 0.99) FROM pop))"
    ) + " UNION ALL " + _histogram("log1p", "ln(1 + target_horas_totales)"),
    "sample_summary": """
        SELECT clase, count(*) AS n, round(avg(target_horas_totales), 6) AS media,
               round(median(target_horas_totales), 6) AS mediana, round(stddev_pop(target_horas_totales), 6) AS std,
               round(avg(target_horas_totales) / (SELECT avg(target_horas_totales) FROM sampled WHERE clase = 'OK'), 6)
                   AS ratio_media_ok
        FROM sampled GROUP BY 1""",
    "sla_validity": """
        SELECT split_set, count(*) AS total, count(*) FILTER (WHERE sla_horas_prometidas IS NULL) AS sla_null,
               count(*) FILTER (WHERE sla_horas_prometidas <= 0) AS sla_zero_neg,
               count(*) FILTER (WHERE sla_horas_prometidas > 0) AS sla_valida,
               round(100.0 * CAST(count(*) FILTER (WHERE sla_horas_prometidas IS NULL) AS DOUBLE) / count(*), 2) AS pct_null,
               round(avg(sla_horas_prometidas) FILTER (WHERE sla_horas_prometidas > 0), 1) AS media_sla_valida,
               round(min(sla_horas_prometidas), 1) AS min_sla, round(max(sla_horas_prometidas), 1) AS max_sla
        FROM pop GROUP BY 1""",
    "sla_by_category": """
        SELECT category AS service_category, split_set, count(*) AS total,
               count(*) FILTER (WHERE coalesce(sla_horas_prometidas, 0) <= 0) AS sla_invalida,
               round(100.0 * CAST(count(*) FILTER (WHERE coalesce(sla_horas_prometidas, 0) <= 0) AS DOUBLE) / count(*), 1)
                   AS pct_invalida
        FROM pop GROUP BY 1, 2""",
    "sla_top_sellers": """
        SELECT seller_id, count(*) AS total, count(*) AS sla_invalida, 100.0::DOUBLE AS pct_invalida,
               category AS categoria_mas_frecuente
        FROM pop WHERE coalesce(sla_horas_prometidas, 0) <= 0 GROUP BY seller_id, category
        ORDER BY sla_invalida DESC, seller_id, category LIMIT 15""",
    "sla_filter_impact": """
        SELECT split_set, count(*) AS filas_actuales, count(*) FILTER (WHERE sla_horas_prometidas > 0) AS filas_con_sla_valido,
               round(100.0 * CAST(count(*) FILTER (WHERE sla_horas_prometidas > 0) AS DOUBLE) / count(*), 1) AS pct_retencion,
               round(avg(desvio) FILTER (WHERE sla_horas_prometidas > 0), 1) AS desvio_medio_h,
               round(quantile_cont(desvio, 0.5) FILTER (WHERE sla_horas_prometidas > 0), 1) AS desvio_mediana_h,
               round(quantile_cont(desvio, 0.9) FILTER (WHERE sla_horas_prometidas > 0), 1) AS desvio_p90_h
        FROM pop GROUP BY 1""",
    "deviation_buckets": """
        SELECT categoria_desvio, orden, count(*) AS n,
               round(100.0 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 2) AS pct
        FROM (SELECT CASE WHEN desvio < -24 THEN 'muy_early (< -24h)' WHEN desvio < 0 THEN 'early (0 a -24h)'
                          WHEN desvio = 0 THEN 'exacto' WHEN desvio <= 24 THEN 'leve_tarde (0-24h)'
                          WHEN desvio <= 72 THEN 'tarde (24-72h)' ELSE 'muy_tarde (> 72h)' END AS categoria_desvio,
                     CASE WHEN desvio < -24 THEN 1 WHEN desvio < 0 THEN 2 WHEN desvio = 0 THEN 3 WHEN desvio <= 24 THEN 4
                          WHEN desvio <= 72 THEN 5 ELSE 6 END AS orden
              FROM pop WHERE sla_horas_prometidas > 0)
        GROUP BY 1, 2""",
    "seller_history": "SELECT DISTINCT * EXCLUDE (pedido, created_at, sla_horas) FROM looked_up",
    "new_order_features": """
        SELECT pedido, fuente, dayofweek(created_at) AS dia_semana_creacion, hour(created_at) AS hora_creacion,
               day(created_at) AS dia_mes_creacion,
               CASE WHEN hour(created_at) BETWEEN 6 AND 11 THEN 'manana' WHEN hour(created_at) BETWEEN 12 AND 19 THEN 'tarde'
                    ELSE 'madrugada' END AS franja_horaria,
               sla_horas AS sla_horas_prometidas, n_ordenes, seller_n_ordenes, seller_tasa AS seller_tasa_disrupcion,
               cat_tasa AS categoria_tasa_disrupcion, cat_cac_tasa AS categoria_cac_tasa_disrupcion,
               dia_tasa AS dia_semana_tasa_disrupcion, franja_tasa AS franja_tasa_disrupcion
        FROM looked_up""",
    "failing_legs": """
        WITH keys AS (SELECT DISTINCT seller_id, service_category FROM requests),
        rows_of AS (
            SELECT k.*, tramo_disruptivo, actor_responsable, n, 'seller+category' AS fuente
            FROM keys k JOIN broken_pair b ON b.seller_id = k.seller_id AND b.service_category = k.service_category
            UNION ALL
            SELECT k.*, tramo_disruptivo, actor_responsable, n, 'category'
            FROM keys k JOIN broken_category b ON b.service_category = k.service_category
            WHERE (k.seller_id, k.service_category) NOT IN (
                SELECT (seller_id, service_category) FROM broken_pair WHERE seller_id IS NOT NULL AND service_category IS NOT NULL)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY seller_id, service_category
                          ORDER BY n DESC, tramo_disruptivo, actor_responsable NULLS FIRST) AS puesto,
                   sum(n) OVER (PARTITION BY seller_id, service_category) AS n_all FROM rows_of)
        SELECT seller_id, service_category, puesto, tramo_disruptivo, actor_responsable, n, fuente,
               round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY seller_id, service_category), 1) AS pct,
               round(100.0 * CAST(n AS DOUBLE) / n_all, 1) AS pct_of_all
        FROM ranked WHERE puesto <= 5""",
    "order_journey": f"""
        SELECT logistic_order_id, coalesce(package_id, 'SIN_PACKAGE_ID') AS package_key, row_number() OVER w AS n_evento,
               shipment_id, promised_date, package_status, event_type, event_dt,
               round({hours('lag(event_dt) OVER w', 'event_dt')}, 6) AS horas_desde_anterior
        FROM status_log WINDOW w AS (PARTITION BY logistic_order_id, package_id ORDER BY event_dt, event_id)""",
    "package_journeys": f"""
        SELECT logistic_order_id, package_key, arg_min(shipment_id, n) AS shipment_id, arg_min(promised_date, n) AS promised_date,
               count(*) AS n_eventos, min(event_dt) AS primer_evento, max(event_dt) AS ultimo_evento,
               arg_max(package_status, n) AS ultimo_estado, round(coalesce(max(gap), 0), 1) AS horas_max_gap
        FROM (SELECT *, coalesce(package_id, 'SIN_PACKAGE_ID') AS package_key, row_number() OVER w AS n,
                     round({hours('lag(event_dt) OVER w', 'event_dt')}, 6) AS gap
              FROM status_log WINDOW w AS (PARTITION BY logistic_order_id, package_id ORDER BY event_dt, event_id))
        GROUP BY 1, 2""",
    "package_event_pages": f"""
        SELECT logistic_order_id, package_key, (n - 1) // 10 AS pagina,
               string_agg(concat_ws('|', n, strftime(event_dt, '%Y-%m-%d %H:%M:%S'), event_type, package_status), ';' ORDER BY n) AS eventos,
               arg_max(package_status, n) AS ultimo_estado, max(gap) AS horas_max_gap
        FROM (SELECT *, coalesce(package_id, 'SIN_PACKAGE_ID') AS package_key, row_number() OVER w AS n,
                     round({hours('lag(event_dt) OVER w', 'event_dt')}, 6) AS gap
              FROM status_log WINDOW w AS (PARTITION BY logistic_order_id, package_id ORDER BY event_dt, event_id))
        GROUP BY 1, 2, 3""",
    "order_state_at": f"""
        WITH first AS (SELECT logistic_order_id, min(event_dt) AS first FROM status_log GROUP BY 1),
        moments AS (SELECT logistic_order_id, horas, first + to_hours(horas) AS momento
                    FROM first, (VALUES (-1), (0), (36), (240), (2000)) h(horas)),
        seen AS (SELECT *, count(*) OVER w AS n, max(CASE WHEN package_status = 'DELIVERY_ATTEMPTED' THEN 1 ELSE 0 END) OVER w AS attempted,
                        max(CASE WHEN package_status = 'EXCEPTION' THEN 1 ELSE 0 END) OVER w AS excepted,
                        max(CASE WHEN package_status = 'ANNULLED' THEN 1 ELSE 0 END) OVER w AS annulled
                 FROM status_log WINDOW w AS (PARTITION BY logistic_order_id ORDER BY event_dt, event_id))
        SELECT m.logistic_order_id, m.horas::INTEGER AS horas, m.momento, coalesce(e.n, 0)::BIGINT AS n_eventos,
               e.event_dt AS ultimo_evento, e.package_status AS ultimo_estado, round({hours('e.event_dt', 'm.momento')}, 6) AS horas_desde_evento,
               coalesce(attempted, 0)::INTEGER AS tuvo_delivery_attempted, coalesce(excepted, 0)::INTEGER AS tuvo_exception,
               coalesce(annulled, 0)::INTEGER AS tuvo_annulled
        FROM moments m ASOF LEFT JOIN seen e ON m.logistic_order_id = e.logistic_order_id AND m.momento >= e.event_dt""",
    "order_360": """
        SELECT m.logistic_order_id, m.year_month, m.split_set, m.service_category, m.is_click_and_collect, m.is_high_season,
               m.has_insurance, m.total_items, m.distinct_skus, m.dia_semana_creacion, m.hora_creacion, m.dia_mes_creacion,
               m.sla_horas_prometidas, m.target_binario,
               round(h.seller_tasa_disrupcion, 6) AS seller_tasa_disrupcion,
               round(h.categoria_tasa_disrupcion, 6) AS categoria_tasa_disrupcion,
               h.franja_horaria, d.tramo_disruptivo, d.actor_responsable, f.n_eventos_total AS n_eventos,
               f.n_estados_distintos, f.tuvo_delivery_attempted, f.tuvo_exception, f.tuvo_annulled,
               round(f.horas_entre_eventos_max, 6) AS horas_max_gap, f.ultimo_estado
        FROM ml m LEFT JOIN hist h ON h.logistic_order_id = m.logistic_order_id
        LEFT JOIN disruptions d ON d.logistic_order_id = m.logistic_order_id
        LEFT JOIN flows f ON f.logistic_order_id = m.logistic_order_id""",
    "order_events_until": f"""
        SELECT m.logistic_order_id, m.year_month, m.service_category, {', '.join('m.' + c for c in _NUMERIC)}, m.target_binario,
               h.seller_n_ordenes, h.franja_horaria, {_RATES_ROUNDED},
               d.tramo_disruptivo, d.actor_responsable, e.n_eventos, e.ultimo_evento
        FROM ml m LEFT JOIN hist h ON h.logistic_order_id = m.logistic_order_id
        LEFT JOIN disruptions d ON d.logistic_order_id = m.logistic_order_id
        LEFT JOIN (SELECT logistic_order_id, count(*) AS n_eventos, max(event_dt) AS ultimo_evento FROM status_log
                   WHERE event_dt <= TIMESTAMP '2024-01-12' GROUP BY 1) e ON e.logistic_order_id = m.logistic_order_id""",
    "order_event_rows": """
        SELECT logistic_order_id, package_id, event_id, event_dt, package_status FROM status_log
        WHERE event_dt <= TIMESTAMP '2024-01-12'""",
    "rate_by_calendar": """
        SELECT dimension, valor, round(avg(target_binario) * 100, 2) AS pct_disrupted, count(*) AS n_ordenes
        FROM (SELECT target_binario, 'franja' AS dimension, franja_horaria AS valor FROM ml WHERE service_category = '3-MEDIUM'
              UNION ALL
              SELECT target_binario, 'dia', ['Domingo', 'Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado'][dia_semana_creacion + 1]
              FROM ml WHERE service_category = '3-MEDIUM')
        GROUP BY 1, 2""",
    "encode_features": f"""
        SELECT logistic_order_id, {', '.join(f'coalesce(round(CAST({c} AS DOUBLE), 4), -1.0) AS {c}' for c in _NUMERIC)},
               {_code('service_category', 'service_category_code')}, {_code('source_order_type', 'source_order_type_code')},
               {_code('seller_id', 'seller_id_code')}, {_code('created_by', 'created_by_code')}
        FROM ml""",
    "class_weights": f"""
        SELECT clase, n_clase, round(CAST(sum(n_clase) OVER () AS DOUBLE) / (count(*) OVER () * n_clase), 9) AS peso
        FROM (SELECT {_LEG_CLASS} AS clase, count(*) AS n_clase FROM ml WHERE split_set = 'train' GROUP BY 1)""",
    "confusion": "SELECT split_set, target AS label, pred, count(*) AS n FROM scored GROUP BY 1, 2, 3",
    "confusion_matrix": """
        SELECT split_set, target AS label, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1
        FROM scored GROUP BY 1, 2""",
    "class_report": """
        SELECT split_set, CAST(clase AS VARCHAR) AS clase, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support
        FROM class_prf
        UNION ALL SELECT split_set, 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT)
        FROM class_prf GROUP BY 1
        UNION ALL SELECT split_set, 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4),
                         round(sum(f * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM class_prf GROUP BY 1
        UNION ALL SELECT split_set, 'accuracy', round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4),
                         round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM class_prf GROUP BY 1""",
    "leg_class_report": """
        WITH legs AS (SELECT split_set, label, ['deposito_despacho', 'sin_disrupcion', 'ultima_milla'][k % 3 + 1] AS pred
                      FROM (SELECT split_set, CAST(logistic_order_id AS BIGINT) AS k,
                                   CASE WHEN target_tramo = 'ultima_milla' THEN 'ultima_milla'
                                        WHEN target_tramo IN ('deposito', 'despacho') THEN 'deposito_despacho'
                                        ELSE 'sin_disrupcion' END AS label FROM ml)),
        sums AS (SELECT split_set, clase, count(*) FILTER (WHERE label = clase AND pred = clase) AS tp,
                        count(*) FILTER (WHERE label = clase) AS support, count(*) FILTER (WHERE pred = clase) AS predicted
                 FROM legs, (VALUES ('deposito_despacho'), ('sin_disrupcion'), ('ultima_milla')) c(clase) GROUP BY 1, 2),
        prf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f
                FROM (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
                             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM sums))
        SELECT split_set, clase, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support FROM prf
        UNION ALL SELECT split_set, 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT)
        FROM prf GROUP BY 1
        UNION ALL SELECT split_set, 'weighted avg', round(sum(p * support) / sum(support), 4), round(sum(r * support) / sum(support), 4),
                         round(sum(f * support) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM prf GROUP BY 1
        UNION ALL SELECT split_set, 'accuracy', round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4),
                         round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM prf GROUP BY 1""",
    "roc_auc": "SELECT split_set, n_pos, n_neg, round(auc, 6) AS auc FROM auc1",
    "avg_precision": """
        SELECT split_set, CAST(sum(pos) AS BIGINT) AS n_pos, round(sum(pos * cp / cn) / sum(pos), 6) AS avg_precision
        FROM (SELECT split_set, pos, sum(pos) OVER w AS cp, sum(n) OVER w AS cn
              FROM (SELECT split_set, p1, sum(target) AS pos, count(*) AS n FROM scored GROUP BY 1, 2)
              WINDOW w AS (PARTITION BY split_set ORDER BY p1 DESC))
        GROUP BY 1""",
    "regression_metrics": """
        SELECT split_set, n, n - n_ok AS n_descartadas, round(mae, 2) AS mae_horas, round(rmse, 2) AS rmse_horas,
               round(mae / 24, 2) AS mae_dias, round(rmse / 24, 2) AS rmse_dias, round(1 - rmse * rmse / v, 4) AS r2,
               round(near24, 2) AS dentro_24h, round(near48, 2) AS dentro_48h,
               round(q[1], 1) AS error_p25, round(q[2], 1) AS error_p50, round(q[3], 1) AS error_p75,
               round(q[4], 1) AS error_p90, round(q[5], 1) AS error_p95
        FROM (SELECT split_set, count(*) AS n, count(e) AS n_ok, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
                     var_pop(horas) FILTER (WHERE e IS NOT NULL) AS v,
                     100.0 * CAST(count(*) FILTER (WHERE abs(e) <= 24) AS DOUBLE) / count(e) AS near24,
                     100.0 * CAST(count(*) FILTER (WHERE abs(e) <= 48) AS DOUBLE) / count(e) AS near48,
                     quantile_cont(abs(e), [0.25, 0.5, 0.75, 0.9, 0.95]) AS q
              FROM (SELECT split_set, horas, CASE WHEN isfinite(horas_pred) AND isfinite(horas) THEN horas_pred - horas END AS e
                    FROM scored) GROUP BY 1)""",
    "risk_shares": """
        SELECT split_set, count(*) AS n, round(100.0 * CAST(count(*) FILTER (WHERE p1 >= 700) AS DOUBLE) / count(*), 2) AS pct_ge_70,
               round(100.0 * CAST(count(*) FILTER (WHERE p1 >= 900) AS DOUBLE) / count(*), 2) AS pct_ge_90
        FROM scored GROUP BY 1""",
    "split_report": """
        SELECT split_set, count(*) AS n, round(avg(p1) / 1000, 4) AS prob_media,
               round(100.0 * CAST(sum(pred) AS DOUBLE) / count(*), 2) AS pct_pred,
               round(100.0 * CAST(sum(target) AS DOUBLE) / count(*), 2) AS pct_real,
               round(100.0 * CAST(sum(hit) AS DOUBLE) / count(*), 2) AS accuracy
        FROM scored GROUP BY 1""",
    "split_sizes": """
        SELECT split_set, count(*) AS n, round(avg(target_binario) * 100, 2) AS pct_disrupted,
               round(avg(target_horas_totales), 4) AS media_h, max(target_horas_totales) AS max_h,
               round(median(target_horas_totales), 4) AS mediana_h
        FROM ml GROUP BY 1""",
    "category_report": """
        SELECT coalesce(service_category, '(vacío)') AS service_category, count(*) AS n,
               round(100.0 * CAST(sum(target) AS DOUBLE) / count(*), 2) AS pct_real,
               round(100.0 * CAST(sum(hit) AS DOUBLE) / count(*), 2) AS accuracy
        FROM scored GROUP BY scored.service_category""",
    "version_delta": f"""
        SELECT a.split_set, a.metric, a.value AS v1, b.value AS v2, round(b.value - a.value, 4) AS delta
        FROM ({_metrics('', 'auc1')}) a JOIN ({_metrics('2', 'auc2')}) b
             ON b.split_set = a.split_set AND b.metric = a.metric""",
    "class_distribution": f"""
        SELECT split_set, clase, n, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY split_set), 2) AS pct
        FROM (SELECT split_set, {_LEG_CLASS} AS clase, count(*) AS n FROM ml GROUP BY 1, 2)""",
    "status_changes": """
        SELECT logistic_order_id, n_hito, event_dt, package_status, round(since, 6) AS horas_desde_hito,
               coalesce(since > 24, false) AS aviso_gap,
               CASE package_status WHEN 'DELIVERY_ATTEMPTED' THEN 'INTENTO FALLIDO' WHEN 'ANNULLED' THEN 'ANULADA'
                    WHEN 'EXCEPTION' THEN 'EXCEPCIÓN' END AS alerta
        FROM stones_of_status""",
    "prefix_features": f"""
        SELECT {_FLOW_ROUNDED[:-1]}) FROM (
            SELECT * EXCLUDE (since), round(since, 6) AS horas_desde_hito, coalesce(since > 24, false) AS aviso_gap,
                   CASE package_status WHEN 'DELIVERY_ATTEMPTED' THEN 'INTENTO FALLIDO' WHEN 'ANNULLED' THEN 'ANULADA'
                        WHEN 'EXCEPTION' THEN 'EXCEPCIÓN' END AS alerta FROM prefixes)""",
    "first_alert": "SELECT * EXCLUDE (prob_final, n_eventos) FROM alerts",
    "replay_summary": """
        SELECT a.*, CASE m.target_binario WHEN 1 THEN 'DISRUMPIÓ' WHEN 0 THEN 'ENTREGADA' END AS resultado_real,
               d.tramo_disruptivo, d.actor_responsable
        FROM alerts a LEFT JOIN ml m ON m.logistic_order_id = a.logistic_order_id
        LEFT JOIN disruptions d ON d.logistic_order_id = a.logistic_order_id""",
}


_CHECKED = """SELECT logistic_order_id, year_month, split_set, service_category, CAST(target_binario AS SMALLINT) AS target,
    true AS prob_ok, true AS pred_ok, true AS hit_ok FROM ml"""

# what must hold for the rows of a trained model: keys and labels by SQL, the checks all true
_SQL |= {
    "classifier_scores_checked": _CHECKED,
    "flow_classifier_scores_checked": _CHECKED,
    "classifier_quality_checked": """
        SELECT modelo, split_set, count(*) AS n, true AS auc_ok, true AS boosted
        FROM ml, (VALUES ('creacion'), ('flujo')) m(modelo) GROUP BY 1, 2""",
    "leg_scores_checked": f"""
        SELECT logistic_order_id, year_month, split_set, clase_tramo AS clase, true AS pred_ok, true AS f1_ok
        FROM ({_SQL["leg_population"]}) JOIN (SELECT logistic_order_id, year_month FROM ml) USING (logistic_order_id)""",
    "hours_regression_checked": """
        SELECT logistic_order_id, year_month, split_set, round(target_horas_totales, 4) AS horas, true AS pred_ok, true AS r2_ok FROM pop""",
    "leg_scores_of_four_checked": """
        SELECT logistic_order_id, year_month, split_set, target_tramo AS clase, true AS pred_ok, true AS f1_ok
        FROM ml WHERE ciclo_completo = 1 AND target_tramo IS NOT NULL""",
    "continued_boosting_checked": """
        SELECT periodo, CASE WHEN row_number() OVER (ORDER BY periodo) = 1 THEN 41 ELSE 10 END::INTEGER AS arboles,
               true AS perdida_ok, true AS no_peor
        FROM (SELECT DISTINCT left(year_month, 4) AS periodo FROM ml WHERE split_set = 'train')""",
    "boosting_curve_checked": "SELECT true AS ultimo_es_minimo, true AS paciencia_ok, true AS limite_ok",
    "feature_importance_checked": f"""
        SELECT feature, true AS gain_ok, true AS split_ok, true AS suma_ok
        FROM (VALUES {", ".join(f"('{c}')" for c in [*S.CREATION_NUMERIC, *S.HISTORY_NUMERIC, "service_category", "franja_horaria"])}) f(feature)""",
    "experiment_grid_checked": """
        SELECT experimento, split_set, count(*) AS n, true AS errores_ok, true AS r2_ok
        FROM pop, (VALUES ('reg_v2a'), ('reg_v2b'), ('reg_v2c')) e(experimento) GROUP BY 1, 2""",
    "score_new_orders_checked": f"""
        SELECT pedido, fuente, true AS prob_ok, true AS porcentaje_ok FROM ({_SQL["new_order_features"]})""",
    "score_itineraries_checked": f"""
        SELECT pedido, true AS prob_ok, true AS nivel_ok FROM ({_SQL["flow_from_array"]})""",
    "replay_with_model_checked": """
        SELECT logistic_order_id, count(*) AS n_hitos, true AS prob_ok
        FROM prefixes JOIN (SELECT logistic_order_id FROM ml) USING (logistic_order_id) GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_layers(sql) for name, sql in _SQL.items()}
