"""Input schemas, fixed vocabularies and job variables."""

from __future__ import annotations

from dataclasses import dataclass

# Event types of the order log.
CREATED = "FULFILMENT_ORDER_CREATED"
PACKED = "FULFILMENT_ORDER_ITEM_QUANTITY_PACKED"
DISPATCHED = "FULFILMENT_ORDER_PACKAGES_DISPATCHED"
ITEM_DISPATCHED = "FULFILMENT_ORDER_ITEM_QUANTITY_DISPATCHED"
ANNULLED_ITEMS = "FO_ITEMS_ANNULLED"
STATE_CHANGED = "FULFILMENT_ORDER_ITEM_QUANTITY_STATE_CHANGED"

# Order state and package states.
COMPLETED = "COMPLETED"
SHIPMENT_CONFIRMED = "SHIPMENT_CONFIRMED"
IN_TRANSIT = "IN_TRANSIT"
OUT_FOR_DELIVERY = "OUT_FOR_DELIVERY"
DELIVERY_ATTEMPTED = "DELIVERY_ATTEMPTED"
EXCEPTION = "EXCEPTION"
ANNULLED = "ANNULLED"

UNKNOWN = "DESCONOCIDO"
COUNTRIES = ["CL", "PE", "CO"]


@dataclass(frozen=True)
class JobVars:
    """Focus country, first valid day, and months of high season."""

    country: str = "CL"
    min_date: str = "2025-01-01"
    high_season: tuple[str, ...] = ("2025-06", "2025-10", "2025-11", "2025-12")
    folder_is_event_month: bool = False


RAW_EVENTS = """
    h_logistic_order_id string, h_source_order_id string, d_logistic_order_id string,
    h_event_type string, h_entity_type string, h_country string, h_commerce string,
    h_datetime string, d_executed_at string, publish_time string, d_state string,
    d_executed_by string, d_fulfillment_order_type string, d_source_order_type string,
    d_is_international boolean, d_order_version string, year_month string
"""

RAW_ITEMS = """
    logistic_order_id string, event_type string, event_dt string, country string,
    sku bigint, seller_id bigint, quantity struct<number: double, unit: string>,
    reserved_quantity double, has_insurance int, year_month string
"""

RAW_PACKAGES = """
    logistic_order_id string, shipment_id string, package_id string, event_type string,
    event_dt string, country string, package_status string, promised_date map<string, string>,
    carrier double, tracking_number double, year_month string
"""

PACKAGE_EVENTS = """
    logistic_order_id string, shipment_id string, package_id string, event_type string,
    event_dt timestamp_ntz, package_status string, promised_date string, carrier double,
    tracking_number double, year_month string
"""

ENVELOPE_HEADER = "eventType string, logisticOrderId string, country string"
ENVELOPE_DATA = """
    orderItems array<struct<states: array<struct<packagesInfo: array<struct<
        trackingData: struct<carrierCode: string, carrierName: string>>>>>>>
"""

# Features of the risk models, in their order.
CREATION_NUMERIC = [
    "is_click_and_collect", "is_high_season", "has_insurance", "total_items", "distinct_skus",
    "dia_semana_creacion", "hora_creacion", "dia_mes_creacion", "sla_horas_prometidas",
]
HISTORY_NUMERIC = [
    "seller_n_ordenes", "seller_tasa_disrupcion", "categoria_tasa_disrupcion",
    "categoria_cac_tasa_disrupcion", "dia_semana_tasa_disrupcion", "franja_tasa_disrupcion",
]
FLOW_NUMERIC = [
    "horas_a_shipment_confirmed", "horas_a_out_for_delivery", "horas_entre_eventos_max",
    "horas_entre_eventos_avg", "n_eventos_total", "n_estados_distintos", "tuvo_delivery_attempted",
    "tuvo_exception", "tuvo_annulled", "esta_en_transito", "esta_out_for_delivery",
    "esta_shipment_confirmed",
]
FLOW_CATEGORICAL = ["service_category", "franja_horaria", "ultimo_estado"]
