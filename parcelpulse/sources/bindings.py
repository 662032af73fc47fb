"""Canonical logs derived from the star-schema tables, for trying every operator.

The rules are spelled out in FIXTURES.md, section 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.functions.times import HOUR_MICROS, hours_between
from parcelpulse.operators.features import SplitRule
from parcelpulse.sources import schemas as S
from parcelpulse.sources.readers import spread

# Job variables that fit the dates of these tables.
VARS = S.JobVars(
    country="CL",
    min_date="1995-02-01",
    high_season=tuple(f"{y}-{m}" for y in range(1995, 2002) for m in ("06", "10", "11", "12")),
)

SPLITS = SplitRule(val_from="2000-01", test_from="2001-01")

TEXT_TIME = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _later(start: Column, hours: Column | int) -> Column:
    """Start and result are microseconds since the epoch: plain long arithmetic."""
    h = F.lit(hours) if isinstance(hours, int) else hours.cast("long")
    return start + h * F.lit(HOUR_MICROS)


def _as_text(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), TEXT_TIME)


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _promise_hours(priority: Column) -> Column:
    level = F.substring(priority, 1, 1)
    hours = F.lit(420)
    for digit, h in (("1", 200), ("2", 260), ("3", 330), ("4", 370)):
        hours = F.when(level == digit, h).otherwise(hours)
    return hours


def orders_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    start = _later(F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey") % 24)
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        start.alias("t0"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.when(F.col("o_custkey") % 50 == 0, "PE").otherwise("CL").alias("country"),
        _later(
            start, F.when(F.col("o_orderkey") % 29 == 0, -10).otherwise(_promise_hours(F.col("o_orderpriority")))
        ).alias("promise"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"]
    li = table(spark, sf_dir, "lineitem").select(*columns)
    return orders_base(spark, sf_dir).join(li, F.col("o_orderkey") == F.col("l_orderkey"))


def _envelope(kind: str, state: str, at: Column, actor: Column, version: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("event_type"), F.lit(state).alias("state"), at.alias("at"), _as_text(at).alias("text"),
        actor.alias("actor"), version.cast("string").alias("version"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed_at = _later(F.col("t0"), 1 + (7 * F.col("l_partkey")) % 48)
    sent_at = _later(F.col("t0"), 49 + (13 * F.col("l_suppkey") + F.col("l_partkey")) % 96)
    done_at = _later(F.col("t0"), 145 + 5 * F.col("l_quantity"))
    line = F.col("l_linenumber")
    kept = F.col("l_returnflag") != "R"
    carrier = _text("s", F.col("l_suppkey") % 5)
    per_line = F.array(
        F.when(kept, _envelope(S.PACKED, "PROCESSING", packed_at, _text("w", F.col("l_suppkey") % 5), line)),
        F.when(kept, _envelope(S.DISPATCHED, "PROCESSING", sent_at, carrier, line)),
        F.when(kept, _envelope(S.ITEM_DISPATCHED, "PROCESSING", _later(sent_at, 1), carrier, line)),
        F.when(
            kept & (F.col("o_orderstatus") != "O"),
            _envelope(S.STATE_CHANGED, S.COMPLETED, done_at, _text("d", F.col("l_partkey") % 9), line),
        ),
        F.when(
            ~kept & (line == 1) & (F.col("o_orderstatus") == "O"),
            _envelope(S.ANNULLED_ITEMS, "CANCELLED", _later(F.col("t0"), 12), _text("a", F.col("l_suppkey") % 3), line),
        ),
    )
    common = ["o_orderkey", "o_custkey", "o_orderstatus", "country", "year_month"]
    created = orders_base(spark, sf_dir).select(
        *common,
        _envelope(S.CREATED, "NEW", F.col("t0"), _text("c", F.col("o_custkey") % 7), F.lit(0)).alias("e"),
    )
    events = created.unionByName(
        _lines(spark, sf_dir).select(*common, F.explode(per_line).alias("e")).where(F.col("e").isNotNull())
    )
    key = F.col("o_orderkey").cast("string")
    at = F.col("e.text")  # written once per event, before the array is dealt out: filters and columns above share it
    return events.select(
        key.alias("h_logistic_order_id"),
        _text("so-", F.col("o_orderkey")).alias("h_source_order_id"),
        key.alias("d_logistic_order_id"),
        F.col("e.event_type").alias("h_event_type"),
        F.lit("FULFILMENT_ORDER").alias("h_entity_type"),
        F.col("country").alias("h_country"),
        _text("C", F.col("o_custkey") % 4).alias("h_commerce"),
        at.alias("h_datetime"),
        F.when(F.col("o_orderkey") % 53 == 0, "n/a").otherwise(at).alias("d_executed_at"),
        _as_text(F.col("e.at") + 300_000_000).alias("publish_time"),
        F.col("e.state").alias("d_state"),
        F.col("e.actor").alias("d_executed_by"),
        _text("FT", F.col("o_custkey") % 3).alias("d_fulfillment_order_type"),
        F.col("o_orderstatus").alias("d_source_order_type"),
        (F.col("o_custkey") % 11 == 0).alias("d_is_international"),
        F.col("e.version").alias("d_order_version"),
        "year_month",
    )


def raw_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent_at = _later(F.col("t0"), 49 + (13 * F.col("l_suppkey") + F.col("l_partkey")) % 96)
    promise = _as_text(F.col("promise"))
    base = F.create_map(
        F.lit("dateTo"), F.when(F.col("o_orderkey") % 17 == 0, "por confirmar").otherwise(promise),
        F.lit("dateFrom"), _as_text(_later(F.col("promise"), -24)),
        F.lit("serviceCategory"), F.col("o_orderpriority"),
        F.lit("timeRangeFrom"), F.lit("09:00"),
        F.lit("timeRangeTo"), F.lit("21:00"),
    )
    collect = F.map_concat(base, F.create_map(F.lit("collectAvailabilityDate"), promise))
    return _lines(spark, sf_dir).where("l_returnflag <> 'R'").select(
        F.col("o_orderkey").cast("string").alias("logistic_order_id"),
        _text("sh-", F.col("o_orderkey")).alias("shipment_id"),
        F.concat_ws("-", "o_orderkey", "l_linenumber").alias("package_id"),
        F.lit(S.DISPATCHED).alias("event_type"),
        _as_text(sent_at).alias("event_dt"),
        "country",
        F.lit(S.SHIPMENT_CONFIRMED).alias("package_status"),
        F.when(F.col("o_custkey") % 10 == 0, collect).otherwise(base).alias("promised_date"),
        F.lit(None).cast("double").alias("carrier"),
        F.lit(None).cast("double").alias("tracking_number"),
        "year_month",
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount"]
    li = table(spark, sf_dir, "lineitem").select(*columns)
    return (
        orders_base(spark, sf_dir)
        .join(li, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("logistic_order_id"),
            F.lit(S.CREATED).alias("event_type"),
            _as_text(F.col("t0")).alias("event_dt"),
            "country",
            F.col("l_partkey").alias("sku"),
            F.col("l_suppkey").alias("seller_id"),
            F.struct(F.col("l_quantity").alias("number"), F.lit("UN").alias("unit")).alias("quantity"),
            F.round(F.col("l_discount") * 100, 0).alias("reserved_quantity"),
            F.when(F.col("l_tax") > 0.04, 1).when(F.col("l_tax") > 0.0, 0).alias("has_insurance"),
            "year_month",
        )
    )


# Package status per event kind of the stream table.
STATUS_OF = {
    "signup": S.SHIPMENT_CONFIRMED,
    "view": S.IN_TRANSIT,
    "click": S.OUT_FOR_DELIVERY,
    "error": S.DELIVERY_ATTEMPTED,
    "purchase": S.EXCEPTION,
}


def package_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Package status log; ``event_id`` breaks ties of equal times."""
    status = F.lit(None).cast("string")
    for kind, name in STATUS_OF.items():
        status = F.when(F.col("event_type") == kind, name).otherwise(status)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("logistic_order_id"),
        _text("sh-", F.col("user_id")).alias("shipment_id"),
        F.when(F.col("event_id") % 97 != 0, F.concat_ws("-", "user_id", F.col("event_id") % 3)).alias("package_id"),
        "event_type",
        F.col("ts").alias("event_dt"),
        status.alias("package_status"),
        F.col("props").alias("promised_date"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
        "event_id",
    )


def carrier_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and data as JSON text, plus the month and the order of arrival."""
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus"]
    li = table(spark, sf_dir, "lineitem").select(*columns)
    df = orders_base(spark, sf_dir).join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    supplier = (F.col("l_suppkey") % 6).cast("string")
    code = F.when(F.col("l_linenumber") == 1, "  ").otherwise(F.concat(F.lit(" S"), supplier, F.lit(" ")))
    name = F.when(F.col("l_partkey") % 4 != 0, F.concat(F.lit("Carrier "), supplier))
    tracking = F.struct(code.alias("carrierCode"), name.alias("carrierName"))
    blank = F.struct(F.lit("").alias("carrierCode"), F.lit(None).cast("string").alias("carrierName"))
    packages = F.array(F.struct(blank.alias("trackingData")), F.struct(tracking.alias("trackingData")))
    items = F.array(F.struct(F.array(F.struct(packages.alias("packagesInfo"))).alias("states")))
    data = F.to_json(F.struct(items.alias("orderItems")))
    header = F.to_json(
        F.struct(
            F.when(F.col("l_linestatus") == "F", S.STATE_CHANGED).otherwise(S.PACKED).alias("eventType"),
            F.col("o_orderkey").cast("string").alias("logisticOrderId"),
            F.col("country"),
        )
    )
    return df.select(
        header.alias("header"),
        F.when(F.col("l_partkey") % 101 == 0, F.concat(F.lit("{broken "), data)).otherwise(data).alias("data"),
        "year_month",
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seen"),
    )


def stand_in_predictions(dataset: DataFrame, factor: int = 7919) -> DataFrame:
    """Predictions without a model: many tied probabilities, and hours off by at most two days."""
    key = F.col("logistic_order_id").cast("long")
    prob = ((key * factor) % 1000) / 1000.0
    return dataset.select(
        "logistic_order_id", "year_month", "split_set", "service_category",
        prob.cast("decimal(6,4)").alias("prob"),
        (prob >= 0.5).cast("smallint").alias("pred"),
        F.col("target_binario").cast("smallint").alias("target"),
        ((prob >= 0.5).cast("int") == F.col("target_binario")).cast("smallint").alias("hit"),
        F.col("target_horas_totales").alias("horas"),
        F.when(key % 101 == 0, F.lit(float("nan")))
        .otherwise(F.col("target_horas_totales") + (key % 97 - 48)).alias("horas_pred"),
    )


def new_order_requests(dataset: DataFrame, orders: DataFrame) -> DataFrame:
    """Requests like those for new orders, from the test split; some sellers and categories are new."""
    key = F.col("logistic_order_id").cast("long")
    rows = dataset.where(F.col("split_set") == "test").join(
        orders.select("logistic_order_id", "year_month", "created_at"), ["logistic_order_id", "year_month"]
    )
    return rows.select(
        F.col("logistic_order_id").alias("pedido"),
        F.when(key % 7 == 0, F.concat(F.lit("nuevo-"), "seller_id")).otherwise(F.col("seller_id")).alias("seller_id"),
        F.when(key % 35 == 0, "CATEGORIA NUEVA").otherwise(F.col("service_category")).alias("service_category"),
        F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        F.col("sla_horas_prometidas").alias("sla_horas"),
        "total_items", "distinct_skus", "is_click_and_collect", "is_high_season", "has_insurance",
    )


def itineraries(orders: DataFrame) -> DataFrame:
    """Orders with their milestones as an array of (timestamp, estado); every third array is out of order."""
    def step(column: str, state: str) -> Column:
        text = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(
            F.col(column).isNotNull(),
            F.struct(F.concat(text, F.lit("Z")).alias("timestamp"), F.lit(state).alias("estado")),
        )

    # columns of their own, so that texts are written by compiled code and once, not within the filter of the array
    steps = {
        "__ship": step("created_at", S.SHIPMENT_CONFIRMED), "__move": step("packed_at", S.IN_TRANSIT),
        "__out": step("dispatched_at", S.OUT_FOR_DELIVERY), "__tried": step("completed_at", S.DELIVERY_ATTEMPTED),
    }
    orders, (ship, move, out, tried) = orders.withColumns(steps), map(F.col, steps)
    key = F.col("logistic_order_id").cast("long")
    steps = F.when(key % 3 == 0, F.array(move, out, ship, tried, out)).otherwise(F.array(ship, move, out, tried))
    return orders.select(
        F.col("logistic_order_id").alias("pedido"), "service_category",
        F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        hours_between(F.col("created_at"), F.col("promised_date_to")).alias("sla_horas"),
        *[F.col(c).cast("int").alias(c) for c in ("is_click_and_collect", "is_high_season", "has_insurance")],
        "total_items", "distinct_skus",
        F.filter(steps, lambda e: e.isNotNull()).alias("eventos"),
    )
