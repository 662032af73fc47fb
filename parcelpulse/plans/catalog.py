"""Every registered query: the operators applied to the canonical logs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.operators import carriers as ca
from parcelpulse.operators import diagnostics as dg
from parcelpulse.operators import evaluation as ev
from parcelpulse.operators import features as ft
from parcelpulse.operators import flow as fl
from parcelpulse.operators import lookups as lk
from parcelpulse.operators import models as ml
from parcelpulse.operators import orders as fo
from parcelpulse.operators import quality as qc
from parcelpulse.operators import replay as rp
from parcelpulse.operators import scoring as sc
from parcelpulse.operators import timeline as tl
from parcelpulse.plans.warehouse import Warehouse, open_warehouse
from parcelpulse.session import new_folder, staged
from parcelpulse.sources import bindings as B
from parcelpulse.sources import readers, sinks, versions
from parcelpulse.sources import schemas as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(open_warehouse(spark, sf_dir))
    return fn


# --- staging and marts ---------------------------------------------------------------


@query
def stg_events(w: Warehouse) -> DataFrame:
    return w.stg_events


@query
def stg_packages(w: Warehouse) -> DataFrame:
    return w.stg_packages


@query
def stg_items(w: Warehouse) -> DataFrame:
    return w.stg_items


@query
def promise_per_order(w: Warehouse) -> DataFrame:
    return tl.promise_per_order(w.stg_packages)


@query
def order_timeline(w: Warehouse) -> DataFrame:
    return w.timeline


@query
def order_timeline_by_order(w: Warehouse) -> DataFrame:
    """One row per order id, in the month of its creation."""
    return tl.order_timeline(w.stg_events, w.stg_packages, w.vars.high_season, keys=("logistic_order_id",))


@query
def stage_baselines(w: Warehouse) -> DataFrame:
    return w.baselines.orderBy("year_month")


@query
def item_modes(w: Warehouse) -> DataFrame:
    return fo.item_summary(w.stg_items)


@query
def fact_orders(w: Warehouse) -> DataFrame:
    return w.orders


@query
def order_disruptions(w: Warehouse) -> DataFrame:
    return fo.ranked_for_review(w.disruptions)


# --- sources, sinks and quality ------------------------------------------------------


@query
def conform_scan(w: Warehouse) -> DataFrame:
    """Package log conformed to its fixed columns: casts, missing columns, dropped extras."""
    raw = B.raw_packages(w.spark, w.sf_dir).withColumn("extra", F.lit(1))
    return readers.conform(raw, S.PACKAGE_EVENTS)


@query
def month_scan(w: Warehouse) -> DataFrame:
    """Write the package log by country and month, then read some months of one country."""
    root = new_folder(w.spark, "month-scan")
    log = B.raw_packages(w.spark, w.sf_dir).select("logistic_order_id", "package_id", "event_dt", "country", "year_month")
    log.hint("rebalance", "country", "year_month").write.partitionBy("country", "year_month").parquet(root)
    kept = readers.scan_months(w.spark, root, "CL", ["1996-03", "1997-04", "1998-05"])
    return kept.groupBy("country", "year_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("logistic_order_id").alias("n_orders")
    )


@query
def month_reload_roundtrip(w: Warehouse) -> DataFrame:
    """Load all months, then those of 1997 again, of which March is empty now: nothing doubles or stays."""
    log = w.stored("package-log", lambda: w.package_log)
    path = new_folder(w.spark, "month-reload")
    sinks.reload_months(log, path)
    again = [f"1997-{m:02d}" for m in range(1, 13)]
    sinks.reload_months(log.where(F.col("year_month").isin(again) & (F.col("year_month") != "1997-03")), path, reloaded=again)
    return qc.reconcile(log, w.spark.read.schema(log.schema).parquet(path))


@query
def month_versions_roundtrip(w: Warehouse) -> DataFrame:
    """The same by manifests, with a load of 1997 that dies before its commit, one that is committed, and a sweep."""
    log = w.stored("package-log", lambda: w.package_log)
    path = new_folder(w.spark, "month-versions")
    again = [f"1997-{m:02d}" for m in range(1, 13)]
    versions.reload_months(log, path)
    versions.write_load(log.where("year_month = '1997-05'"), path)
    versions.reload_months(log.where(F.col("year_month").isin(again) & (F.col("year_month") != "1997-03")), path, again)
    versions.sweep(w.spark, path)
    return qc.reconcile(log, versions.read_months(w.spark, path, log.schema))


@query
def bucketed_upsert(w: Warehouse) -> DataFrame:
    """First carrier of each order, loaded month by month of a year into buckets: first seen wins, whatever the load."""
    path = new_folder(w.spark, "carriers-buckets")
    rows = w.carriers.select("logistic_order_id", "carrier_code", "seen", "year_month")
    for part in (F.col("year_month") < "1996-01", F.col("year_month") < "1998-01", F.col("year_month").isNotNull()):
        sinks.upsert_first_bucketed(rows.where(part), path, ["logistic_order_id"], ["year_month", "seen", "carrier_code"], 32)
    return w.spark.read.parquet(path).select("logistic_order_id", "carrier_code", "year_month")


def _two_month_carriers(w: Warehouse) -> DataFrame:
    """Envelopes of which every third is filed a month later, so that orders have carriers in two months."""
    later = F.date_format(F.add_months(F.to_date("year_month", "yyyy-MM"), 1), "yyyy-MM")
    return w.carriers.withColumn("year_month", F.when(F.col("seen.l_partkey") % 3 == 0, later).otherwise(F.col("year_month")))


@query
def carrier_months_merged(w: Warehouse) -> DataFrame:
    """The carriers of all orders from states that were loaded month group by month group, one of them twice."""
    rows, path = staged(_two_month_carriers(w), "two-month-carriers"), new_folder(w.spark, "carrier-state")
    ca.load_carrier_months(rows.where("year_month < '1998-01'"), path)
    ca.load_carrier_months(rows.where("year_month >= '1998-01'"), path)
    ca.load_carrier_months(rows.where("year_month like '1997%'"), path)
    return ca.carriers_of_state(versions.read_months(w.spark, path, ca.carrier_state(rows).schema))


@query
def missing_months_append(w: Warehouse) -> DataFrame:
    """Load three years, then append the months still missing; months already there stay."""
    log = w.package_log
    path = new_folder(w.spark, "missing-months")
    sinks.reload_months(log.where("year_month < '1998-01'"), path)
    sinks.append_missing_months(log, path)
    return w.spark.read.schema(log.schema).parquet(path).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("logistic_order_id").alias("n_orders")
    )


@query
def first_wins_upsert(w: Warehouse) -> DataFrame:
    """Carriers of even-numbered orders loaded first, then of all: an order keeps its stored row."""
    rows = w.carriers.select(
        "logistic_order_id", "carrier_code", "carrier_name", "year_month",
        F.col("seen.l_linenumber").alias("n1"), F.col("seen.l_partkey").alias("n2"), F.col("seen.l_suppkey").alias("n3"),
    )
    order = ["year_month", "n1", "n2", "n3", "carrier_code"]
    even = rows.where(F.col("logistic_order_id").cast("long") % 2 == 0)
    path = new_folder(w.spark, "carriers-upsert")
    sinks.upsert_first(even, path, ["logistic_order_id"], order, reload=True)
    for _ in range(2):
        sinks.upsert_first(rows, path, ["logistic_order_id"], order)
    return w.spark.read.parquet(path).select("logistic_order_id", "carrier_code", "carrier_name", "year_month")


def _note() -> Column:
    """A text that is hard to write down, by order."""
    kinds = ["plain", "tab\there", "line\nbreak", 'a "quote"', "", "\\N", None, "\\"]
    at = (F.col("logistic_order_id").cast("long") % len(kinds)).cast("int")
    return F.get(F.array(*[F.lit(k) for k in kinds]), at).alias("nota")


@query
def text_roundtrip(w: Warehouse) -> DataFrame:
    """CSV, tab-separated and JSON sinks written and read back: rows and NULLs survive.

    The note holds tabs, newlines, quotes, nothing, NULL and what the tab-separated sink writes
    for NULL; CSV goes without it.
    """
    base = new_folder(w.spark, "text")
    df = w.orders.select("logistic_order_id", "service_category", "actor_responsable", "hours_total", _note())
    notes = df.schema
    sinks.write_csv(df.drop("nota"), f"{base}/csv")
    sinks.write_tsv(df, f"{base}/tsv")
    sinks.write_json_sets({"orders": df, "legs": w.disruptions.groupBy("tramo_disruptivo").count()}, f"{base}/json")
    plain = w.spark.read.schema(df.drop("nota").schema).option("header", True).csv(f"{base}/csv")
    back = {
        "csv": plain.withColumn("nota", _note()),
        "tsv": sinks.read_tsv(w.spark, f"{base}/tsv", notes),
        "json": w.spark.read.schema(notes).json(f"{base}/json/orders"),
    }
    out = None
    for name, x in back.items():
        row = x.agg(
            F.count(F.lit(1)).alias("n"), F.count("actor_responsable").alias("n_actor"),
            F.count("hours_total").alias("n_hours"), F.round(F.sum("hours_total"), 2).alias("sum_hours"),
            F.count_if(F.col("nota").eqNullSafe(_note())).alias("n_nota"),
        ).select(F.lit(name).alias("formato"), "*")
        out = row if out is None else out.unionByName(row)
    assert out is not None
    return out


@query
def layer_materialisation(w: Warehouse) -> DataFrame:
    """A layer as a view and as a stored table by month hold the same rows."""
    view = sinks.as_view(w.disruptions, "stg_disruptions_view")
    stored = sinks.as_table(w.disruptions, new_folder(w.spark, "disruptions"), sort=F.col("logistic_order_id"))
    return qc.reconcile(view, stored)


@query
def replace_predictions(w: Warehouse) -> DataFrame:
    """Predictions written twice over: the second write replaces the first."""
    path = new_folder(w.spark, "predictions")
    rows = B.stand_in_predictions(w.dataset).drop("horas", "horas_pred")
    sinks.replace_predictions(rows, path)
    sinks.replace_predictions(rows, path)
    stored = w.spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("split_set").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("hit").cast("long")).alias("n_hit"),
        F.round(F.sum(F.col("prob").cast("double")), 4).alias("sum_prob"),
    )


@query
def nested_to_json(w: Warehouse) -> DataFrame:
    flat = sinks.flatten_nested(B.raw_packages(w.spark, w.sf_dir))
    return flat.select(
        "logistic_order_id", "package_id", "event_dt",
        F.get_json_object("promised_date", "$.serviceCategory").alias("service_category"),
        F.get_json_object("promised_date", "$.dateTo").alias("date_to"),
        F.get_json_object("promised_date", "$.collectAvailabilityDate").alias("collect_date"),
    )


@query
def reconcile_counts(w: Warehouse) -> DataFrame:
    """Raw orders against the timeline per month; months with filtered orders do not match."""
    source = w.source("orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))
    return qc.reconcile(source, w.timeline)


@query
def load_report(w: Warehouse) -> DataFrame:
    return qc.load_report(w.package_log.unionByName(w.package_events, allowMissingColumns=True))


@query
def not_null_report(w: Warehouse) -> DataFrame:
    events = B.raw_events(w.spark, w.sf_dir)
    return qc.null_report({
        "events": (events, ["h_logistic_order_id", "h_event_type", "h_country", "h_datetime"]),
        "event_items": (B.raw_items(w.spark, w.sf_dir), ["logistic_order_id", "has_insurance"]),
        "event_packages": (B.raw_packages(w.spark, w.sf_dir), ["logistic_order_id", "carrier"]),
    })


@query
def accepted_values(w: Warehouse) -> DataFrame:
    """Countries that the log should not hold; every 97th order is given one."""
    events = B.raw_events(w.spark, w.sf_dir)
    foreign = F.col("h_logistic_order_id").cast("long") % 97 == 0
    return qc.accepted_values(events.withColumn("h_country", F.when(foreign, "AR").otherwise(F.col("h_country"))), "h_country", S.COUNTRIES)


@query
def duplicate_keys(w: Warehouse) -> DataFrame:
    return qc.duplicate_keys(w.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def key_report(w: Warehouse) -> DataFrame:
    return qc.key_report(w.orders, ["logistic_order_id"])


# --- event flow and carriers ---------------------------------------------------------


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


FLOW_HOURS = S.FLOW_NUMERIC[:4]


@query
def flow_features(w: Warehouse) -> DataFrame:
    return _rounded(w.flow, *FLOW_HOURS)


@query
def flow_attached(w: Warehouse) -> DataFrame:
    joined = fl.attach_flow(w.dataset.select("logistic_order_id", "year_month"), w.flow)
    return _rounded(joined, *FLOW_HOURS)


@query
def flow_from_array(w: Warehouse) -> DataFrame:
    rows = B.itineraries(w.orders).select("pedido", "eventos")
    return _rounded(fl.flow_from_array(rows).drop("eventos"), *FLOW_HOURS)


@query
def carrier_first(w: Warehouse) -> DataFrame:
    return w.carriers.select(
        "logistic_order_id", F.col("seen.l_linenumber").alias("n1"), F.col("seen.l_partkey").alias("n2"),
        F.col("seen.l_suppkey").alias("n3"), "carrier_code", "carrier_name", "year_month",
    )


@query
def carrier_mode(w: Warehouse) -> DataFrame:
    return w.carrier_per_order


@query
def carrier_earliest_month(w: Warehouse) -> DataFrame:
    return ca.carrier_earliest_month(w.carriers)


@query
def carrier_coverage(w: Warehouse) -> DataFrame:
    return ca.carrier_coverage(ca.attach_carrier(w.dataset, w.carrier_per_order), ["split_set"])


@query
def top_carriers(w: Warehouse) -> DataFrame:
    return ca.top_carriers(w.carrier_per_order, 10)


@query
def carrier_search(w: Warehouse) -> DataFrame:
    """Rows of one carrier among files with and without the column, found below one folder."""
    root = new_folder(w.spark, "tracking")
    found = w.carriers.select("logistic_order_id", F.col("carrier_code").alias("carrier"), "year_month")
    found.hint("rebalance", "year_month").write.partitionBy("year_month").parquet(f"{root}/with/deep")
    found.select("logistic_order_id", "year_month").write.parquet(f"{root}/without")
    tree = readers.scan_tree(w.spark, root, partitions=["year_month"])
    return readers.search_equal(tree, "carrier", "S3").select("logistic_order_id", "carrier", "year_month")


# --- feature tables ------------------------------------------------------------------


@query
def ml_dataset(w: Warehouse) -> DataFrame:
    return w.dataset


@query
def historical_rates(w: Warehouse) -> DataFrame:
    return _rounded(w.history, *ft.RATES)


@query
def dataset_join_history(w: Warehouse) -> DataFrame:
    """Dataset with history and carrier, unknown carriers named as such."""
    joined = ca.attach_carrier(w.dataset_with_history, w.carrier_per_order)
    return _rounded(
        joined.select("logistic_order_id", "split_set", "carrier_code", "target_binario", *S.HISTORY_NUMERIC), *ft.RATES
    )


@query
def leg_population(w: Warehouse) -> DataFrame:
    rows = ft.leg_population(w.orders, B.SPLITS, ["hours_deposito", "hours_despacho", "hours_ultima_milla"])
    return rows.select(
        "logistic_order_id", "split_set", "hours_deposito", "hours_despacho", "hours_ultima_milla",
        ft.leg_class(F.col("target_tramo")).alias("clase_tramo"),
    )


@query
def hours_population(w: Warehouse) -> DataFrame:
    return ft.hours_population(w.dataset).select(
        "logistic_order_id", "split_set", "target_horas_totales", "sla_horas_prometidas", "desvio_sla"
    )


@query
def read_by_month(w: Warehouse) -> DataFrame:
    """Some months of a stored feature table, some columns, in one scan."""
    months = ["1999-01", "1999-02", "2000-05", "2001-03"]
    return readers.read_features(
        w.dataset_with_history, months=months, columns=["logistic_order_id", "year_month", "split_set", "total_items"]
    )


# --- diagnostics ---------------------------------------------------------------------


def _population(w: Warehouse) -> DataFrame:
    return ft.hours_population(w.dataset)


@query
def dist_by_class(w: Warehouse) -> DataFrame:
    probs = (0.05, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
    return dg.describe_by(dg.with_class(_population(w)), dg.HOURS, ["target_binario", "clase"], probs, spread=True)


@query
def dist_by_category(w: Warehouse) -> DataFrame:
    rows = dg.with_class(_population(w))
    return dg.describe_by(rows, dg.HOURS, ["service_category", "clase"], (0.50, 0.90, 0.99), spread=False)


@query
def pivot_ratio(w: Warehouse) -> DataFrame:
    return dg.pivot_ratio(dist_by_category(w))


@query
def stratified_sample(w: Warehouse) -> DataFrame:
    rows = dg.with_class(_population(w)).select("logistic_order_id", "clase", dg.HOURS)
    return dg.sample_per_class(rows, "clase", "logistic_order_id", 1000)


@query
def histogram(w: Warehouse) -> DataFrame:
    return dg.histogram(dg.with_class(_population(w)), dg.HOURS, "clase")


@query
def sample_summary(w: Warehouse) -> DataFrame:
    rows = dg.with_class(_population(w)).select("logistic_order_id", "clase", dg.HOURS)
    return dg.sample_summary(dg.sample_per_class(rows, "clase", "logistic_order_id", 1000), dg.HOURS, "clase")


@query
def sla_validity(w: Warehouse) -> DataFrame:
    return dg.sla_validity(_population(w))


@query
def sla_by_category(w: Warehouse) -> DataFrame:
    return dg.sla_by_category(_population(w))


@query
def sla_top_sellers(w: Warehouse) -> DataFrame:
    return dg.sla_top_sellers(_population(w))


@query
def sla_filter_impact(w: Warehouse) -> DataFrame:
    return dg.sla_filter_impact(_population(w))


@query
def deviation_buckets(w: Warehouse) -> DataFrame:
    return dg.deviation_buckets(_population(w))


# --- lookups -------------------------------------------------------------------------


def _keys(w: Warehouse) -> DataFrame:
    return B.new_order_requests(w.dataset, w.orders).select("seller_id", "service_category").distinct()


@query
def seller_history(w: Warehouse) -> DataFrame:
    return lk.history_lookup(_keys(w), w.dataset_with_history)


@query
def failing_legs(w: Warehouse) -> DataFrame:
    return lk.failing_legs(_keys(w), w.disruptions)


@query
def order_journey(w: Warehouse) -> DataFrame:
    return lk.journey(w.package_events)


@query
def package_journeys(w: Warehouse) -> DataFrame:
    return lk.package_summary(lk.journey(w.package_events))


@query
def order_360(w: Warehouse) -> DataFrame:
    return lk.order_360(_rounded(w.dataset_with_history, *ft.RATES), lk.event_digest(w.package_events))


@query
def order_events_until(w: Warehouse) -> DataFrame:
    """Base row of each order with its events up to a moment, as counts and last time."""
    seen = lk.events_until(w.package_events, "2024-01-12 00:00:00").groupBy("logistic_order_id").agg(
        F.count(F.lit(1)).alias("n_eventos"), F.max("event_dt").alias("ultimo_evento")
    )
    return lk.order_base(_rounded(w.dataset_with_history, *ft.RATES)).join(seen, "logistic_order_id", "left")


def _moments(w: Warehouse) -> DataFrame:
    """Five moments of each order of its own, counted from its first event."""
    first = w.package_events.groupBy("logistic_order_id").agg(F.min("event_dt").alias("first"))
    hours = F.explode(F.array(*[F.lit(h) for h in (-1, 0, 36, 240, 2000)])).alias("horas")
    return first.select("logistic_order_id", "first", hours).select(
        "logistic_order_id", "horas", F.timestamp_add("HOUR", F.col("horas"), F.col("first")).alias("momento")
    )


@query
def order_state_at(w: Warehouse) -> DataFrame:
    """What was known of each order at moments of its own."""
    return lk.state_at(_moments(w), w.package_events)


@query
def package_event_pages(w: Warehouse) -> DataFrame:
    """Event lists of each package in pages of ten, as text."""
    pages = lk.package_pages(lk.journey(w.package_events), 10)
    as_text = F.transform("eventos", lambda e: F.concat_ws("|", e.n_evento, F.date_format(e.event_dt, "yyyy-MM-dd HH:mm:ss"), e.event_type, e.package_status))
    return pages.select("logistic_order_id", "package_key", "pagina", F.array_join(as_text, ";").alias("eventos"), "ultimo_estado", "horas_max_gap")


@query
def order_event_rows(w: Warehouse) -> DataFrame:
    """The events themselves up to a moment."""
    seen = lk.events_until(w.package_events, "2024-01-12 00:00:00")
    return seen.select("logistic_order_id", "package_id", "event_id", "event_dt", "package_status")


@query
def rate_by_calendar(w: Warehouse) -> DataFrame:
    return lk.rate_by_calendar(w.dataset, "3-MEDIUM")


# --- models --------------------------------------------------------------------------

LEG_CLASSES = ("deposito_despacho", "sin_disrupcion", "ultima_milla")
#: The legs' classes are nearly separable: at the library's step they gain a little in each of 1,000 rounds, which
#: takes ten minutes on the small tables. These settings end sooner; see README.
LEG_TREES = ml.TreeSettings(rounds=150, step=0.3)
#: Rounds of the first and of each later period; the library's own are 200 and 50.
CONTINUED = (40, 10)
BY_ORDER = ["logistic_order_id", "year_month", "split_set"]


def _risk(w: Warehouse) -> ml.Fitted:
    """Creation features with history; the validation split decides how many rounds are kept."""
    def build() -> ml.Fitted:
        df = w.dataset_with_history
        numeric = [*S.CREATION_NUMERIC, *S.HISTORY_NUMERIC]
        enc = ml.fit_encoder(readers.read_features(df, "train"), numeric, ["service_category", "franja_horaria"])
        return ml.fit_risk(df, enc)

    return w.model("risk", build)


def _flow_risk(w: Warehouse) -> ml.Fitted:
    """Creation features, history and event flow."""
    def build() -> ml.Fitted:
        df = staged(w.dataset_with_flow, "flow-dataset")
        numeric = [*S.CREATION_NUMERIC, *S.HISTORY_NUMERIC, *S.FLOW_NUMERIC]
        enc = ml.fit_encoder(readers.read_features(df, "train"), numeric, S.FLOW_CATEGORICAL)
        return ml.fit_risk(df, enc)

    return w.model("flow-risk", build)


def _fitted_at_once(fits: Sequence[Callable[[], ml.Fitted]]) -> list[ml.Fitted]:
    """Models that do not need each other, fitted side by side: a round is mostly waiting for its jobs to begin and end."""
    with ThreadPoolExecutor(len(fits)) as side_by_side:
        return [f.result() for f in [side_by_side.submit(fit) for fit in fits]]


def _both_risks(w: Warehouse) -> list[ml.Fitted]:
    """The creation model and the flow model."""
    w.dataset_with_flow  # stored layers are built once, before both fits read them
    return _fitted_at_once([partial(_risk, w), partial(_flow_risk, w)])


@query
def encode_features(w: Warehouse) -> DataFrame:
    """Labels learned from one month only, so that later values fall to the unknown label."""
    enc = ml.fit_encoder(
        w.train, S.CREATION_NUMERIC, ["service_category", "source_order_type", "seller_id", "created_by"],
        months=["1995-02"],
    )
    coded = ml.encode(w.dataset, enc, ["logistic_order_id"])
    return coded.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in S.CREATION_NUMERIC})


@query
def class_weights(w: Warehouse) -> DataFrame:
    return ml.class_weights(w.train.withColumn("clase", ft.leg_class(F.col("target_tramo"))), "clase")


@query
def classifier_scores(w: Warehouse) -> DataFrame:
    return ml.predictions(_risk(w), w.dataset_with_history)


@query
def flow_classifier_scores(w: Warehouse) -> DataFrame:
    return ml.predictions(_flow_risk(w), w.dataset_with_flow)


@query
def classifier_quality(w: Warehouse) -> DataFrame:
    """Metrics of both trained classifiers side by side."""
    risk, flow_risk = _both_risks(w)
    a = staged(ml.predictions(risk, w.dataset_with_history), "scores")
    b = staged(ml.predictions(flow_risk, w.dataset_with_flow), "scores")
    return ev.compare({"creacion": ev.binary_metrics(a), "flujo": ev.binary_metrics(b)})


@query
def leg_scores(w: Warehouse) -> DataFrame:
    return leg_scores_of(w)


def leg_scores_of(w: Warehouse) -> DataFrame:
    legs = ["hours_deposito", "hours_despacho", "hours_ultima_milla"]
    rows = ft.leg_population(w.orders, B.SPLITS, legs).withColumn("clase", ft.leg_class(F.col("target_tramo")))
    rows = staged(rows, "leg-rows")
    def build() -> ml.Fitted:
        enc = ml.fit_encoder(readers.read_features(rows, "train"), [*S.CREATION_NUMERIC, *legs], ["service_category"])
        return ml.fit_leg(rows, enc, "clase", LEG_CLASSES, LEG_TREES)

    fitted = w.model("leg", build)
    return ml.leg_predictions(fitted, rows, [*BY_ORDER, "clase"])


@query
def leg_scores_of_four(w: Warehouse) -> DataFrame:
    """Depot and dispatch apart, from creation features and the hours of each leg."""
    legs = ["hours_deposito", "hours_despacho", "hours_ultima_milla"]
    rows = staged(ft.leg_population(w.orders, B.SPLITS, legs).withColumn("clase", F.col("target_tramo")), "four-leg-rows")

    def build() -> ml.Fitted:
        enc = ml.fit_encoder(readers.read_features(rows, "train"), [*S.CREATION_NUMERIC, *legs], ["service_category"])
        classes = [r.clase for r in rows.select("clase").distinct().orderBy("clase").collect()]  # four
        return ml.fit_leg(rows, enc, "clase", classes, LEG_TREES)

    return ml.leg_predictions(w.model("four-legs", build), rows, [*BY_ORDER, "clase"])


def _continued(w: Warehouse) -> ml.Continued:
    """The creation model continued from year to year of training."""
    def build() -> ml.Continued:
        rows = w.dataset_with_history.withColumn("anio", F.left("year_month", F.lit(4)))
        numeric = [*S.CREATION_NUMERIC, *S.HISTORY_NUMERIC]
        return ml.fit_risk_continued(rows, numeric, ["service_category", "franja_horaria"], first=CONTINUED[0], more=CONTINUED[1], period="anio")

    return w.model("continued", build)


@query
def continued_boosting(w: Warehouse) -> DataFrame:
    """What each year added to the trees, and the validation loss after it."""
    c = _continued(w)
    rows = [(p, len(part.trees), loss) for p, part, loss in zip(c.periods, c.parts, c.losses)]
    return w.spark.createDataFrame(rows, "periodo string, arboles int, perdida double")


@query
def boosting_curve(w: Warehouse) -> DataFrame:
    """Validation loss of the creation model after each round, and which rounds are kept."""
    return ml.curve_table(w.spark, _risk(w))


def _hours_fit(w: Warehouse, target: str, with_sla: bool) -> ml.Fitted:
    rows = ft.hours_population(w.dataset)
    numeric = [c for c in S.CREATION_NUMERIC if with_sla or c != "sla_horas_prometidas"]
    offset = ml.DEVIATION_OFFSET if target == "desvio_sla" else 0.0

    def build() -> ml.Fitted:
        enc = ml.fit_encoder(readers.read_features(rows, "train"), numeric, ["service_category", "source_order_type"])
        return ml.fit_hours(rows, enc, target, offset)

    return w.model(f"hours-{target}-{with_sla}", build)


def _hours(w: Warehouse, target: str, with_sla: bool) -> DataFrame:
    rows = ft.hours_population(w.dataset)
    fitted = _hours_fit(w, target, with_sla)
    return ml.hours_predictions(fitted, rows.withColumn("horas", F.col(target)), [*BY_ORDER, "horas"])


@query
def hours_regression(w: Warehouse) -> DataFrame:
    return _hours(w, "target_horas_totales", with_sla=True)


@query
def experiment_grid(w: Warehouse) -> DataFrame:
    """Target and SLA feature varied; a finished experiment is read, not fitted again."""
    path = new_folder(w.spark, "experiments")
    grid = {"reg_v2a": ("desvio_sla", True), "reg_v2b": ("desvio_sla", False), "reg_v2c": ("target_horas_totales", False)}
    w.orders  # stored before the fits read it
    _fitted_at_once([partial(_hours_fit, w, *varied) for varied in grid.values()])
    for name in [*grid, "reg_v2a"]:
        target, with_sla = grid[name]
        sinks.run_once(
            w.spark, path, name, lambda target=target, with_sla=with_sla: ev.regression_report(_hours(w, target, with_sla))
        )
    return w.spark.read.parquet(path)


@query
def feature_importance(w: Warehouse) -> DataFrame:
    """The ten features of most gain."""
    return ml.importance(_risk(w), w.dataset).limit(10)


@query
def score_new_orders(w: Warehouse) -> DataFrame:
    return sc.score_new_orders(B.new_order_requests(w.dataset, w.orders), w.dataset_with_history, _risk(w))


@query
def new_order_features(w: Warehouse) -> DataFrame:
    df = sc.new_order_features(B.new_order_requests(w.dataset, w.orders), w.dataset_with_history)
    return df.select(
        "pedido", "fuente", "dia_semana_creacion", "hora_creacion", "dia_mes_creacion", "franja_horaria",
        "sla_horas_prometidas", "n_ordenes", *S.HISTORY_NUMERIC,
    )


@query
def score_itineraries(w: Warehouse) -> DataFrame:
    return sc.score_itineraries(B.itineraries(w.orders), w.dataset_with_history, _flow_risk(w))


# Checks of the trained models: what must hold for each row whatever the trees are, with the row's key and label.


def _checked_scores(scored: DataFrame) -> DataFrame:
    p = F.col("prob").cast("double")
    return scored.select(
        *BY_ORDER, "service_category", "target",
        p.between(0, 1).alias("prob_ok"),
        # the class is taken from the exact probability, the score is rounded to four digits
        ((F.abs(p - 0.5) < 0.0001) | (F.col("pred") == (p >= 0.5).cast("int"))).alias("pred_ok"),
        ((F.col("hit") == 1) == (F.col("pred") == F.col("target"))).alias("hit_ok"),
    )


@query
def classifier_scores_checked(w: Warehouse) -> DataFrame:
    return _checked_scores(ml.predictions(_risk(w), w.dataset_with_history))


@query
def flow_classifier_scores_checked(w: Warehouse) -> DataFrame:
    return _checked_scores(ml.predictions(_flow_risk(w), w.dataset_with_flow))


@query
def classifier_quality_checked(w: Warehouse) -> DataFrame:
    """Rows per split, and whether each classifier has more than one tree and ranks better than a floor."""
    out = None
    risk, flow_risk = _both_risks(w)
    for name, fitted, rows in (("creacion", risk, w.dataset_with_history), ("flujo", flow_risk, w.dataset_with_flow)):
        auc = ev.roc_auc(ml.predictions(fitted, rows)).select(
            F.lit(name).alias("modelo"), "split_set", (F.col("n_pos") + F.col("n_neg")).cast("long").alias("n"),
            (F.col("auc") > 0.6).alias("auc_ok"), F.lit(len(fitted.model.trees) > 1).alias("boosted"),
        )
        out = auc if out is None else out.unionByName(auc)
    return out


#: A split of fewer rows is too small to hold a model against a floor.
LEAST_JUDGED = 800


def _checked_legs(scored: DataFrame, least_f1: float) -> DataFrame:
    """Rows with their class, and whether macro F1 of their split is above a floor."""
    scored = staged(scored, "leg-scores")
    report = ev.class_report(scored.withColumnRenamed("clase", "target")).where("clase = 'macro avg'")
    good = staged(report.select("split_set", ((F.col("f1") > least_f1) | (F.col("support") < LEAST_JUDGED)).alias("f1_ok")), "leg-quality")
    return scored.join(good, "split_set").select(*BY_ORDER, "clase", F.col("pred").isNotNull().alias("pred_ok"), "f1_ok")


@query
def leg_scores_checked(w: Warehouse) -> DataFrame:
    return _checked_legs(leg_scores_of(w), 0.6)


@query
def leg_scores_of_four_checked(w: Warehouse) -> DataFrame:
    return _checked_legs(leg_scores_of_four(w), 0.4)


def _loss_errors(w: Warehouse, c: ml.Continued) -> tuple[list[float], float]:
    """Standard errors of the mean validation losses after each year, and of the last one's change since the first.

    They are those of labels drawn by the model's own odds, so they are known for any number of rows.
    """
    val = w.dataset_with_history.where("split_set = 'val'")
    scored, margin, margins = c.fitted.vectors(val, []), F.lit(0.0), []
    for nth, part in enumerate(c.parts):
        scored = part.regression(f"__m{nth}").transform(scored)
        margin = margin + F.col(f"__m{nth}")
        margins.append(margin)
    steps = [(m, m) for m in margins] + [(margins[-1], margins[-1] - margins[0])]

    def error(m: Column, step: Column) -> Column:
        p = 1 / (1 + F.exp(-m))
        return F.coalesce(F.sqrt(F.avg(p * (1 - p) * step * step) / F.count(F.lit(1))), F.lit(0.0))

    found = scored.agg(*[error(m, step).alias(f"e{nth}") for nth, (m, step) in enumerate(steps)]).first()  # one row
    return list(found[:-1]), found[-1]


@query
def continued_boosting_checked(w: Warehouse) -> DataFrame:
    """Trees of each year as asked for, and losses better than chance that end no worse than after the first year.

    Each loss may be three of its standard errors off, which are next to nothing where rows are many.
    """
    c, n = _continued(w), CONTINUED
    errors, of_change = _loss_errors(w, c)
    judged = c.losses[0] is not None  # without validation rows there is no loss
    no_worse = not judged or bool(c.losses[-1] <= c.losses[0] + 0.02 + 3 * of_change)
    rows = [
        (p, len(part.trees), not judged or bool(loss < 0.69 + 3 * e), no_worse) for p, part, loss, e in zip(c.periods, c.parts, c.losses, errors)
    ]
    if len(c.whole.trees) != 1 + n[0] + n[1] * (len(rows) - 1):
        raise ValueError("trees are missing")
    return w.spark.createDataFrame(rows, "periodo string, arboles int, perdida_ok boolean, no_peor boolean")


@query
def boosting_curve_checked(w: Warehouse) -> DataFrame:
    """Whether the kept rounds are those up to the least loss, and patience or the limit ended the fit."""
    curve, kept = _risk(w).curves[0], _risk(w).model.getNumTrees
    least = min(curve[:kept])
    rows = [(bool(curve[kept - 1] == least), bool(min(curve[: kept + 50]) == least), len(curve) <= 1000)]
    return w.spark.createDataFrame(rows, "ultimo_es_minimo boolean, paciencia_ok boolean, limite_ok boolean")


@query
def feature_importance_checked(w: Warehouse) -> DataFrame:
    """Every feature once, gains from 0 to 1 that add up to 1, and splits where there is gain."""
    found = ml.importance(_risk(w), w.dataset)
    total = found.agg(F.abs(F.sum("importance_gain") - 1) < 1e-6).scalar()
    gain, n = F.col("importance_gain"), F.col("importance_split")
    return found.select("feature", gain.between(0, 1).alias("gain_ok"), ((gain > 0) == (n > 0)).alias("split_ok"), total.alias("suma_ok"))


@query
def experiment_grid_checked(w: Warehouse) -> DataFrame:
    """One run of each experiment and split, its rows counted, with errors that fit each other."""
    grid = experiment_grid(w)
    fine = (F.col("rmse_horas") >= F.col("mae_horas")) & (F.col("mae_horas") >= 0) & (F.col("error_p95") >= F.col("error_p50"))
    # a split of noise may do no better than its mean
    return grid.select("experimento", "split_set", F.col("n").cast("long").alias("n"), fine.alias("errores_ok"), ((F.col("r2") > -0.1) | (F.col("n") < LEAST_JUDGED)).alias("r2_ok"))


@query
def hours_regression_checked(w: Warehouse) -> DataFrame:
    """Rows of each order with their hours, and whether R2 of the split is above a floor."""
    hours = staged(_hours(w, "target_horas_totales", with_sla=True), "hours-scores")
    fine = (F.col("horas_pred") >= 0) & (F.col("horas_pred") < 1e6)
    good = staged(ev.regression_report(hours).select("split_set", ((F.col("r2") > 0.3) | (F.col("n") < LEAST_JUDGED)).alias("r2_ok")), "hours-quality")
    return hours.join(good, "split_set").select(*BY_ORDER, F.round("horas", 4).alias("horas"), fine.alias("pred_ok"), "r2_ok")


@query
def score_new_orders_checked(w: Warehouse) -> DataFrame:
    scored = sc.score_new_orders(B.new_order_requests(w.dataset, w.orders), w.dataset_with_history, _risk(w))
    return scored.select(
        "pedido", "fuente", F.col("prob").between(0, 1).alias("prob_ok"),
        (F.abs(F.col("porcentaje") - F.col("prob") * 100) <= 0.0501).alias("porcentaje_ok"),
    )


@query
def score_itineraries_checked(w: Warehouse) -> DataFrame:
    scored = sc.score_itineraries(B.itineraries(w.orders), w.dataset_with_history, _flow_risk(w))
    return scored.select(
        "pedido", F.col("prob").between(0, 1).alias("prob_ok"), (F.col("nivel_riesgo") == ml.risk_level(F.col("prob"))).alias("nivel_ok")
    )


@query
def replay_with_model_checked(w: Warehouse) -> DataFrame:
    scored = replay_scores_of(w)
    return scored.groupBy("logistic_order_id").agg(
        F.count(F.lit(1)).alias("n_hitos"), F.bool_and(F.col("prob").between(0, 1)).alias("prob_ok")
    )


# --- evaluation ----------------------------------------------------------------------


def _predictions(w: Warehouse, factor: int = 7919) -> DataFrame:
    return B.stand_in_predictions(w.dataset, factor)


@query
def confusion(w: Warehouse) -> DataFrame:
    return ev.confusion(_predictions(w))


@query
def confusion_matrix(w: Warehouse) -> DataFrame:
    return ev.confusion_matrix(_predictions(w), [0, 1])


@query
def class_report(w: Warehouse) -> DataFrame:
    return ev.class_report(_predictions(w))


@query
def leg_class_report(w: Warehouse) -> DataFrame:
    """The three-class report, of predictions that go round the classes by order."""
    names = F.array(*[F.lit(c) for c in LEG_CLASSES])
    key = F.col("logistic_order_id").cast("long")
    rows = w.dataset.select(
        "split_set", ft.leg_class(F.col("target_tramo")).alias("target"), F.get(names, (key % 3).cast("int")).alias("pred")
    )
    return ev.class_report(rows)


@query
def roc_auc(w: Warehouse) -> DataFrame:
    return ev.roc_auc(_predictions(w))


@query
def avg_precision(w: Warehouse) -> DataFrame:
    return ev.avg_precision(_predictions(w))


@query
def regression_metrics(w: Warehouse) -> DataFrame:
    return ev.regression_report(_predictions(w))


@query
def risk_shares(w: Warehouse) -> DataFrame:
    return ev.risk_shares(_predictions(w))


@query
def split_report(w: Warehouse) -> DataFrame:
    return ev.split_report(_predictions(w))


@query
def split_sizes(w: Warehouse) -> DataFrame:
    return ev.split_sizes(w.dataset)


@query
def category_report(w: Warehouse) -> DataFrame:
    return ev.category_report(_predictions(w))


@query
def version_delta(w: Warehouse) -> DataFrame:
    return ev.compare({
        "v1": ev.binary_metrics(_predictions(w)), "v2": ev.binary_metrics(_predictions(w, 104729)),
    })


@query
def class_distribution(w: Warehouse) -> DataFrame:
    return ev.class_distribution(w.dataset, ft.leg_class(F.col("target_tramo")))


# --- replay --------------------------------------------------------------------------


@query
def status_changes(w: Warehouse) -> DataFrame:
    return rp.status_changes(w.package_events)


@query
def prefix_features(w: Warehouse) -> DataFrame:
    return _rounded(rp.prefix_features(w.package_events), *FLOW_HOURS)


def _scored(w: Warehouse) -> DataFrame:
    return rp.prefix_features(w.package_events).withColumn("prob", rp.stand_in_risk())


@query
def first_alert(w: Warehouse) -> DataFrame:
    return rp.first_alert(_scored(w))


@query
def replay_summary(w: Warehouse) -> DataFrame:
    return rp.replay_summary(_scored(w), rp.order_outcomes(w.dataset))


@query
def replay_with_model(w: Warehouse) -> DataFrame:
    """The flow model's risk at every status change of every order with events."""
    return replay_scores_of(w)


def replay_scores_of(w: Warehouse) -> DataFrame:
    known = ft.one_per_order(w.dataset_with_history).drop("year_month")
    rows = rp.prefix_features(w.package_events).join(known, "logistic_order_id")
    keep = ["logistic_order_id", "n_hito", "event_dt", "package_status", "n_hito_eventos"]
    return ml.score(_flow_risk(w), rows.withColumn("n_hito_eventos", F.col("n_eventos_total")), keep)
