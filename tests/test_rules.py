"""Small hand-made cases for the rules that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from parcelpulse.functions.times import day_band, hours_between, parse_iso, weekday
from parcelpulse.operators import baselines, boosting, carriers, evaluation, features, flow, lookups, models, orders, quality, scoring
from parcelpulse.operators import replay, staging, timeline
from parcelpulse.sources import bindings
from parcelpulse.sources import schemas as S

T = dt.datetime
VARS = S.JobVars(min_date="2025-01-01", high_season=("2025-06",))
EVENT = "logistic_order_id string, event_type string, event_at timestamp_ntz, order_state string, executed_by string, " \
        "source_order_type string, fulfillment_order_type string, year_month string"
PACKAGE = "logistic_order_id string, event_type string, promised_date_to string, promised_date_from string, " \
          "service_category string, is_click_and_collect boolean"


def _timeline(spark, events, packages=(), **kw):
    e = spark.createDataFrame([(*r[:5], "A", "F", r[5]) for r in events], EVENT)
    p = spark.createDataFrame([(o, S.DISPATCHED, to, None, "REGULAR", False) for o, to in packages], PACKAGE)
    return timeline.order_timeline(e, p, VARS.high_season, **kw)


def test_an_order_over_two_months_has_two_rows_or_one(spark):
    events = [
        ("1", S.CREATED, T(2025, 1, 31, 20), "NEW", "x", "2025-01"),
        ("1", S.PACKED, T(2025, 2, 1, 2), "PROCESSING", "y", "2025-02"),
    ]
    assert _timeline(spark, events).count() == 2
    row = _timeline(spark, events, keys=("logistic_order_id",)).first()
    assert (row.year_month, row.hours_created_to_packed) == ("2025-01", 6.0)


def test_last_state_and_actor_are_largest_not_latest(spark):
    row = _timeline(spark, [
        ("1", S.PACKED, T(2025, 1, 1, 5), "ZZ", "b", "2025-01"),
        ("1", S.PACKED, T(2025, 1, 1, 6), "AA", "a", "2025-01"),
    ]).first()
    assert (row.last_state, row.last_state_in_time, row.packed_by, row.packed_at) == ("ZZ", "AA", "b", T(2025, 1, 1, 5))
    assert (row.total_events, row.total_actors, row.total_event_types) == (2, 2, 1)


@pytest.mark.parametrize("promise, breach", [
    ("2025-01-03 00:00:00", False), ("2025-01-02 23:59:59", True), ("por confirmar", None), (None, None),
])
def test_breach_is_strict_and_three_valued(spark, promise, breach):
    row = _timeline(spark, [
        ("1", S.CREATED, T(2025, 1, 1), "NEW", "c", "2025-01"), ("1", "X", T(2025, 1, 3), "COMPLETED", "d", "2025-01"),
    ], [("1", promise)]).first()
    assert row.is_sla_breach is breach
    assert (row.hours_sla_delta is None) == (breach is None)
    assert (row.is_completed, row.is_stuck, row.hours_total_cycle) == (True, False, 48.0)


def test_stuck_and_negative_duration(spark):
    rows = {r.logistic_order_id: r for r in _timeline(spark, [
        ("1", S.CREATED, T(2025, 6, 1), "NEW", "c", "2025-06"),
        ("2", S.CREATED, T(2025, 1, 2), "NEW", "c", "2025-01"), ("2", S.PACKED, T(2025, 1, 1), "P", "w", "2025-01"),
        ("2", S.ANNULLED_ITEMS, T(2025, 1, 4), "CANCELLED", "a", "2025-01"),
    ]).collect()}
    assert (rows["1"].is_stuck, rows["1"].is_high_season) == (True, True)
    assert (rows["2"].is_stuck, rows["2"].is_cancelled, rows["2"].hours_created_to_packed) == (False, True, -24.0)


FACT = """logistic_order_id string, source_order_type string, fulfillment_order_type string, year_month string,
 service_category string, is_click_and_collect boolean, is_high_season boolean, created_by string, packed_by string,
 dispatched_by string, completed_by string, cancelled_by string, created_at timestamp_ntz, packed_at timestamp_ntz,
 dispatched_at timestamp_ntz, completed_at timestamp_ntz, cancelled_at timestamp_ntz, last_event_at timestamp_ntz,
 last_state string, promised_date_to timestamp_ntz, promised_date_from timestamp_ntz, is_completed boolean,
 is_cancelled boolean, is_dispatched boolean, is_packed boolean, is_stuck boolean, is_sla_breach boolean,
 hours_sla_delta double, hours_created_to_packed double, hours_packed_to_dispatched double,
 hours_dispatched_to_completed double, hours_total_cycle double, total_events long, total_actors long,
 total_event_types long"""


def _facts(spark, cases, p95=(10.0, 10.0, 10.0), month="2025-01"):
    """Cases are (id, leg hours x3, stuck, breach, delta)."""
    rows = [
        (i, "A", "F", month, "R", None, False, "c", "pk", "dp", "cm", None, None, None, None, None, None, None, None, None,
         None, True, False, True, True, stuck, breach, delta, a, b, c, None, 1, 1, 1)
        for i, a, b, c, stuck, breach, delta in cases
    ]
    base = spark.createDataFrame([("2025-01", *p95)], "year_month string, p95_deposito double, p95_despacho double, p95_ultima_milla double")
    items = spark.createDataFrame([], "logistic_order_id string, main_seller_id string, main_sku string, total_items double, distinct_skus long, has_insurance boolean")
    return orders.fact_orders(spark.createDataFrame(rows, FACT), base, items)


def test_leg_ladder(spark):
    got = {r.logistic_order_id: (r.tramo_disruptivo, r.actor_responsable, r.is_disrupted) for r in _facts(spark, [
        ("equal", 20.0, 20.0, 20.0, False, False, None), ("at p95", 10.0, 10.0, 10.0, False, False, None),
        ("second", 15.0, 16.0, 2.0, False, None, None), ("last only", 11.0, None, 12.0, False, None, None),
        ("late but shorter", 11.0, 30.0, None, False, None, None), ("depot beaten", 11.0, 5.0, 12.0, False, None, None),
        ("depot, last in time", 12.0, 5.0, 13.0 - 4, False, None, None), ("nothing", None, None, None, False, None, None),
        ("stuck", None, None, None, True, None, None),
    ]).collect()}
    assert got == {
        "equal": ("deposito", "pk", True), "at p95": ("sin_disrupcion", None, False),
        "second": ("despacho", "dp", True), "last only": ("ultima_milla", "cm", True),
        "late but shorter": ("despacho", "dp", True), "depot beaten": ("ultima_milla", "cm", True),
        "depot, last in time": ("deposito", "pk", True), "nothing": ("sin_disrupcion", None, False),
        "stuck": ("sin_disrupcion", None, True),
    }


def test_a_month_without_baseline_names_no_leg(spark):
    row = _facts(spark, [("1", 99.0, 99.0, 99.0, False, False, None)], month="2025-06").first()
    assert (row.tramo_disruptivo, row.is_disrupted, row.delta_deposito_vs_p95) == ("sin_disrupcion", False, None)


def test_severity(spark):
    facts = _facts(spark, [
        ("stuck", None, None, None, True, None, None), ("very late", 1.0, 1.0, 1.0, False, True, 48.5),
        ("late", 1.0, 1.0, 1.0, False, True, 48.0), ("slow", 70.0, 1.0, 1.0, False, False, None),
        ("slow, at limit", 58.0, 1.0, 1.0, False, None, None), ("fine", 1.0, 1.0, 1.0, False, False, None),
    ])
    mart = orders.order_disruptions(facts)
    got = {r.logistic_order_id: (r.tipo_disrupcion, r.severidad) for r in mart.collect()}
    assert got == {
        "stuck": ("orden_atascada", "critica"), "very late": ("sla_breach", "alta"), "late": ("sla_breach", "media"),
        "slow": ("demora_deposito", "alta"), "slow, at limit": ("demora_deposito", "media"),
    }
    by_name = [r.severidad for r in orders.ranked_for_review(mart).collect()]
    by_rank = [r.severidad for r in orders.ranked_for_review(mart, by_rank=True).collect()]
    assert by_name == ["media", "media", "critica", "alta", "alta"]
    assert by_rank == ["critica", "alta", "alta", "media", "media"]


def test_baseline_population(spark):
    rows = [
        ("2025-01", True, False, 10.0, 1.0, 2.0, 3.0, None), ("2025-01", True, False, 720.0, 3.0, 4.0, 5.0, True),
        ("2025-01", True, False, 721.0, 900.0, 1.0, 1.0, True), ("2025-01", True, False, -1.0, 900.0, 1.0, 1.0, True),
        ("2025-01", True, False, 5.0, None, 1.0, 1.0, True), ("2025-01", False, False, None, 900.0, 1.0, None, None),
        ("2025-06", True, True, 10.0, 1.0, 2.0, 3.0, False),
    ]
    df = spark.createDataFrame(rows, """year_month string, is_completed boolean, is_high_season boolean, hours_total_cycle double,
        hours_created_to_packed double, hours_packed_to_dispatched double, hours_dispatched_to_completed double, is_sla_breach boolean""")
    got = baselines.stage_baselines(df).collect()
    assert len(got) == 1
    assert (got[0].ordenes_base, got[0].pct_sla_breach, got[0].p50_deposito, got[0].p95_despacho) == (2, 50.0, 2.0, 3.9)


def test_item_summary_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("1", "b", "s2", 1.0, False), ("1", "a", "s1", 2.0, None), ("1", None, "s1", 4.0, True), ("2", None, None, 1.0, False)],
        "logistic_order_id string, sku string, seller_id string, quantity_number double, has_insurance boolean",
    )
    got = {r.logistic_order_id: r for r in orders.item_summary(df).collect()}
    assert (got["1"].main_sku, got["1"].main_seller_id, got["1"].total_items) == ("a", "s1", 7.0)
    assert (got["1"].distinct_skus, got["1"].has_insurance) == (2, True)
    assert (got["2"].main_sku, got["2"].main_seller_id, got["2"].distinct_skus) == (None, None, 0)


def test_staging_filters_and_bad_text(spark):
    base = {f.split()[0]: None for f in S.RAW_EVENTS.replace("\n", " ").split(",")}
    good = base | {"h_logistic_order_id": "1", "h_event_type": "E", "h_country": "CL", "h_datetime": "2025-01-01 00:00:00",
                   "d_executed_at": "ayer", "d_order_version": "3", "year_month": "2025-01"}
    cases = [good, good | {"h_datetime": "2024-12-31 23:59:59"}, good | {"h_country": "PE"}, good | {"h_event_type": None},
             good | {"h_logistic_order_id": None}, good | {"h_datetime": "nunca"}, good | {"h_datetime": None}]
    df = spark.createDataFrame([tuple(c.values()) for c in cases], S.RAW_EVENTS)
    got = staging.stg_events(df, VARS).collect()
    assert len(got) == 1 and len(got[0]) == 17
    assert (got[0].executed_at, got[0].order_version, got[0].event_at) == (None, 3, T(2025, 1, 1))


def test_package_map_and_missing_key(spark):
    df = spark.createDataFrame(
        [("1", None, None, "E", "2025-02-01 10:00:00", "CL", "S", {"dateTo": "x"}, None, None, "2025-02"),
         ("2", None, None, "E", "2025-02-01 10:00:00", "CL", "S", None, None, None, "2025-02")], S.RAW_PACKAGES)
    got = {r.logistic_order_id: r for r in staging.stg_packages(df, VARS).collect()}
    assert (got["1"].promised_date_to, got["1"].service_category, got["1"].is_click_and_collect) == ("x", None, False)
    assert (got["2"].promised_date_to, got["2"].is_click_and_collect) == (None, False)


ARRAY = "id string, eventos array<struct<timestamp: string, estado: string>>"


def test_flow_from_array_keeps_the_given_order(spark):
    df = spark.createDataFrame([
        ("neg", [("2025-01-01T10:00:00Z", "IN_TRANSIT"), ("2025-01-01T08:00:00", "OUT_FOR_DELIVERY"), ("2025-01-01T11:00:00", "IN_TRANSIT")]),
        ("one", [("2025-01-01T10:00:00", "EXCEPTION")]), ("none", []), ("null", None),
    ], ARRAY)
    got = {r.id: r for r in flow.flow_from_array(df).collect()}
    neg = got["neg"]
    assert (neg.horas_entre_eventos_max, neg.horas_entre_eventos_avg, neg.horas_a_out_for_delivery) == (3.0, 3.0, -2.0)
    assert (neg.n_eventos_total, neg.n_estados_distintos, neg.esta_en_transito) == (3, 2, 1)
    one = got["one"]
    assert (one.horas_entre_eventos_max, one.tuvo_exception, one.horas_a_shipment_confirmed) == (0.0, 1, -1.0)
    for name in ("none", "null"):
        r = got[name]
        assert (r.horas_entre_eventos_max, r.n_eventos_total, r.n_estados_distintos) == (-1.0, 0, 1)
        assert (r.ultimo_estado, r.esta_shipment_confirmed, r.tuvo_exception) == ("SHIPMENT_CONFIRMED", 0, 0)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gaps_and_texts_of_itineraries_are_computed_once(spark):
    """Gaps stand in a column that largest, mean and number are taken from; each milestone's text in one as well."""
    df = spark.createDataFrame([("1", [("2025-01-01T10:00:00Z", "IN_TRANSIT")])], ARRAY)
    assert _optimized(flow.flow_from_array(df)).count("zip_with(") == 1
    rows = [("1", T(2025, 1, 1, 10), T(2025, 1, 1, 12), None, None), ("3", T(2025, 1, 1, 10), T(2025, 1, 1, 12), None, T(2025, 1, 1, 14))]
    none = {c: F.lit(None).cast("boolean") for c in ("is_click_and_collect", "is_high_season", "has_insurance")}
    none |= {"promised_date_to": F.lit(None).cast("timestamp_ntz"), "service_category": F.lit("A"), "total_items": F.lit(1), "distinct_skus": F.lit(1)}
    made = bindings.itineraries(spark.createDataFrame(rows, "logistic_order_id string, created_at timestamp_ntz, packed_at timestamp_ntz, dispatched_at timestamp_ntz, completed_at timestamp_ntz").withColumns(none))
    assert _optimized(made.select("pedido", "eventos")).count("date_format(") == 4
    got = {r.pedido: [tuple(e) for e in r.eventos] for r in made.collect()}
    ship, move, tried = ("2025-01-01T10:00:00Z", S.SHIPMENT_CONFIRMED), ("2025-01-01T12:00:00Z", S.IN_TRANSIT), ("2025-01-01T14:00:00Z", S.DELIVERY_ATTEMPTED)
    assert got == {"1": [ship, move], "3": [move, ship, tried]}


def test_importance_has_features_that_no_tree_splits_on(spark):
    rows = _boosting_rows(spark).withColumn("last", F.lit("same"))
    enc = models.fit_encoder(rows, ["x", "y"], ["c", "last"])
    fitted = models.fit_risk(rows, enc, models.TreeSettings(rounds=3, step=0.2, depth=3, min_rows=5))
    got = {r.feature: (r.importance_gain, r.importance_split) for r in models.importance(fitted, rows).collect()}
    assert set(got) == {"x", "y", "c", "last"} and got["last"] == (0.0, 0) and sum(g for g, _ in got.values()) == pytest.approx(1)


def test_order_without_events_gets_minus_one(spark):
    base = spark.createDataFrame([("1",), ("2",)], "logistic_order_id string")
    events = spark.createDataFrame([("1", T(2025, 1, 1), "IN_TRANSIT", 1)], "logistic_order_id string, event_dt timestamp_ntz, package_status string, event_id long")
    got = {r.logistic_order_id: r for r in flow.attach_flow(base, flow.flow_features(events)).collect()}
    assert (got["1"].n_eventos_total, got["1"].horas_entre_eventos_max, got["1"].ultimo_estado) == (1, 0.0, "IN_TRANSIT")
    assert {got["2"][c] for c in S.FLOW_NUMERIC} == {-1} and got["2"].ultimo_estado == S.UNKNOWN


def _data(*codes):
    inner = ",".join('{"trackingData":{"carrierCode":"%s"%s}}' % (c, f',"carrierName":"{n}"' if n else "") for c, n in codes)
    return '{"orderItems":[{},{"states":[{},{"packagesInfo":[{},%s]}]}]}' % inner


def test_first_carrier_in_document_order(spark):
    head = '{"eventType":"%s","logisticOrderId":"%s","country":"%s"}'
    ok = S.STATE_CHANGED
    rows = [
        (head % (ok, "1", "CL"), _data(("  ", None), (" A\\t", " Alfa "), ("B", None)), 1),
        (head % (ok, "2", "CL"), _data(("C", None)), 1), (head % (ok, "3", "CL"), "{oops", 1),
        (head % (ok, "4", "PE"), _data(("D", None)), 1), (head % ("OTHER", "5", "CL"), _data(("E", None)), 1),
        ("not json", _data(("F", None)), 1), (head % (ok, "", "CL"), _data(("G", None)), 1), (head % (ok, "6", "CL"), "{}", 1),
        (None, None, 1),
    ]
    df = spark.createDataFrame(rows, "header string, data string, seen int").withColumn("year_month", F.lit("2025-01"))
    got = {r.logistic_order_id: (r.carrier_code, r.carrier_name) for r in carriers.first_carrier(df, "CL").collect()}
    assert got == {"1": ("A", "Alfa"), "2": ("C", "C")}
    assert {r.logistic_order_id for r in carriers.first_carrier(df, None).collect()} == {"1", "2", "4"}


def test_carrier_mode_ties_and_names(spark):
    rows = [("1", "B", "Beta", 1), ("1", "A", "Alfa", 2), ("1", "A", "Alfa", 3), ("2", "Z", "Zeta", 1), ("2", "A", "Alfa", 2)]
    df = spark.createDataFrame(rows, "logistic_order_id string, carrier_code string, carrier_name string, seen int").withColumn("year_month", F.lit("2025-01"))
    got = {r.logistic_order_id: (r.carrier_code, r.carrier_name, r.n_envelopes) for r in carriers.carrier_per_order(df).collect()}
    assert got == {"1": ("A", "Alfa", 3), "2": ("Z", "Zeta", 2)}
    first = carriers.carrier_per_order(df, name_of_code=False)
    assert {r.logistic_order_id: r.carrier_name for r in first.collect()} == {"1": "Beta", "2": "Zeta"}


def test_carrier_of_the_earliest_month_wins(spark):
    rows = [("1", "A", "A", 9, "2025-01"), ("1", "B", "B", 1, "2025-02"), ("1", "B", "B", 2, "2025-02")]
    df = spark.createDataFrame(rows, "logistic_order_id string, carrier_code string, carrier_name string, seen int, year_month string")
    assert carriers.carrier_earliest_month(df).first().carrier_code == "A"
    assert carriers.carrier_per_order(df).first().carrier_code == "B"


@pytest.mark.parametrize("leg, expected", [
    (None, "sin_disrupcion"), ("  ", "sin_disrupcion"), ("nan", "sin_disrupcion"), ("Sin Disrupcion", "sin_disrupcion"),
    (" ULTIMA_MILLA ", "ultima_milla"), ("milla final", "ultima_milla"), ("Deposito", "deposito_despacho"), ("x", "deposito_despacho"),
])
def test_leg_class(spark, leg, expected):
    df = spark.createDataFrame([(leg,)], "t string")
    assert df.select(features.leg_class(F.col("t")).alias("c")).first().c == expected


def test_calendar(spark):
    df = spark.createDataFrame([("2025-06-01T05:59:59Z",), ("2025-06-07T06:00:00",), ("2025-06-02T19:30:00",), ("2025-06-02T20:00:00",), ("mal",)], "t string")
    t = parse_iso(F.col("t"))
    got = [tuple(r) for r in df.select(weekday(t), F.when(t.isNotNull(), day_band(F.hour(t)))).collect()]
    assert got == [(0, "madrugada"), (6, "manana"), (1, "tarde"), (1, "madrugada"), (None, None)]
    h = df.limit(1).select(hours_between(F.lit("2025-01-01").cast("timestamp_ntz"), F.lit("2025-01-01 00:00:00.0018").cast("timestamp_ntz")).alias("h")).first().h
    assert h == pytest.approx(0.0000005)


def _history(spark):
    rows = [("s1", "A", 0.0, 0.5, 0.6, 0.1, 0.2, 7), ("s1", "A", 0.0, 0.5, 0.6, 0.3, 0.2, 7), ("s2", "A", None, 0.5, 0.6, 0.1, 0.2, None)]
    return spark.createDataFrame(rows, """seller_id string, service_category string, seller_tasa_disrupcion double,
        categoria_tasa_disrupcion double, categoria_cac_tasa_disrupcion double, dia_semana_tasa_disrupcion double,
        franja_tasa_disrupcion double, seller_n_ordenes long""")


def test_history_ladder_and_zero_rate(spark):
    keys = spark.createDataFrame([("s1", "A"), ("s2", "A"), ("new", "A"), ("s1", "B"), (None, "A")], PAIR)
    got = {(r.seller_id, r.service_category): r for r in lookups.history_lookup(keys, _history(spark)).collect()}
    assert len(got) == 5
    one = got["s1", "A"]
    assert (one.fuente, one.n_ordenes, one.seller_tasa, one.dia_tasa, one.seller_n_ordenes) == ("seller+category", 2, 0.0, 0.2, 7)
    assert (got["s2", "A"].seller_tasa, got["s2", "A"].seller_n_ordenes) == (0.4, 0)
    new = got["new", "A"]
    assert (new.fuente, new.n_ordenes, new.seller_tasa, new.cat_tasa, new.dia_tasa) == ("category", 3, 0.4, 0.5, 0.42)
    assert (got["s1", "B"].fuente, got["s1", "B"].cat_tasa, got["s1", "B"].n_ordenes) == ("global", 0.39, 0)
    assert got[None, "A"].fuente == "category"


PAIR = "seller_id string, service_category string"


def test_failing_legs_fall_back_to_the_category(spark):
    rows = [("s1", "A", "deposito", "w1")] * 3 + [("s1", "A", "despacho", None)] + [("s2", "A", "ultima_milla", f"d{i}") for i in range(7)]
    rows += [("s3", "A", "sin_disrupcion", None)] * 9
    df = spark.createDataFrame(rows, PAIR + ", tramo_disruptivo string, actor_responsable string")
    keys = spark.createDataFrame([("s1", "A"), ("s3", "A"), ("s9", "Z")], PAIR)
    got = lookups.failing_legs(keys, df).collect()
    s1 = sorted((r.puesto, r.tramo_disruptivo, r.n, r.pct, r.fuente) for r in got if r.seller_id == "s1")
    assert s1 == [(1, "deposito", 3, 75.0, "seller+category"), (2, "despacho", 1, 25.0, "seller+category")]
    s3 = sorted((r.puesto, r.n, r.pct, r.pct_of_all, r.fuente) for r in got if r.seller_id == "s3")
    assert s3[0] == (1, 3, 42.9, 27.3, "category") and len(s3) == 5
    assert not [r for r in got if r.seller_id == "s9"]


def test_encoder_always_knows_the_unknown(spark):
    train = spark.createDataFrame([("b", "2025-01", "1"), ("a", "2025-02", "x")], "c string, year_month string, n string")
    test = spark.createDataFrame([("a", "9"), ("b", None), ("zzz", "bad"), (None, "2.5")], "c string, n string")
    both = models.fit_encoder(train, ["n"], ["c"])
    assert {(r.value, r.code) for r in both.table.collect()} == {(S.UNKNOWN, 0), ("a", 1), ("b", 2)} and both.sizes == {"c": 3}
    assert sorted((r.n, r.c_code) for r in models.encode(test, both, []).collect()) == [(-1.0, 0), (-1.0, 2), (2.5, 0), (9.0, 1)]
    first = models.fit_encoder(train, ["n"], ["c"], months=["2025-01"])
    assert sorted(r.c_code for r in models.encode(test, first, []).collect()) == [0, 0, 0, 1]


def test_twenty_thousand_labels_in_sorted_order(spark):
    train = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("c"), F.lit("2025-01").alias("year_month"))
    enc = models.fit_encoder(train, [], ["c"])
    order = sorted([f"s{i}" for i in range(20_000)] + [S.UNKNOWN])
    got = {r.value: r.code for r in enc.table.collect()}
    assert got == {v: i for i, v in enumerate(order)}


def _boosting_rows(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 4 == 0, "val").otherwise("train").alias("split_set"), F.lit("2025-01").alias("year_month"),
        (F.col("id") * 37 % 101).cast("double").alias("x"), (F.col("id") * 53 % 89).cast("double").alias("y"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("c"), F.col("id").alias("k"),
    )
    return rows.withColumn("target_binario", ((F.col("x") + F.col("y") + 20 * F.col("c").isin("c1", "c2").cast("int")) > 100).cast("int"))


def test_boosting_boosts_and_survives_its_files(spark, tmp_path):
    rows = _boosting_rows(spark)
    enc = models.fit_encoder(rows, ["x", "y"], ["c"])
    tree = models.TreeSettings(rounds=25, step=0.2, depth=3, min_rows=5)
    one, many = models.fit_risk(rows, enc, models.TreeSettings(rounds=1, step=0.2, depth=3, min_rows=5)), models.fit_risk(rows, enc, tree)
    val = models._vector(models.encode(rows.where("split_set = 'val'").withColumn("label", F.col("target_binario").cast("double")), enc, ["label"]), enc)
    val = val.withColumn("w", F.lit(1.0))
    loss = [m.model.evaluateEachIteration(val)[-1] for m in (one, many)]
    assert len(many.model.trees) > 5 and loss[1] < 0.8 * loss[0]
    models.save_fitted(many, str(tmp_path / "m"))
    again = models.load_fitted(spark, str(tmp_path / "m"))
    key = ["k", "target_binario"]
    a, b = (sorted(map(tuple, models.score(m, rows, key).collect())) for m in (many, again))
    assert a == b and again.encoder.sizes == many.encoder.sizes
    splits = {r.feature: r.importance_split for r in models.importance(many, rows).collect()}
    assert set(splits) == {"x", "y", "c"} and min(splits.values()) > 0


def test_patience_outlasts_a_dip():
    falls, dip = [10.0 - n for n in range(5)], [6.5] * 4
    assert boosting.best_round([*falls, *dip, 5.0, 7.0, 7.0, 7.0], 5) == (10, False)
    assert boosting.best_round([*falls, *dip, 5.0], 4) == (5, True)
    assert boosting.best_round([3.0, 3.0, 3.0], 2) == (1, True)
    assert boosting.best_round([3.0, 2.0], 50) == (2, False)


def test_late_improvement_is_kept(spark, monkeypatch):
    """The curve dips first; the model has the trees up to the later minimum, and fits went on until patience ended."""
    rows = models.boosting_rows(_boosting_rows(spark), models.fit_encoder(_boosting_rows(spark), ["x", "y"], ["c"]), [], F.col("target_binario"))
    settings = models.TreeSettings(rounds=8, step=0.3, depth=2, min_rows=5, patience=2)
    asked = []

    class Watched(GBTClassifier):
        def fit(self, df):
            model = super().fit(df)
            asked.append(self.getMaxIter())
            curve = [1.0, 0.9, 0.95, 0.8, 0.85, 0.7, 0.71, 0.72]
            monkeypatch.setattr(type(model), "evaluateEachIteration", lambda m, _: curve[: m.getNumTrees])
            return model

    monkeypatch.setattr(boosting, "GBTClassifier", Watched)
    model, curve = boosting.fit_patient(Watched, rows, settings)
    assert asked == [6, 8] and model.getNumTrees == 6 and len(curve) == 8


def test_a_falling_loss_is_not_fitted_thrice(spark, monkeypatch):
    """A loss that falls to the last round is fitted to all rounds at once, a flat one to twice as many."""
    rows = models.boosting_rows(_boosting_rows(spark), models.fit_encoder(_boosting_rows(spark), ["x", "y"], ["c"]), [], F.col("target_binario"))
    asked, curve = [], []

    class Watched(GBTClassifier):
        def fit(self, df):
            model = super().fit(df)
            asked.append(self.getMaxIter())
            monkeypatch.setattr(type(model), "evaluateEachIteration", lambda m, _: curve[: m.getNumTrees])
            return model

    monkeypatch.setattr(boosting, "GBTClassifier", Watched)
    settings = models.TreeSettings(rounds=20, step=0.1, depth=1, min_rows=5, patience=1)
    curve[:] = [1.0 - n / 100 for n in range(20)]
    assert len(boosting.fit_patient(Watched, rows, settings)[1]) == 20 and asked == [3, 20]
    assert [boosting.next_rounds(150, at, models.TreeSettings()) for at in (150, 141, 140, 110)] == [1000, 1000, 300, 300]
    assert boosting.next_rounds(600, 560, models.TreeSettings()) == 1000


def test_cut_model_equals_a_shorter_fit(spark):
    enc = models.fit_encoder(_boosting_rows(spark), ["x", "y"], ["c"])
    rows = models.boosting_rows(_boosting_rows(spark), enc, [], F.col("target_binario"))
    long, short = (boosting.fit_patient(GBTClassifier, rows.withColumn("is_val", F.lit(False)), models.TreeSettings(rounds=n, step=0.2, depth=3, min_rows=5))[0] for n in (12, 5))
    a, b = ([tuple(r.probability) for r in m.transform(rows).select("probability").collect()] for m in (boosting.cut(long, 5), short))
    assert a == b and boosting.cut(long, 5).getNumTrees == 5


def test_continued_boosting_goes_on_from_its_margin(spark, tmp_path):
    """Two periods whose labels have different causes: the second's trees add to the first's, and files hold it all."""
    rows = _boosting_rows(spark).withColumn("p", F.when(F.col("k") % 2 == 0, "a").otherwise("b"))
    tree = models.TreeSettings(step=0.3, depth=3, min_rows=5)
    fit = models.fit_risk_continued(rows, ["x", "y"], ["c"], tree, first=12, more=6, period="p")
    assert fit.periods == ("a", "b") and [len(p.trees) for p in fit.parts] == [13, 6]
    assert fit.losses[1] < fit.losses[0] < 0.5
    models.save_continued(fit, str(tmp_path / "c"))
    again = models.load_continued(spark, str(tmp_path / "c"))
    key = ["k", "target_binario"]
    a, b = (sorted(map(tuple, models.score(f.fitted, rows, key).collect())) for f in (fit, again))
    assert a == b and again.losses == fit.losses and len(again.whole.trees) == 19
    # by hand: the margin of a row is the sum of its trees, and the first trees alone give the first period's loss
    vectors = models.boosting_rows(rows, again.fitted.encoder, [], F.col("target_binario"))
    assert boosting.mean_loss(vectors.where("is_val"), fit.parts[0]) == pytest.approx(fit.losses[0], abs=1e-9)


def test_leg_model_of_four_classes(spark):
    rows = _boosting_rows(spark).withColumn("clase", F.concat(F.lit("k"), F.floor(F.col("x") / 26).cast("string")))
    enc = models.fit_encoder(rows, ["x", "y"], ["c"])
    names = ["k0", "k1", "k2", "k3"]
    fitted = models.fit_leg(rows, enc, "clase", names, models.TreeSettings(rounds=5, step=0.3, depth=3, min_rows=5))
    got = models.leg_predictions(fitted, rows, ["clase"])
    assert got.where("pred = clase").count() > 0.9 * rows.count()


def test_rates_do_not_double_rows(spark):
    rows = [("1", "2025-01", "s1", "A", 0, 1, "tarde", t, 1) for t in ("x", "y")] + [("2", "2025-01", None, "B", 1, 2, "manana", "x", 0)]
    df = spark.createDataFrame(rows, "logistic_order_id string, year_month string, seller_id string, service_category string, is_click_and_collect int, dia_semana_creacion int, franja_horaria string, source_order_type string, target_binario int")
    got = features.with_rates(df, features.rate_tables(df)).orderBy("logistic_order_id", "source_order_type").collect()
    assert [(r.source_order_type, r.seller_n_ordenes, r.categoria_tasa_disrupcion) for r in got] == [("x", 2, 1.0), ("y", 2, 1.0), ("x", None, 0.0)]


def _two_types(spark):
    """Facts of one order with two types in a month and a row in another month, and of a plain one."""
    columns = {
        "is_click_and_collect": False, "is_high_season": False, "has_insurance": False, "total_items": 1.0, "distinct_skus": 1,
        "created_at": T(2025, 1, 3, 10), "promised_date_to": T(2025, 1, 9), "service_category": "A", "seller_id": "s1", "created_by": "c",
        "actor_responsable": "x", "hours_total": 50.0, "hours_deposito": 1.0, "hours_despacho": 2.0, "hours_ultima_milla": 47.0,
    }
    rows = [("1", "2025-01", "P", "ultima_milla", True), ("1", "2025-01", "F", "deposito", True), ("1", "2025-02", "F", "sin_disrupcion", False), ("2", "2025-01", "F", "despacho", False)]
    facts = spark.createDataFrame([(*r, *columns.values()) for r in rows], "logistic_order_id string, year_month string, source_order_type string, tramo_disruptivo string, "
        "is_disrupted boolean, is_click_and_collect boolean, is_high_season boolean, has_insurance boolean, total_items double, distinct_skus int, created_at timestamp_ntz, "
        "promised_date_to timestamp_ntz, service_category string, seller_id string, created_by string, actor_responsable string, hours_total double, hours_deposito double, "
        "hours_despacho double, hours_ultima_milla double")
    return facts, features.ml_dataset(facts, features.SplitRule())


def test_two_types_of_an_order_keep_their_rows(spark):
    facts, dataset = _two_types(spark)
    legs = features.leg_population(facts, features.SplitRule(), ["hours_deposito"])
    assert sorted((r.logistic_order_id, r.year_month, r.source_order_type, r.target_tramo) for r in legs.collect()) == [
        ("1", "2025-01", "F", "deposito"), ("1", "2025-01", "P", "ultima_milla"), ("1", "2025-02", "F", "sin_disrupcion"), ("2", "2025-01", "F", "despacho")
    ]
    rated = features.with_rates(dataset, features.rate_tables(dataset))
    events = spark.createDataFrame([("1", T(2025, 1, 4), "X", 1), ("1", T(2025, 1, 5), "Y", 2)], "logistic_order_id string, event_dt timestamp_ntz, package_status string, event_id long")
    full = lookups.order_360(rated, lookups.event_digest(events)).collect()
    assert sorted((r.logistic_order_id, r.year_month, r.tramo_disruptivo or "") for r in full) == [
        ("1", "2025-01", "deposito"), ("1", "2025-01", "ultima_milla"), ("1", "2025-02", ""), ("2", "2025-01", "")
    ]
    assert lookups.order_base(rated).count() == 4
    outcomes = {r.logistic_order_id: (r.target_binario, r.tramo_disruptivo) for r in replay.order_outcomes(dataset).collect()}
    assert outcomes == {"1": (1, "deposito"), "2": (0, None)}
    one = {r.logistic_order_id: (r.year_month, r.source_order_type) for r in features.one_per_order(dataset).collect()}
    assert one == {"1": ("2025-02", "F"), "2": ("2025-01", "F")}
    scored = replay.prefix_features(events).withColumn("prob", F.lit(0.9))
    assert replay.replay_summary(scored, replay.order_outcomes(dataset)).count() == 1


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_state_at_many_moments_of_a_hot_order(spark, limit):
    """Against a plain look at all earlier events, with ties, moments between, before and at events."""
    events = [("hot", T(2025, 1, 1) + dt.timedelta(hours=(7 * i) % 40), ["A", S.EXCEPTION, "B", None][i % 4], i) for i in range(40)] + [("one", T(2025, 1, 1), "A", 99), ("hot", None, "Z", 100)]
    moments = [("hot", T(2024, 12, 31) + dt.timedelta(minutes=45 * i), i) for i in range(90)] + [("none", T(2025, 1, 1), -1), ("one", None, -2), ("one", T(2025, 1, 1), -3), ("one", T(2025, 1, 1), -3)]
    e = spark.createDataFrame(events, "logistic_order_id string, event_dt timestamp_ntz, package_status string, event_id long")
    m = spark.createDataFrame(moments, "logistic_order_id string, momento timestamp_ntz, nth int")
    got = lookups.state_at(m, e, limit=limit).collect()
    assert len(got) == len(moments)
    for r in got:
        seen = sorted((x[1], x[3], x[2]) for x in events if x[0] == r.logistic_order_id and x[1] and r.momento and x[1] <= r.momento)
        last = seen[-1] if seen else (None, None, None)
        assert (r.n_eventos, r.ultimo_evento, r.ultimo_estado) == (len(seen), last[0], last[2])
        assert r.tuvo_exception == int(any(x[2] == S.EXCEPTION for x in seen))


def test_pages_hold_the_journey(spark):
    rows = [("1", "p", "s", None, "T", T(2025, 1, 1) + dt.timedelta(hours=i * i), f"S{i % 3}", i) for i in range(25)]
    e = spark.createDataFrame(rows, "logistic_order_id string, package_id string, shipment_id string, promised_date string, event_type string, event_dt timestamp_ntz, package_status string, event_id long")
    pages = lookups.package_pages(lookups.journey(e), 10).orderBy("pagina").collect()
    assert [len(p.eventos) for p in pages] == [10, 10, 5] and [p.ultimo_estado for p in pages] == ["S0", "S1", "S0"]
    assert [x.event_dt for p in pages for x in p.eventos] == [r[5] for r in rows]
    assert [x.n_evento for p in pages for x in p.eventos] == list(range(1, 26)) and pages[0].horas_max_gap == 17.0


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3, "c string")
    assert {r.c: r.peso for r in models.class_weights(df, "c").collect()} == {"a": 0.75, "b": 1.5}


@pytest.mark.parametrize("p, level", [(0.8, "CRÍTICO"), (0.79, "ALTO"), (0.6, "ALTO"), (0.4, "MODERADO"), (0.399, "BAJO")])
def test_risk_level(spark, p, level):
    assert spark.range(1).select(models.risk_level(F.lit(p)).alias("l")).first().l == level


def test_new_orders_keep_midnight(spark):
    df = spark.createDataFrame([("p", "s1", "A", "2025-06-01T00:10:00Z", 30.0)], "pedido string, seller_id string, service_category string, created_at string, sla_horas double")
    r = scoring.new_order_features(df, _history(spark)).first()
    assert (r.hora_creacion, r.franja_horaria, r.dia_semana_creacion, r.seller_tasa_disrupcion) == (0, "madrugada", 0, 0.0)


def test_deviation_below_the_offset_is_left_out_of_the_fit(spark):
    rows = [("train" if i % 4 else "val", "2025-01", float(i % 7), float(i % 50) - 20) for i in range(200)]
    rows += [("train", "2025-01", 1.0, -201.0), ("train", "2025-01", 1.0, -500.0), ("train", "2025-01", 1.0, None)]
    df = spark.createDataFrame(rows, "split_set string, year_month string, x double, d double")
    enc = models.fit_encoder(df, ["x"], [])
    fitted = models.fit_hours(df, enc, "d", models.DEVIATION_OFFSET, models.TreeSettings(rounds=2, depth=2, min_rows=1))
    got = models.hours_predictions(fitted, df, ["d"]).agg(F.min("horas_pred").alias("lo"), F.max("horas_pred").alias("hi")).first()
    assert -25 < got.lo <= got.hi < 35


def test_first_alert_is_the_earliest(spark):
    df = spark.createDataFrame([("1", 1, 0.2), ("1", 2, 0.7), ("1", 3, 0.9), ("2", 1, 0.1)], "logistic_order_id string, n_hito int, prob double")
    df = df.withColumn("event_dt", F.lit("2025-01-01").cast("timestamp_ntz")).withColumn("package_status", F.lit("X"))
    got = {r.logistic_order_id: (r.alerta_hito, r.alerta_prob, r.n_hitos) for r in replay.first_alert(df).collect()}
    assert got == {"1": (2, 0.7, 3), "2": (None, None, 1)}


def test_quality_checks(spark):
    a = spark.createDataFrame([("m1", 1), ("m1", 2), ("m2", 3), (None, 4)], "year_month string, x int")
    got = {r.year_month: (r.source_rows, r.target_rows, r.status) for r in quality.reconcile(a, a.where("x <> 2")).collect()}
    assert got == {"m1": (2, 1, "MISMATCH"), "m2": (1, 1, "OK"), None: (1, 1, "OK")}
    nulls = {r.column_name: (r.n_null, r.passed) for r in quality.null_report({"t": (a, ["year_month", "x"])}).collect()}
    assert nulls == {"year_month": (1, False), "x": (0, True)}
    assert [tuple(r) for r in quality.accepted_values(a, "year_month", ["m1"]).collect()] == [("m2", 1)]
    assert [tuple(r) for r in quality.duplicate_keys(a, ["year_month"]).collect()] == [("m1", 2)]


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "logistic_order_id string, event_dt timestamp_ntz, package_status string, event_id long")
    assert flow.flow_features(none).count() == 0
    assert replay.prefix_features(none).count() == 0
    assert _timeline(spark, []).count() == 0
    scores = spark.createDataFrame([], "split_set string, prob double, target int, pred int")
    assert evaluation.roc_auc(scores).count() == 0 and evaluation.class_report(scores).count() == 0
