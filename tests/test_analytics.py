import datetime
import random
import statistics
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlens.operators import evaluation, explorer, features, forecast, models, overview, presentation
from harvestlens.plans import documents, inference, training
from harvestlens.plans.inference import forecast_series
from harvestlens.sources.star_store import Star, StarStore

EPOCH = datetime.date(1970, 1, 1)
KEYS = ["market_id", "commodity_id"]


def star_of(spark, facts, dates=None, evaluations=()):
    """facts: (date_id, market_id, commodity_id, price)."""
    rows = [(d, m, c, Decimal(str(p)), Decimal(str(p)), Decimal(str(p))) for d, m, c, p in facts]
    days = sorted({d for d, *_ in facts} | set(dates or ()))
    return Star(
        state_dim=spark.createDataFrame([(0, "Goa"), (1, "Assam"), (2, "Bihar")], "state_id int, state string"),
        market_dim=spark.createDataFrame(
            [(1, "A", "d", 0), (2, "B", "d", 0), (3, "C", "e", 1)],
            "market_id int, market string, district string, state_id int",
        ),
        commodity_dim=spark.createDataFrame(
            [(1, "Rice", "x", "Faq"), (2, "Rice", "y", "Premium"), (3, "Wheat", "x", "Faq")],
            "commodity_id int, commodity string, variety string, grade string",
        ),
        date_dim=spark.createDataFrame(
            [(d, EPOCH + datetime.timedelta(d)) for d in days], "date_id int, arrival_date date"
        ),
        fact=spark.createDataFrame(
            rows,
            "date_id int, market_id int, commodity_id int, min_price decimal(12,2), max_price decimal(12,2), modal_price decimal(12,2)",
        ),
        model_evaluation=spark.createDataFrame(
            [(m, c, Decimal(str(a)), Decimal("1"), None if r is None else Decimal(str(r))) for m, c, a, r in evaluations],
            "market_id int, commodity_id int, mape decimal(5,2), rmse decimal(10,2), r2_score decimal(5,2)",
        ),
    )


FACTS = [
    (100, 1, 1, 10), (100, 3, 1, 20), (100, 1, 3, 50),
    (103, 1, 1, 11), (103, 2, 1, 12.5), (103, 3, 3, 40), (103, 3, 2, 7),
    (80, 1, 1, 5), (89, 1, 1, 6), (88, 2, 3, 9),
]


def test_overview(spark):
    star = star_of(spark, FACTS, evaluations=[(1, 1, 10.0, 0.5), (3, 3, 20.25, 0.1)])
    pricing = {r.state_id: (r.avg_price, r.record_count) for r in overview.state_pricing(star).collect()}
    assert pricing == {0: (11.75, 2), 1: (23.5, 2)}
    trend = [(r.arrival_date.day, r.price) for r in overview.price_trend(star).collect()]
    assert [price for _, price in trend] == [6.0, 26.67, 17.62]  # 89 = 103 - 14 included; 17.625 rounds to even
    assert [r.price for r in overview.price_trend(star, state="Goa").collect()] == [6.0, 30.0, 11.75]
    top = [(r.commodity, r.report_count) for r in overview.top_commodities(star).collect()]
    assert top == [("Rice", 3), ("Wheat", 1)]
    assert [tuple(r) for r in overview.top_commodities(star, 1, "Assam").collect()] == [("Rice", 7.0, 1)]
    movers = {r.commodity_id: r.pct_change for r in overview.price_movers(star).collect()}
    assert movers == {1: pytest.approx(-21.6667, abs=1e-3), 3: pytest.approx(-20)}
    assert tuple(overview.gainers_losers(star).first()) == (0, 2)
    assert tuple(overview.gainers_losers(star, "Goa").first()) == (1, 0)
    kpis = overview.overview_kpis(star).first()
    assert (kpis.total_records, kpis.total_states, kpis.total_markets, kpis.total_commodities) == (10, 3, 3, 3)
    assert (kpis.total_models, kpis.forecast_trust, kpis.avg_price) == (2, 84.9, 17.62)
    goa = overview.overview_kpis(star, "Goa").first()
    assert (goa.total_records, goa.total_states, goa.total_markets, goa.total_commodities) == (7, 1, 2, 2)
    assert (goa.total_models, goa.forecast_trust, goa.avg_price) == (1, 90.0, 11.75)


def test_states_at_once_equal_one_by_one(spark):
    star = star_of(spark, FACTS, evaluations=[(1, 1, 10.0, 0.5), (3, 3, 20.25, 0.1)])
    for row in overview.overview_by_state(star).collect():
        kpis = overview.overview_kpis(star, row.state).first()
        movers = overview.gainers_losers(star, row.state).first()
        assert row.asDict() | kpis.asDict() | movers.asDict() == kpis.asDict() | movers.asDict() | row.asDict()


def test_the_row_of_all_states_counts_what_has_no_state(spark):
    """The national row equals the national figures, also with facts and models of an unknown market, one date, or nothing at all."""
    unknown = [(103, 99, 1, 40), (110, 99, 1, 80), (110, 99, 2, 80)]
    for facts in (FACTS, FACTS + unknown, [(100, 1, 1, 10)], []):
        star = star_of(spark, facts, dates=[103], evaluations=[(1, 1, 10.0, 0.5), (99, 3, 20.25, 0.1)])
        rows = overview.overview_by_scope(star).collect()
        (whole,) = [r.asDict() for r in rows if r.state_id is None]
        expected = overview.overview_kpis(star).first().asDict() | overview.gainers_losers(star).first().asDict()
        assert {c: whole[c] for c in expected if c != "latest_date"} == {c: v for c, v in expected.items() if c != "latest_date"}
        states = [{c: v for c, v in r.asDict().items() if c != "total_states"} for r in rows if r.state_id is not None]
        in_order = lambda found: sorted(found, key=lambda r: r["state_id"])
        assert in_order(states) == in_order([r.asDict() for r in overview.overview_by_state(star).collect()])


def test_a_latest_date_without_facts(spark):
    star = star_of(spark, FACTS, dates=[110])
    assert overview.latest_avg_price(star).first().avg_price == 0.0
    assert overview.state_pricing(star).count() == 0
    assert overview.previous_date(star).first().previous_date == EPOCH + datetime.timedelta(103)
    assert overview.kpi_forecast_trust(star).first().forecast_trust == 92.0
    covered = presentation.state_coverage(star, overview.state_pricing(star))
    assert [r.has_data for r in covered.collect()] == [False] * 3


def test_one_date_has_no_movers(spark):
    star = star_of(spark, [(100, 1, 1, 10)])
    assert tuple(overview.gainers_losers(star).first()) == (0, 0)
    assert overview.previous_date(star).first().previous_date is None


def test_overview_document_holds_the_parts(spark):
    import json

    star = star_of(spark, FACTS, evaluations=[(1, 1, 10.0, 0.5)])
    document = json.loads(documents.overview_document(star).first().document)
    assert document["statePricing"]["1"] == {"state_name": "Assam", "avg_price": 23.5, "record_count": 2}
    assert [p["price"] for p in document["nationalTrend"]] == [6.0, 26.67, 17.62]
    assert [c["commodity"] for c in document["topCommodities"]] == ["Rice", "Wheat"]
    assert (document["gainersCount"], document["losersCount"]) == (0, 2)


def test_volume_by_hand(spark):
    star = star_of(spark, [(2, 1, 1, 1000), (3, 1, 1, 1100)])
    history = explorer.with_volume(explorer.price_history(explorer.dynamic_filter(star)), [])
    rows = history.orderBy("date_id").collect()
    assert [r.synthetic_volume for r in rows] == [123.40, 85.90]
    assert rows[1].velocity == pytest.approx(0.1) and rows[1].elasticity_factor == pytest.approx(0.65)


def test_factor_is_clamped(spark):
    df = spark.createDataFrame([(-0.5,), (0.3,), (0.0,)], "v double")
    assert [r.f for r in df.select(explorer.elasticity_factor(F.col("v")).alias("f")).collect()] == [2.2, 0.4, 1.0]


def test_history_keeps_the_newest_rows(spark):
    facts = [(d, m, 1, d + m) for d in range(60) for m in (1, 2)] + [(5, 3, 3, 1)]
    star = star_of(spark, facts)
    history = explorer.price_history(explorer.dynamic_filter(star, commodity="Rice")).collect()
    assert len(history) == 90 and [r.date_id for r in history][:2] == [15, 15] and history[-1].date_id == 59
    named = star.fact.join(star.commodity_dim, "commodity_id")
    by_market = explorer.price_history_by(named, ["market_id"], 40)
    plan = by_market._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    counts = {r.market_id: r["count"] for r in by_market.groupBy("market_id").count().collect()}
    assert counts == {1: 40, 2: 40, 3: 1}
    assert explorer.dynamic_filter(star, state_id=1, district="e", market_id=3).count() == 1
    assert explorer.dynamic_filter(star, state_id=0, market_id=3).count() == 0
    assert explorer.dynamic_filter(star).count() == 121


def test_variety_comparison(spark):
    star = star_of(spark, [(1, 1, 1, 10), (2, 1, 1, 11), (1, 1, 2, 30), (1, 2, 1, 99), (1, 1, 3, 1)])
    got = [(r.variety, r.avg_price, float(r.max_price), float(r.min_price)) for r in explorer.variety_comparison(star, 1, "Rice").collect()]
    assert got == [("y", 30.0, 30.0, 30.0), ("x", 10.5, 11.0, 10.0)]


# -- series -----------------------------------------------------------------------------


def series_of(spark, *lengths, gap=1, price=lambda s, i: 100 + (i * 37 + s * 11) % 50 + i / 4):
    rows = [
        (s, 1, EPOCH + datetime.timedelta(i * gap), (EPOCH + datetime.timedelta(i * gap)).month, Decimal(str(price(s, i))))
        for s, n in enumerate(lengths) for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "market_id int, commodity_id int, arrival_date date, month int, modal_price decimal(12,2)"
    ).repartition(5)


def test_features_against_a_loop(spark):
    rows = features.add_features(series_of(spark, 40)).orderBy("arrival_date").collect()
    prices = [float(r.modal_price) for r in rows]
    for i, r in enumerate(rows):
        assert r.lag_7 == (prices[i - 7] if i >= 7 else None)
        assert (r.roll_mean_7 is None) == (i < 6) and (r.roll_mean_14 is None) == (i < 13)
        if i >= 13:
            assert r.roll_mean_14 == pytest.approx(statistics.mean(prices[i - 13 : i + 1]))
            assert r.roll_std_7 == pytest.approx(statistics.stdev(prices[i - 6 : i + 1]))
        assert r.weekday_num == r.arrival_date.weekday()
    causal = features.add_features(series_of(spark, 40), causal=True).orderBy("arrival_date").collect()
    assert causal[20].roll_mean_7 == pytest.approx(statistics.mean(prices[13:20]))
    assert features.feature_matrix(series_of(spark, 40)).count() == 26


def test_guards_at_their_limits(spark):
    status = {r.market_id: r.status for r in features.series_guards(series_of(spark, 179, 180)).collect()}
    assert status == {0: "too few rows", 1: "ok"}
    assert [r.market_id for r in features.eligible_series(series_of(spark, 179, 180, 200)).collect()] == [2, 1]
    sparse = {r.market_id: r.test_rows for r in features.series_guards(series_of(spark, 180, gap=3)).collect()}
    assert sparse == {0: 10}
    sparser = features.series_guards(series_of(spark, 180, gap=4)).first()
    assert (sparser.test_rows, sparser.status) == (8, "too few test rows")


def test_split_is_by_calendar(spark):
    split = features.time_split(series_of(spark, 100, gap=2))
    assert split.filter("is_test").count() == 15


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 100.0, 110.0), (1, 200.0, 180.0), (1, 0.0, 5.0)], "k int, y double, p double")
    df = df.select("k", *[F.col(c).cast("decimal(12,2)").alias(c) for c in "yp"])
    m = evaluation.evaluate(df, ["k"], "y", "p").first()
    assert m.mape == pytest.approx(10.0) and m.rmse == pytest.approx(175**0.5) and m.r2_score == pytest.approx(0.97375)
    flat = evaluation.evaluate(df.withColumn("y", F.lit(0).cast("decimal(12,2)")), ["k"], "y", "p").first()
    assert (flat.mape, flat.r2_score) == (0.0, 0.0)


def test_clipping(spark):
    df = spark.createDataFrame([(5000.0, 1e12, -1e6), (1.005, 2.0, 1.0)], "mape double, rmse double, r2_score double")
    first = evaluation.clip_metrics(df).collect()[0]
    assert tuple(map(float, first)) == (999.99, 99999999.99, -999.99)


def test_ridge_against_numpy(spark):
    series = series_of(spark, 200, 220, 60)
    trained = training.train_series(series)
    fitted = {r.market_id: r for r in trained.models.collect()}
    assert set(fitted) == {0, 1}
    for market in fitted:
        rows = trained.train.filter(F.col("market_id") == market).toPandas()
        x = rows[models.FEATURES].to_numpy(float)
        y = rows.modal_price.astype(float).to_numpy()
        scale = x.std(axis=0)
        scale[scale == 0] = 1
        z = (x - x.mean(axis=0)) / scale
        weights = np.linalg.solve(z.T @ z + models.RIDGE * np.eye(8), z.T @ (y - y.mean()))
        assert np.allclose(fitted[market].coefficients, weights / scale, rtol=1e-5, atol=1e-7)
        assert sum(fitted[market].importances) == pytest.approx(1)
    summary = {r.status: r.series for r in trained.summary().collect()}
    assert summary == {"succeeded": 2, "failed: too few rows": 1}
    assert trained.importances().count() == 16
    missing = models.missing_models(series, trained.models)
    assert [r.market_id for r in missing.collect()] == [2]


def test_constant_series_trains(spark):
    trained = training.train_series(series_of(spark, 200, price=lambda s, i: 50))
    model = trained.models.first()
    assert model.intercept == pytest.approx(50, abs=1e-3)
    metrics = trained.evaluations().first()
    assert float(metrics.r2_score) == 0 and float(metrics.mape) == pytest.approx(0, abs=0.01)


def test_buffers_need_fourteen_rows(spark):
    series = series_of(spark, 13, 14, 30)
    assert sorted(r.market_id for r in forecast.latest_14(series).collect()) == [1, 2]
    assert [(r.market_id, r.reason) for r in forecast.too_short(series).collect()] == [(0, "Need 14 days, found 13")]
    buffer = forecast.latest_14(series).filter("market_id = 2").first()
    assert len(buffer.prices) == 14 and buffer.prices[-1] == buffer.last_price
    assert buffer.last_date == EPOCH + datetime.timedelta(29)


def test_recursion_against_a_loop(spark):
    """A predictor that uses every kind of feature, against a plain loop."""
    series = series_of(spark, 30, 50)
    predictor = lambda f: (
        f["lag_1"] * 0.3 + f["lag_7"] * 0.2 + f["lag_14"] * 0.1 + f["roll_mean_7"] * 0.2 + f["roll_mean_14"] * 0.2
        + f["roll_std_7"] * 0.05 + f["weekday_num"] * 0.5 + f["month"] * 0.25
    )
    for buffer in forecast.latest_14(series).collect():
        prices, day, expected = list(buffer.prices), buffer.last_date, []
        for _ in range(3):
            day += datetime.timedelta(1)
            value = (
                prices[-1] * 0.3 + prices[-7] * 0.2 + prices[-14] * 0.1 + np.mean(prices[-7:]) * 0.2
                + np.mean(prices[-14:]) * 0.2 + np.std(prices[-7:], ddof=1) * 0.05 + day.weekday() * 0.5 + day.month * 0.25
            )
            expected.append(max(0.0, round(value, 2)))
            prices = prices[1:] + expected[-1:]
        steps = forecast.recursive_forecast(
            forecast.latest_14(series).filter(F.col("market_id") == buffer.market_id), predictor
        ).orderBy("step").collect()
        assert [r.predicted for r in steps] == pytest.approx(expected, abs=0.0101)
        assert [r.date for r in steps] == [buffer.last_date + datetime.timedelta(n) for n in (1, 2, 3)]


def test_bands_by_hand(spark):
    rows = [(1, 1, s, p, 100.0) for s in (1, 2, 3) for p in (1000.0,)] + [(1, 2, 1, 150.0, 100.0)]
    df = spark.createDataFrame(rows, "market_id int, commodity_id int, step int, predicted double, rmse double")
    got = {(r.commodity_id, r.step): (r.lower, r.upper) for r in forecast.confidence_band(df).collect()}
    assert got[1, 1] == (804.0, 1196.0) and got[1, 2] == (722.81, 1277.19) and got[1, 3] == (660.52, 1339.48)
    assert got[2, 1][0] == 0.0


def test_decisions_by_hand(spark):
    finals = [(103.00, "STABLE"), (103.01, "HOLD"), (97.00, "STABLE"), (96.99, "SELL")]
    rows = [(i, 1, EPOCH, 100.0, 3, p) for i, (p, _) in enumerate(finals)] + [(9, 1, EPOCH, 0.0, 3, 5.0)]
    df = spark.createDataFrame(rows, "market_id int, commodity_id int, last_date date, last_price double, step int, predicted double")
    got = {r.market_id: r.action for r in forecast.recommendation(df).collect()}
    assert got == {i: action for i, (_, action) in enumerate(finals)} | {9: "STABLE"}


def test_forecast_chain_and_document(spark):
    import json

    series = series_of(spark, 200, 220)
    trained = training.train_series(series)
    banded = forecast_series(series, trained.evaluations(), fitted=trained.models)
    rows = banded.collect()
    assert len(rows) == 6 and all(r.lower <= r.predicted <= r.upper for r in rows)
    document = json.loads(forecast.forecast_document(banded, trained.importances()).orderBy("market_id").first().document)
    assert [f["date"] for f in document["forecast"]] == ["1970-07-20", "1970-07-21", "1970-07-22"]
    assert len(document["featureDrivers"]) == 8 and document["recommendation"]["action"] in ("HOLD", "SELL", "STABLE")
    chart = presentation.forecast_chart_rows(series, banded).filter("market_id = 0").orderBy("day_offset").collect()
    assert [r.name for r in chart] == ["Day -3", "Day -2", "Day -1", "Today", "Day +1", "Day +2", "Day +3"]
    assert presentation.top4_drivers(trained.importances()).count() == 8


def test_model_choice_by_name(spark):
    star = star_of(
        spark, [(1, 1, 1, 5), (1, 1, 2, 5), (1, 1, 3, 5), (1, 2, 1, 5), (1, 2, 2, 5), (1, 3, 1, 5), (1, 3, 2, 5)],
        evaluations=[(1, 1, 1.0, 0.1), (1, 2, 1.0, 0.4), (3, 1, 1.0, None), (3, 2, 1.0, -3)],
    )
    got = {(r.market_id, r.commodity): r.commodity_id for r in forecast.model_for_name(star).collect()}
    assert got == {(1, "Rice"): 2, (1, "Wheat"): 3, (2, "Rice"): 1, (3, "Rice"): 2}


def test_missing_metrics_get_defaults(spark):
    star = star_of(spark, [(1, 1, 1, 5)], evaluations=[(1, 1, 3.5, None)])
    series = spark.createDataFrame([(1, 1), (1, 2)], "market_id int, commodity_id int")
    got = {r.commodity_id: (r.mape, r.rmse, r.r2_score) for r in forecast.metrics_lookup(series, star.model_evaluation).collect()}
    assert got == {1: (3.5, 1.0, None), 2: (9.5, 150.0, 0.85)}


def test_shown_confidence(spark):
    star = star_of(spark, [(1, 1, 1, 5)], evaluations=[(1, 1, 1, 0.5), (1, 2, 1, 0.875), (1, 3, 1, None), (2, 1, 1, 0)])
    got = {(r.market_id, r.commodity_id): r.confidence for r in presentation.confidence_display(star.model_evaluation).collect()}
    assert got == {(1, 1): 70, (1, 2): 88, (1, 3): 85, (2, 1): 85}


def test_a_series_without_solution_gets_an_error(spark):
    """A price that is missing, or a value beyond 18 digits, leave the other series' model as it is."""
    train = training.train_series(series_of(spark, 200, 220)).train
    one, other = train.filter("market_id = 0"), train.filter("market_id = 1")
    missing = other.withColumn("modal_price", F.when(F.col("lag_1") > 110, F.col("modal_price")))
    endless = other.withColumn("market_id", F.lit(2)).withColumn("roll_mean_14", F.col("roll_mean_14") * 1e13)
    alone = models.fit_ridge(one).first()
    fitted = {r.market_id: r for r in models.fit_ridge(one.unionByName(missing).unionByName(endless)).collect()}
    assert fitted[0] == alone and alone.error is None
    for market in (1, 2):
        assert fitted[market].error == "moments are not finite" and fitted[market].coefficients is None
    assert [r.market_id for r in models.solved(models.fit_ridge(one.unionByName(missing))).collect()] == [0]


def test_without_a_penalty_equal_features_have_no_solution(spark):
    train = training.train_series(series_of(spark, 200)).train.withColumn("lag_7", F.col("lag_1")).withColumn("lag_14", F.col("lag_1"))
    assert models.fit_ridge(train, penalty=0.0).first().error in ("singular system", None)
    assert models.fit_ridge(train).first().error is None


def test_order_and_partitions_of_rows_change_no_digit(spark):
    train = training.train_series(series_of(spark, 200, 260)).train
    fits = [sorted(models.fit_ridge(rows).collect()) for rows in (train, train.orderBy(F.rand(3)).repartition(7))]
    assert fits[0] == fits[1]


def test_overview_documents_equal_one_by_one(spark):
    """All states and the national overview in one plan; Bihar has no market."""
    star = star_of(spark, FACTS, evaluations=[(1, 1, 3.5, 0.5), (3, 2, 10, None)])
    got = {r.state: r.document for r in documents.overview_documents(star).collect()}
    assert got == {state: documents.overview_document(star, state).first().document for state in (None, "Goa", "Assam", "Bihar")}


def test_explorer_document_of_any_selection(spark):
    import json

    star = star_of(spark, FACTS)
    document = lambda **selected: json.loads(documents.explorer_document(star, **selected).first().document)
    whole = document()
    assert len(whole["history"]) == len(FACTS) and whole["varietyComparison"] == []
    assert [p["modal_price"] for p in document(district="d", commodity="Rice")["history"]] == [5, 6, 10, 11, 12.5]
    one = document(market_id=3, commodity="Rice")
    assert [(v["variety"], v["avg_price"]) for v in one["varietyComparison"]] == [("x", 20), ("y", 7)]
    assert document(state_id=2) == {"history": [], "varietyComparison": []}


def test_requests_are_served_or_refused_with_a_reason(spark):
    import json

    facts = [(d, 1, 1, 10 + d % 3) for d in range(100, 120)] + [(d, 2, 3, 5) for d in range(100, 105)] + [(100, 3, 1, 9)]
    star = star_of(spark, facts, evaluations=[(1, 1, 3.5, 0.5)])
    models_of = [(1, 1, 1.0, [0.0] * 8), (2, 3, 1.0, [0.0] * 8)]
    fitted = spark.createDataFrame(models_of, "market_id int, commodity_id int, intercept double, coefficients array<double>")
    none = spark.createDataFrame([], "market_id int, commodity_id int, feature_name string, importance_score decimal(10,5)")
    asked = [(1, None, "Rice"), (1, 1, None), (1, 1, None), (2, 3, None), (3, None, "Rice"), (3, None, "Tea"), (9, 9, None)]
    requests = spark.createDataFrame(asked, "market_id int, commodity_id int, commodity string")
    answers = {(r.market_id, r.commodity): r for r in inference.forecast_requests(star, fitted, none, requests).collect()}
    assert len(answers) == 6
    assert [p["predicted_modal_price"] for p in json.loads(answers[1, "Rice"].document)["forecast"]] == [1, 1, 1]
    assert answers[1, None].document == answers[1, "Rice"].document and answers[1, "Rice"].refusal is None
    assert answers[2, None].refusal.endswith("Need 14 days, found 5.")
    assert answers[3, "Rice"].refusal.startswith("No trained model") and answers[9, None].refusal.startswith("No trained model")
    assert answers[3, "Tea"].refusal == "No active commodity 'Tea' found in market ID 3."
    assert all((r.document is None) != (r.refusal is None) for r in answers.values())


def test_boosted_model_is_stored_and_forecasts(spark, tmp_path):
    """The stored model forecasts as the fitted one and does not lose to last week's price."""
    facts = [
        (1000 + d, m, 1, 100 * m + 20 * ((d * 2 * m) % 7) + 3 * ((d * 13) % 5)) for m in (1, 2) for d in range(260)
    ]
    store = StarStore(spark, str(tmp_path / "store"))
    assert training.load_boosted(store) is None
    store.append_fact(star_of(spark, facts).fact)
    model = training.train_boosted(store, trees=10)
    loaded = training.load_boosted(store)
    series = features.fact_series(store.star())
    evaluations = store.read_latest("model_evaluation")
    steps = [
        sorted(map(tuple, forecast_series(series, evaluations, boosted=m).collect())) for m in (model, loaded)
    ]
    assert steps[0] == steps[1] and len(steps[0]) == 6
    importances = models.boosted_importances(spark, loaded).collect()
    assert len(importances) == 8 and abs(sum(float(r.importance_score) for r in importances) - 1) < 1e-3
    split = training.train_series(series)
    scored = evaluation.evaluate(models.predict_boosted(split.test, loaded), KEYS)
    naive = {tuple(r)[:2]: r.rmse for r in evaluation.baseline_eval(series, KEYS).select(*KEYS, "rmse").collect()}
    assert all(r.rmse <= naive[r.market_id, r.commodity_id] + 5 for r in scored.collect())


def test_validation_and_not_the_default_number_of_trees_ends_a_fit(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(4000):
        x = [rnd.random() for _ in range(5)]
        rows.append((i % 20, datetime.date(2020, 1, 1) + datetime.timedelta(i // 20), *x, 1.0, i % 7, i % 12 + 1, sum(x)))
    columns = "k int, arrival_date date, lag_1 double, lag_7 double, lag_14 double, roll_mean_7 double, roll_std_7 double"
    train = spark.createDataFrame(rows, f"{columns}, roll_mean_14 double, weekday_num int, month int, modal_price double")
    model = models.fit_boosted(train, ["k"], patience=5, rate=0.3).stages[-1]
    assert 10 <= model.getNumTrees < 1000
    # more trees do not help: the next five bring no lower error on the held-out days
    longer = models.fit_boosted(train, ["k"], patience=5, rate=0.3, trees=model.getNumTrees + 5).stages[-1]
    assert longer.getNumTrees == model.getNumTrees and longer.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
    assert models.fit_boosted(train, ["k"], patience=5, rate=0.3, trees=3).stages[-1].getNumTrees == 3


def test_patience_waits_for_a_lower_error():
    assert models.best_of([5.0, 4.0, 4.5, 3.9, 4.0, 4.1], 2) == (4, True)
    assert models.best_of([5.0, 4.0, 4.5, 4.4, 3.0], 2) == (2, True)
    assert models.best_of([5.0, 4.0, 3.0], 2) == (3, False)
    assert models.best_of([5.0, 5.0, 5.0], 2) == (1, True)
    assert models.best_of([5.0], 30) == (1, False)
