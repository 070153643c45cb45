"""Forecasts and decisions, with the exact weekly-mean predictor where SQL checks them."""

from pyspark.sql import functions as F

from harvestlens.constants import FEATURES, NO_COMMODITY, NO_MODEL, RECOMMENDATIONS, TOO_SHORT
from harvestlens.operators import evaluation, features, forecast, models, presentation
from harvestlens.plans.inference import forecast_requests, forecast_series
from harvestlens.queries.common import (
    PERSISTENCE, SERIES, baseline_eval_sql, clipped_sql, plain, rounded, typed,
)
from harvestlens.queries.features import features_sql
from harvestlens.queries.models import RIDGE_EVALUATED, ridge_prediction, state_series, trained_on
from harvestlens.session import write_and_read
from harvestlens.sources.tables import TradeTables

KEYS = ["market_id", "commodity"]
STATE_KEYS = ["state_id", "commodity"]


def series(spark, sf_dir):
    return TradeTables(spark, sf_dir).series()


def evaluations(rows):
    """Baseline metrics of the series long enough to be modelled."""
    metrics = evaluation.clip_metrics(evaluation.baseline_eval(rows, KEYS)).drop("n")
    return metrics.join(features.eligible_series(rows, KEYS).select(*KEYS), KEYS, "left_semi")


def banded(spark, sf_dir):
    rows = write_and_read(series(spark, sf_dir), "series")
    return rows, forecast_series(rows, evaluations(rows), forecast.mean_of_week, keys=KEYS)


def model_for_name(spark, sf_dir):
    return plain(forecast.model_for_name(TradeTables(spark, sf_dir)))


def metrics_lookup(spark, sf_dir):
    rows = write_and_read(series(spark, sf_dir), "series")
    return plain(forecast.metrics_lookup(rows.select(*KEYS).distinct(), evaluations(rows), KEYS))


def importances_of_series(spark, sf_dir):
    """Share of each price feature's mean in their sum, as stand-in importances."""
    means = features.feature_matrix(series(spark, sf_dir), KEYS)
    names = ["lag_1", "lag_7", "lag_14", "roll_std_7", "weekday_num", "month"]
    whole = {c: F.sum(F.round(F.col(c) * 100).cast("bigint")) for c in names}
    sums = means.groupBy(*KEYS).agg(*[total.alias(c) for c, total in whole.items()])
    score = F.try_divide(F.col("total").cast("double"), F.col("all").cast("double"))
    return (
        sums.withColumn("all", sum((F.col(c) for c in names[1:]), F.col(names[0])))
        .unpivot([*KEYS, "all"], names, "feature_name", "total")
        .select(*KEYS, "feature_name", F.floor(score * 100000).cast("decimal(12,0)").alias("score"))
        .select(*KEYS, "feature_name", (F.col("score") / 100000).cast("decimal(10,5)").alias("importance_score"))
    )


def feature_drivers(spark, sf_dir):
    return plain(forecast.feature_drivers(importances_of_series(spark, sf_dir), KEYS))


def top4_drivers(spark, sf_dir):
    return plain(presentation.top4_drivers(importances_of_series(spark, sf_dir), KEYS))


def latest_14(spark, sf_dir):
    return plain(
        forecast.latest_14(series(spark, sf_dir), KEYS)
        .select(*KEYS, "last_date", "last_price", F.posexplode("prices").alias("position", "price"))
    )


def too_short(spark, sf_dir):
    """Series by (market, commodity id) with fewer than 14 days."""
    rows = features.fact_series(TradeTables(spark, sf_dir))
    return plain(forecast.too_short(rows))


def step_features(spark, sf_dir):
    buffers = forecast.latest_14(series(spark, sf_dir), KEYS)
    values = forecast.step_features(F.col("prices"), F.date_add("last_date", 1))
    inexact = {"roll_mean_7", "roll_mean_14", "roll_std_7"}
    return plain(buffers.select(
        *KEYS, *[(F.round(v, 6) if name in inexact else v).alias(name) for name, v in values.items()]
    ))


def recursive_forecast(spark, sf_dir):
    buffers = forecast.latest_14(series(spark, sf_dir), KEYS)
    return plain(forecast.recursive_forecast(buffers, forecast.mean_of_week, KEYS))


def recursive_forecast_models(spark, sf_dir):
    """Forecasts of the state series by their ridge models."""
    rows = state_series(spark, sf_dir)
    training = trained_on(rows)
    return plain(forecast_series(rows, training.evaluations(STATE_KEYS), fitted=training.fitted, keys=STATE_KEYS))


def confidence_band(spark, sf_dir):
    return plain(banded(spark, sf_dir)[1])


def recommendation(spark, sf_dir):
    return plain(forecast.recommendation(banded(spark, sf_dir)[1], KEYS))


def forecast_document(spark, sf_dir):
    """Documents of the state series from their models."""
    rows = state_series(spark, sf_dir)
    training = trained_on(rows)
    steps = write_and_read(
        forecast_series(rows, training.evaluations(STATE_KEYS), fitted=training.fitted, keys=STATE_KEYS), "forecast"
    )
    return plain(forecast.forecast_document(steps, training.importances(STATE_KEYS), STATE_KEYS))


def forecast_chart_rows(spark, sf_dir):
    rows, steps = banded(spark, sf_dir)
    return plain(presentation.forecast_chart_rows(rows, steps, KEYS))


def confidence_display(spark, sf_dir):
    metrics = evaluation.clip_metrics(evaluation.baseline_eval(series(spark, sf_dir), KEYS))
    return plain(presentation.confidence_display(metrics, KEYS))


def forecast_range(spark, sf_dir):
    return plain(presentation.forecast_range(banded(spark, sf_dir)[1], KEYS))


def weekly_models(star):
    """Weekly-mean models of the series by id with at least 12 days, in the form of fitted ones."""
    long_enough = features.fact_series(star).groupBy(*features.KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n >= 12")
    weights = F.array(*[F.lit(1.0 if c == "roll_mean_7" else 0.0) for c in FEATURES])
    return long_enough.select(*features.KEYS, F.lit(0.0).alias("intercept"), weights.alias("coefficients"))


def forecast_request(spark, sf_dir):
    """Every name and every id of every market, and a name that none sells: what the answer forecasts, or why it does not."""
    star = TradeTables(spark, sf_dir)
    sold = star.fact.select(*features.KEYS).distinct()
    names = sold.join(star.commodity_dim.select("commodity_id", "commodity"), "commodity_id").select("market_id", "commodity")
    unknown = sold.select("market_id", F.lit("No such name").alias("commodity"))
    by_name = names.unionByName(unknown).withColumn("commodity_id", F.lit(None).cast("int"))
    requests = by_name.unionByName(sold.withColumn("commodity", F.lit(None).cast("string")))
    importances = weekly_models(star).select(
        *features.KEYS, F.lit("roll_mean_7").alias("feature_name"), F.lit(1).cast("decimal(10,5)").alias("importance_score")
    )
    answers = forecast_requests(star, weekly_models(star), importances, requests)
    part = lambda path: F.get_json_object("document", path)
    return plain(answers.select(
        *features.KEYS, "commodity", "refusal",
        part("$.forecast[2].predicted_modal_price").cast("double").alias("third_day"),
        part("$.recommendation.action").alias("action"),
        part("$.featureDrivers[0].feature").alias("driver"),
    ))


def recursive_forecast_boosted(spark, sf_dir):
    """Forecasts of the state series by the pooled boosted trees."""
    rows = state_series(spark, sf_dir)
    training = trained_on(rows)
    model = models.fit_boosted(training.train, STATE_KEYS)
    return plain(forecast_series(rows, training.evaluations(STATE_KEYS), keys=STATE_KEYS, boosted=model))


QUERIES = {
    f.__name__: f
    for f in (
        model_for_name, metrics_lookup, feature_drivers, latest_14, too_short, step_features,
        recursive_forecast, recursive_forecast_models, confidence_band, recommendation,
        forecast_document, forecast_request, recursive_forecast_boosted, forecast_chart_rows, top4_drivers,
        confidence_display, forecast_range,
    )
}

_KEY = "market_id, commodity"
_EVALUATED = f"""
clipped AS ({clipped_sql('(' + baseline_eval_sql(_KEY, 'series') + ')')}),
evaluations AS (SELECT * FROM clipped WHERE (market_id, commodity) IN
  (SELECT (market_id, commodity) FROM series GROUP BY market_id, commodity HAVING count(*) >= 180)),
metrics AS (SELECT market_id, commodity,
    CASE WHEN found THEN CAST(mape AS DOUBLE) ELSE 9.5 END AS mape,
    CASE WHEN found THEN CAST(rmse AS DOUBLE) ELSE 150.0 END AS rmse,
    CASE WHEN found THEN CAST(r2_score AS DOUBLE) ELSE 0.85 END AS r2_score
  FROM (SELECT DISTINCT market_id, commodity FROM series) LEFT JOIN
    (SELECT *, true AS found FROM evaluations) USING (market_id, commodity))"""

_BUFFERS = """
newest AS (SELECT *, row_number() OVER (PARTITION BY market_id, commodity ORDER BY arrival_date DESC) AS newness FROM series),
buffers AS (SELECT market_id, commodity, max(arrival_date) AS last_date,
    list(CAST(modal_price * 100 AS BIGINT) ORDER BY arrival_date) AS c
  FROM newest WHERE newness <= 14 GROUP BY ALL HAVING count(*) = 14)"""

# One step in whole cents: the mean of seven cent amounts is never half a cent.
_STEPS = f"""{_BUFFERS},
first_step AS (SELECT *, CAST(round(list_sum(c[8:14]) / 7.0) AS BIGINT) AS p1 FROM buffers),
second_step AS (SELECT *, CAST(round((list_sum(c[9:14]) + p1) / 7.0) AS BIGINT) AS p2 FROM first_step),
third_step AS (SELECT *, CAST(round((list_sum(c[10:14]) + p1 + p2) / 7.0) AS BIGINT) AS p3 FROM second_step),
steps AS (SELECT market_id, commodity, last_date, CAST(c[14] AS DOUBLE) / 100.0 AS last_price,
    unnest([1, 2, 3]) AS step, CAST(unnest([p1, p2, p3]) AS DOUBLE) / 100.0 AS predicted FROM third_step),
forecasts AS (SELECT *, last_date + CAST(step AS INTEGER) AS date FROM steps)"""

_REACH = "CAST(1.96 AS DOUBLE) * rmse * sqrt(CAST(step AS DOUBLE))"
_BANDED = f"""{_EVALUATED}, {_STEPS},
banded AS (SELECT *, greatest(0.0, {rounded('predicted - ' + _REACH)}) AS lower, {rounded('predicted + ' + _REACH)} AS upper
  FROM forecasts JOIN metrics USING (market_id, commodity))"""

_CHANGE = rounded("(predicted - last_price) / last_price * CAST(100 AS DOUBLE)")

_NAMES = ["lag_1", "lag_7", "lag_14", "roll_std_7", "weekday_num", "month"]


def _drivers():
    sums = ", ".join(f"sum(CAST(round({c} * CAST(100 AS DOUBLE)) AS BIGINT)) AS {c}" for c in _NAMES)
    rows = " UNION ALL ".join(
        f"SELECT market_id, commodity, '{c}' AS feature, floor(CAST({c} AS DOUBLE) / CAST({' + '.join(_NAMES)} AS DOUBLE) * 100000) AS score FROM sums"
        for c in _NAMES
    )
    return f"""{SERIES}, {features_sql(_KEY, 'series')},
sums AS (SELECT market_id, commodity, {sums} FROM matrix GROUP BY ALL),
scores AS ({rows}),
drivers AS (SELECT *, row_number() OVER (PARTITION BY market_id, commodity ORDER BY score DESC, feature) AS rank,
  {rounded('score / CAST(100000 AS DOUBLE)', 4)} AS importance FROM scores)"""


_LABELS = (
    "CASE feature WHEN 'lag_1' THEN '1-Day Price Lag' WHEN 'lag_7' THEN '7-Day Price Lag'"
    " WHEN 'lag_14' THEN '14-Day Price Lag' WHEN 'roll_std_7' THEN 'Price Volatility'"
    " WHEN 'weekday_num' THEN 'Weekly Seasonality' ELSE 'Monthly Seasonality' END"
)

_STATE = "state_id, commodity"


def _model_steps():
    """CTEs up to `banded`: three forecast steps of the state series by their models, in whole cents."""
    sums = "list_sum({0})"
    features = {
        "lag_1": "CAST(c[14] AS DOUBLE) / 100", "lag_7": "CAST(c[8] AS DOUBLE) / 100", "lag_14": "CAST(c[1] AS DOUBLE) / 100",
        "roll_mean_7": f"CAST({sums.format('c[8:14]')} AS DOUBLE) / 700", "roll_mean_14": f"CAST({sums.format('c')} AS DOUBLE) / 1400",
        "roll_std_7": f"sqrt(CAST(7 * {sums.format('list_transform(c[8:14], lambda x: CAST(x AS HUGEINT) * x)')}"
        f" - {sums.format('c[8:14]')} * {sums.format('c[8:14]')} AS DOUBLE) / 42) / 100",
        "weekday_num": "CAST(isodow(last_date + {0}) - 1 AS DOUBLE)", "month": "CAST(month(last_date + {0}) AS DOUBLE)",
    }
    parts = [f"""newest AS (SELECT *, row_number() OVER (PARTITION BY {_STATE} ORDER BY arrival_date DESC) AS newness FROM series),
buffers AS (SELECT {_STATE}, max(arrival_date) AS last_date, list(CAST(modal_price * 100 AS BIGINT) ORDER BY arrival_date) AS c
  FROM newest WHERE newness <= 14 GROUP BY ALL HAVING count(*) = 14),
step_0 AS (SELECT buffers.*, models.* EXCLUDE (state_id, commodity), c[14] AS p0 FROM buffers JOIN models USING ({_STATE}))"""]
    for step in (1, 2, 3):
        predicted = ridge_prediction(lambda name: f"({features[name].format(step)})")  # noqa: B023
        whole = f"CAST(round(greatest(0.0, {rounded(predicted)}) * 100) AS BIGINT)"
        parts.append(f"guess_{step} AS (SELECT *, {whole} AS p{step} FROM step_{step - 1})")
        parts.append(f"step_{step} AS (SELECT * REPLACE (list_append(c[2:14], p{step}) AS c) FROM guess_{step})")
    parts.append(f"""steps AS (SELECT {_STATE}, last_date, CAST(p0 AS DOUBLE) / 100 AS last_price,
  unnest([1, 2, 3]) AS step, CAST(unnest([p1, p2, p3]) AS DOUBLE) / 100 AS predicted FROM step_3),
measures AS (SELECT {_STATE}, CAST(mape AS DOUBLE) AS mape, CAST(rmse AS DOUBLE) AS rmse, CAST(r2_score AS DOUBLE) AS r2_score FROM model_metrics),
banded AS (SELECT *, last_date + CAST(step AS INTEGER) AS date, greatest(0.0, {rounded('predicted - ' + _REACH)}) AS lower,
  {rounded('predicted + ' + _REACH)} AS upper FROM steps JOIN measures USING ({_STATE}))""")
    return f"{RIDGE_EVALUATED}, " + ", ".join(parts)


def _json_number(value):
    """A number as JSON the way Java prints it, for ten-thousandths below one."""
    return f"CASE WHEN {value} > 0 AND {value} < 0.001 THEN CAST(round({value} * 10000) AS BIGINT) || '.0E-4' ELSE CAST({value} AS VARCHAR) END"


def _json_object(**fields):
    return "'{' || " + " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in fields.items()) + " || '}'"


def _text(value):
    return f"'\"' || {value} || '\"'"


def _day(value):
    return _text(f"strftime({value}, '%Y-%m-%d')")


_DOCUMENT_SQL = f"""{_model_steps()},
final AS (SELECT *, CASE WHEN last_price > 0 THEN {_CHANGE} ELSE 0.0 END AS pct FROM banded WHERE step = 3),
decided AS (SELECT *, CASE WHEN pct > 3 THEN 'HOLD' WHEN pct < -3 THEN 'SELL' ELSE 'STABLE' END AS action FROM final),
points AS (SELECT {_STATE}, string_agg({_json_object(date=_day('date'), predicted_modal_price=_json_number('predicted'),
  lower_bound=_json_number('lower'), upper_bound=_json_number('upper'))}, ',' ORDER BY step) AS points FROM banded GROUP BY {_STATE}),
shares AS ({" UNION ALL ".join(f"SELECT {_STATE}, '{c}' AS feature, CAST(share_{c} AS DECIMAL(10,5)) AS score FROM models" for c in FEATURES)}),
listed AS (SELECT {_STATE}, feature, score, {rounded('CAST(score AS DOUBLE)', 4)} AS importance FROM shares),
drivers AS (SELECT {_STATE}, string_agg({_json_object(feature=_text('feature'), importance=_json_number('importance'))}, ',' ORDER BY score DESC, feature) AS drivers
  FROM listed GROUP BY {_STATE}),
texts(action, description, class) AS (VALUES {", ".join(f"('{name}', '{text}', '{kind}')" for name, (text, kind) in RECOMMENDATIONS.items())})
SELECT CAST(state_id AS BIGINT) AS state_id, commodity, {_json_object(
    state_id='state_id', commodity=_text('commodity'), latest_actual=_json_object(date=_day('last_date'), price=_json_number('last_price')),
    forecast="'[' || points || ']'", metrics=_json_object(mape=_json_number('mape'), rmse=_json_number('rmse'), r2_score=_json_number('r2_score')),
    featureDrivers="'[' || drivers || ']'",
    recommendation=_json_object(action=_text('action'), description=_text('description'), pct_change=_json_number('pct'), **{'class': _text('class')}),
)} AS document FROM decided JOIN points USING ({_STATE}) JOIN drivers USING ({_STATE}) JOIN texts USING (action)"""

SQL = {
    "model_for_name": f"""WITH {PERSISTENCE},
sold AS (SELECT DISTINCT market_id, commodity_id, commodity FROM named),
placed AS (SELECT market_id, commodity, commodity_id, r2_score, row_number() OVER (PARTITION BY market_id, commodity
  ORDER BY r2_score DESC NULLS LAST, commodity_id) AS place FROM sold LEFT JOIN model_evaluation USING (market_id, commodity_id))
""" + typed("market_id:l commodity:s commodity_id:l r2_score:d", "placed WHERE place = 1"),
    "metrics_lookup": f"WITH {SERIES}, {_EVALUATED} " + typed("market_id:l commodity:s mape:d rmse:d r2_score:d", "metrics"),
    "feature_drivers": f"WITH {_drivers()} " + typed("market_id:l commodity:s rank:l feature:s importance:d", "drivers"),
    "top4_drivers": f"WITH {_drivers()} " + typed(
        "market_id:l commodity:s rank:l label:s percentage:l",
        f"(SELECT *, {_LABELS} AS label, floor(importance * CAST(100 AS DOUBLE) + 0.5) AS percentage FROM drivers WHERE rank <= 4)",
    ),
    "latest_14": f"WITH {SERIES}, {_BUFFERS} " + typed(
        "market_id:l commodity:s last_date:t last_price:d position:l price:d",
        "(SELECT market_id, commodity, last_date, CAST(c[14] AS DOUBLE) / 100.0 AS last_price,"
        " unnest(range(14)) AS position, CAST(unnest(c) AS DOUBLE) / 100.0 AS price FROM buffers)",
    ),
    "too_short": f"""WITH {PERSISTENCE}, counts AS (SELECT market_id, commodity_id, count(*) AS n_rows FROM fact GROUP BY ALL)
""" + typed(
        "market_id:l commodity_id:l n_rows:l reason:s",
        "(SELECT *, 'Need 14 days, found ' || n_rows AS reason FROM counts WHERE n_rows < 14)",
    ),
    "step_features": f"""WITH {SERIES}, {_BUFFERS},
spread AS (SELECT *, list_sum(c[8:14]) AS s7, list_sum(list_transform(c[8:14], lambda x: CAST(x AS HUGEINT) * x)) AS q7,
  last_date + 1 AS day FROM buffers)
SELECT CAST(market_id AS BIGINT) AS market_id, commodity,
  CAST(c[14] AS DOUBLE) / 100.0 AS lag_1, CAST(c[8] AS DOUBLE) / 100.0 AS lag_7, CAST(c[1] AS DOUBLE) / 100.0 AS lag_14,
  round(CAST(s7 AS DOUBLE) / 700.0, 6) AS roll_mean_7, round(CAST(list_sum(c) AS DOUBLE) / 1400.0, 6) AS roll_mean_14,
  round(sqrt(CAST(7 * q7 - s7 * s7 AS DOUBLE) / 42.0) / 100.0, 6) AS roll_std_7,
  CAST(isodow(day) - 1 AS BIGINT) AS weekday_num, CAST(month(day) AS BIGINT) AS month FROM spread""",
    "recursive_forecast": f"WITH {SERIES}, {_STEPS} "
    + typed("market_id:l commodity:s last_date:t last_price:d step:l date:t predicted:d", "forecasts"),
    "recursive_forecast_models": _model_steps() + " " + typed(
        "state_id:l commodity:s last_date:t last_price:d step:l date:t predicted:d mape:d rmse:d r2_score:d lower:d upper:d", "banded"
    ),
    "forecast_document": _DOCUMENT_SQL,
    "confidence_band": f"WITH {SERIES}, {_BANDED} " + typed(
        "market_id:l commodity:s last_date:t last_price:d step:l date:t predicted:d mape:d rmse:d r2_score:d lower:d upper:d",
        "banded",
    ),
    "recommendation": f"""WITH {SERIES}, {_STEPS},
changes AS (SELECT *, CASE WHEN last_price > 0 THEN {_CHANGE} ELSE 0.0 END AS pct_change FROM forecasts WHERE step = 3),
actions AS (SELECT *, CASE WHEN pct_change > 3 THEN 'HOLD' WHEN pct_change < -3 THEN 'SELL' ELSE 'STABLE' END AS action FROM changes),
decided AS (SELECT *,
  CASE action WHEN 'HOLD' THEN '{RECOMMENDATIONS["HOLD"][0]}' WHEN 'SELL' THEN '{RECOMMENDATIONS["SELL"][0]}'
    ELSE '{RECOMMENDATIONS["STABLE"][0]}' END AS description,
  CASE action WHEN 'HOLD' THEN 'gainer' WHEN 'SELL' THEN 'loser' ELSE 'stable' END AS trend_class FROM actions)
""" + typed(
        "market_id:l commodity:s last_date:t last_price:d pct_change:d action:s description:s trend_class:s", "decided"
    ),
    "forecast_request": f"""WITH {PERSISTENCE},
series AS (SELECT market_id, CAST(commodity_id AS VARCHAR) AS commodity, arrival_date, modal_price FROM fact), {_STEPS},
lengths AS (SELECT market_id, commodity_id, least(count(*), 14) AS n, count(*) >= 12 AS modelled FROM fact GROUP BY ALL),
sold AS (SELECT DISTINCT market_id, commodity_id, commodity FROM named),
placed AS (SELECT market_id, commodity, commodity_id, row_number() OVER (PARTITION BY market_id, commodity
  ORDER BY r2_score DESC NULLS LAST, commodity_id) AS place FROM sold LEFT JOIN model_evaluation USING (market_id, commodity_id)),
asked AS (SELECT market_id, commodity_id, commodity FROM placed WHERE place = 1 UNION ALL SELECT market_id, commodity_id, NULL FROM sold
  UNION ALL SELECT DISTINCT market_id, NULL, 'No such name' FROM sold),
decided AS (SELECT market_id, CAST(commodity AS BIGINT) AS commodity_id, predicted, CASE WHEN last_price > 0 THEN {_CHANGE} ELSE 0.0 END AS pct
  FROM forecasts WHERE step = 3),
answers AS (SELECT asked.*, CASE
    WHEN commodity_id IS NULL THEN replace('{NO_COMMODITY.replace("'", "''").replace("{}", "{0}", 1)}', '{{0}}', commodity)
    WHEN NOT modelled THEN '{NO_MODEL}' WHEN n < 14 THEN '{TOO_SHORT.replace("{}", "14", 1)}' END AS pattern, n, predicted, pct
  FROM asked LEFT JOIN lengths USING (market_id, commodity_id) LEFT JOIN decided USING (market_id, commodity_id)),
served AS (SELECT *, replace(pattern, '{{}}', CAST(coalesce(n, market_id) AS VARCHAR)) AS refusal FROM answers)
""" + typed(
        "market_id:l commodity_id:l commodity:s refusal:s third_day:d action:s driver:s",
        "(SELECT *, CASE WHEN refusal IS NULL THEN predicted END AS third_day, CASE WHEN refusal IS NULL THEN 'roll_mean_7' END AS driver,"
        " CASE WHEN refusal IS NOT NULL THEN NULL WHEN pct > 3 THEN 'HOLD' WHEN pct < -3 THEN 'SELL' ELSE 'STABLE' END AS action FROM served)",
    ),
    "forecast_chart_rows": f"""WITH {SERIES}, {_BANDED},
actuals AS (SELECT market_id, commodity, 1 - newness AS day_offset,
    CASE WHEN newness = 1 THEN 'Today' ELSE 'Day -' || (newness - 1) END AS name, CAST(modal_price AS DOUBLE) AS actual
  FROM newest SEMI JOIN banded USING (market_id, commodity) WHERE newness <= 4),
chart AS (SELECT market_id, commodity, day_offset, name, actual, actual AS forecast, actual AS lower, actual AS upper FROM actuals
  UNION ALL SELECT market_id, commodity, step, 'Day +' || step, NULL, predicted, lower, upper FROM banded)
""" + typed("market_id:l commodity:s day_offset:l name:s actual:d forecast:d lower:d upper:d", "chart"),
    "confidence_display": f"WITH {SERIES}, clipped AS ({clipped_sql('(' + baseline_eval_sql(_KEY, 'series') + ')')}) " + typed(
        "market_id:l commodity:s confidence:l r2_score:d",
        "(SELECT *, greatest(70, floor(coalesce(nullif(CAST(r2_score AS DOUBLE), 0), 0.85) * 100 + 0.5)) AS confidence FROM clipped)",
    ),
    "forecast_range": f"WITH {SERIES}, {_BANDED} " + typed(
        "market_id:l commodity:s forecast_min:d forecast_max:d spread:d",
        "(SELECT market_id, commodity, max(lower) FILTER (WHERE step = 1) AS forecast_min,"
        " max(upper) FILTER (WHERE step = 3) AS forecast_max, max(rmse) * CAST(1.96 AS DOUBLE) AS spread FROM banded GROUP BY ALL)",
    ),
}
