"""Model fitting and evaluation."""

from pyspark.sql import functions as F

from harvestlens.constants import FEATURES
from harvestlens.operators import evaluation, features, models
from harvestlens.plans.training import train_series
from harvestlens.queries.common import (
    SERIES, STATE_SERIES, baseline_eval_sql, baseline_sql, clipped_sql, plain, typed,
)
from harvestlens.queries.features import features_sql, guards_sql
from harvestlens.session import write_and_read
from harvestlens.sources.star_store import bulk_upsert
from harvestlens.sources.tables import TradeTables

KEYS = ["market_id", "commodity"]
STATE_KEYS = ["state_id", "commodity"]


def baseline(spark, sf_dir):
    return evaluation.baseline_eval(TradeTables(spark, sf_dir).series(), KEYS)


def one_metric(name):
    def query(spark, sf_dir):
        return plain(baseline(spark, sf_dir).select(*KEYS, F.round(name, 6).alias(name)))

    return query


def baseline_predictions(spark, sf_dir):
    return plain(evaluation.baseline_predictions(TradeTables(spark, sf_dir).series(), KEYS))


def clip_metrics(spark, sf_dir):
    return plain(evaluation.clip_metrics(baseline(spark, sf_dir)))


def baseline_eval(spark, sf_dir):
    """The same by state."""
    metrics = evaluation.baseline_eval(TradeTables(spark, sf_dir).state_series(), STATE_KEYS)
    return plain(evaluation.clip_metrics(metrics))


def state_series(spark, sf_dir):
    """All state series, written once."""
    return write_and_read(TradeTables(spark, sf_dir).state_series(), "series")


def trained_on(series):
    """Ridge models of all series, written once."""
    training = train_series(series, STATE_KEYS)
    training.models = write_and_read(training.models, "models")
    return training


def trained(spark, sf_dir):
    return trained_on(state_series(spark, sf_dir))


def model_columns(fitted):
    """Models with a column per coefficient, to six places."""
    weights = [F.round(F.col("coefficients")[i], 6).alias(f"per_{c}") for i, c in enumerate(FEATURES)]
    return fitted.select(*STATE_KEYS, F.round("intercept", 6).alias("intercept"), *weights, "error")


def fit_price_model(spark, sf_dir):
    return plain(model_columns(trained(spark, sf_dir).models))


def predict_test(spark, sf_dir):
    training = trained(spark, sf_dir)
    rows = models.predict_ridge(training.test, training.fitted, STATE_KEYS)
    return plain(rows.select(*STATE_KEYS, "arrival_date", "modal_price", F.round("predicted", 6).alias("predicted")))


def model_metrics(spark, sf_dir):
    """The stored metrics of the models over their test rows."""
    return plain(trained(spark, sf_dir).evaluations(STATE_KEYS))


def predicted_rows(spark, sf_dir):
    """The test rows the models predict: their exact columns, and that there is a number."""
    rows = predict_test(spark, sf_dir)
    number = F.col("predicted").isNotNull() & ~F.isnan("predicted")
    return rows.select(*STATE_KEYS, "arrival_date", "modal_price", number.alias("has_prediction"))


def ridge_optimality(spark, sf_dir):
    """Whether each model solves its normal equations on its training rows."""
    training = trained(spark, sf_dir)
    return plain(models.optimality(training.train, training.fitted, STATE_KEYS))


def importance_totals(spark, sf_dir):
    """Eight importances per model, which sum to 1."""
    rows = trained(spark, sf_dir).importances(STATE_KEYS)
    sums = rows.groupBy(*STATE_KEYS).agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance_score"), 3).alias("total")
    )
    return plain(sums)


def fit_pooled_model(spark, sf_dir):
    """Test metrics per series of boosted trees over all series."""
    training = trained(spark, sf_dir)
    model = models.fit_boosted(training.train, STATE_KEYS)
    scored = models.predict_boosted(training.test, model, STATE_KEYS)
    return plain(evaluation.clip_metrics(evaluation.evaluate(scored, STATE_KEYS)))


def feature_importances(spark, sf_dir):
    return plain(trained(spark, sf_dir).importances(STATE_KEYS))


def training_summary(spark, sf_dir):
    return trained(spark, sf_dir).summary(STATE_KEYS)


def training_summary_by_market(spark, sf_dir):
    """The summary of the market series, most of which fail a guard on small tables."""
    return train_series(TradeTables(spark, sf_dir).series(), KEYS).summary(KEYS)


def save_evaluations(spark, sf_dir):
    """Baseline metrics of all state series, replaced by the models' where there is one."""
    series = state_series(spark, sf_dir)
    training = trained_on(series)
    stored = evaluation.clip_metrics(evaluation.baseline_eval(series, STATE_KEYS)).drop("n")
    return plain(bulk_upsert(stored, training.evaluations(STATE_KEYS), STATE_KEYS))


QUERIES = {
    "fit_price_model": fit_price_model,
    "fit_pooled_model": fit_pooled_model,
    "predict_test": predict_test,
    "predicted_rows": predicted_rows,
    "ridge_optimality": ridge_optimality,
    "importance_totals": importance_totals,
    "model_metrics": model_metrics,
    "mape": one_metric("mape"),
    "rmse": one_metric("rmse"),
    "r2": one_metric("r2_score"),
    "clip_metrics": clip_metrics,
    "feature_importances": feature_importances,
    "training_summary": training_summary,
    "training_summary_by_market": training_summary_by_market,
    "save_evaluations": save_evaluations,
    "baseline_predictions": baseline_predictions,
    "baseline_eval": baseline_eval,
}

_KEY, _STATE_KEY = "market_id, commodity", "state_id, commodity"
_BASELINE = f"WITH {SERIES}, metrics AS ({baseline_eval_sql(_KEY, 'series')}) "


def _metric(name):
    return _BASELINE + f"SELECT CAST(market_id AS BIGINT) AS market_id, commodity, round({name}, 6) AS {name} FROM metrics"


def _summary(keys, series):
    return (
        f"WITH {series}, {guards_sql(keys, 'series', 'guards')} "
        "SELECT CASE status WHEN 'ok' THEN 'succeeded' ELSE 'failed: ' || status END AS status, count(*) AS series"
        " FROM guards GROUP BY 1"
    )


def _double(value):
    """A whole number of up to 128 bits as the nearest double, as a decimal is converted."""
    return f"(CAST(({value}) // 1099511627776 AS DOUBLE) * CAST(1099511627776 AS DOUBLE) + CAST(({value}) % 1099511627776 AS DOUBLE))"


def ridge_sql(keys, source, name, penalty=models.RIDGE):
    """CTEs up to `name`: keys, intercept, per_<feature> and share_<feature> of the ridge model of each key of `source`.

    Moments in whole numbers, then the elimination of a symmetric system pivot by pivot, and the weights from the last on.
    """
    size, cte = len(FEATURES), []
    pairs = [(i, j) for i in range(size + 1) for j in range(i, size + 1)]
    square = [(i, j) for i, j in pairs if j < size]
    last = f"{name}_0"
    units = [models.UNITS[c] for c in [*FEATURES, models.LABEL]]

    def step(columns, group=""):
        nonlocal last
        following = f"{name}_{len(cte)}"
        cte.append(f"{following} AS (SELECT {', '.join(columns)} FROM {last if cte else source}{group})")
        last = following

    half = "CAST(0.5 AS DOUBLE)"
    step([keys, *[f"CAST(floor(CAST({c} AS DOUBLE) * {u} + {half}) AS HUGEINT) AS v{i}" for i, (c, u) in enumerate(zip([*FEATURES, models.LABEL], units, strict=True))]])
    step([keys, "count(*) AS n", *[f"sum(v{i}) AS s{i}" for i in range(size + 1)], *[f"sum(v{i} * v{j}) AS p{i}_{j}" for i, j in pairs]], f" GROUP BY {keys}")
    step([keys, "CAST(n AS DOUBLE) AS n", *[f"CAST(s{i} AS DOUBLE) / n / {u} AS m{i}" for i, u in enumerate(units)],
          *[f"{_double(f'n * p{i}_{j} - s{i} * s{j}')} AS c{i}_{j}" for i, j in pairs]])
    step(["*", *[f"sqrt(c{i}_{i}) AS t{i}" for i in range(size)]])
    ridge = f"CAST({penalty} AS DOUBLE) / n"
    step([
        keys, "n", *[f"m{i}" for i in range(size + 1)], *[f"t{i}" for i in range(size)],
        *[f"CASE WHEN t{i} > 0 THEN CAST(1 AS DOUBLE) ELSE 0 END + {ridge} AS a{i}_{i}" for i in range(size)],
        *[f"CASE WHEN t{i} > 0 AND t{j} > 0 THEN c{i}_{j} / (t{i} * t{j}) ELSE 0 END AS a{i}_{j}" for i, j in square if i < j],
        *[f"CASE WHEN t{i} > 0 THEN c{i}_{size} / (t{i} * n) ELSE 0 END AS b{i}" for i in range(size)],
    ])
    for k in range(size - 1):
        rows = range(k + 1, size)
        changed = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i in rows for j in range(i, size)]
        step([f"* REPLACE ({', '.join(changed + [f'b{i} - a{k}_{i} * b{k} / a{k}_{k} AS b{i}' for i in rows])})"])
    for i in reversed(range(size)):
        step(["*", "(b{0}{1}) / a{0}_{0} AS w{0}".format(i, "".join(f" - a{i}_{j} * w{j}" for j in range(i + 1, size)))])
    total = " + ".join(f"abs(w{i})" for i in range(size))
    step(["*", f"{total} AS strength", *[f"CASE WHEN t{i} > 0 THEN w{i} * n / t{i} * {units[i]} / 100 ELSE 0 END AS per_{c}" for i, c in enumerate(FEATURES)]])
    cte.append(
        f"{name} AS (SELECT {keys}, m{size}{''.join(f' - per_{c} * m{i}' for i, c in enumerate(FEATURES))} AS intercept,"
        f" {', '.join(f'per_{c}' for c in FEATURES)},"
        f" {', '.join(f'CASE WHEN strength > 0 THEN abs(w{i}) / strength ELSE 0 END AS share_{c}' for i, c in enumerate(FEATURES))} FROM {last})"
    )
    return ", ".join(cte)


def ridge_prediction(feature=lambda c: f"CAST({c} AS DOUBLE)"):
    """Intercept plus weighted features, as SQL over columns of a model."""
    return "intercept" + "".join(f" + per_{c} * {feature(c)}" for c in FEATURES)


_FITTED = f"WITH {STATE_SERIES}, {features_sql(_STATE_KEY, 'series', causal=True)}, {guards_sql(_STATE_KEY, 'series', 'guards')} "
_OK = "SEMI JOIN (SELECT * FROM guards WHERE status = 'ok') USING (state_id, commodity)"

_USABLE = f"usable AS (SELECT * FROM split {_OK}), learned AS (SELECT * FROM usable WHERE NOT is_test)"
RIDGE_MODELS = f"{_FITTED}, {_USABLE}, {ridge_sql(_STATE_KEY, 'learned', 'models')}"
_TESTED = (
    f"tested AS (SELECT usable.*, {ridge_prediction()} AS predicted FROM usable JOIN models USING ({_STATE_KEY}) WHERE is_test)"
)
# errors in hundredths of a cent
RIDGE_EVALUATED = f"""{RIDGE_MODELS}, {_TESTED},
in_parts AS (SELECT *, CAST(modal_price * 10000 AS HUGEINT) AS y, CAST(floor(predicted * 10000 + CAST(0.5 AS DOUBLE)) AS HUGEINT) AS p FROM tested),
measured AS (SELECT {_STATE_KEY}, count(*) AS n,
  coalesce(CAST(sum(CAST(abs(CAST(y - p AS DOUBLE) / 10000 / CAST(modal_price AS DOUBLE)) AS DECIMAL(28,9))) FILTER (WHERE y <> 0) AS DOUBLE)
    / count(*) FILTER (WHERE y <> 0) * 100, 0) AS mape,
  sqrt(CAST(sum((y - p) * (y - p)) AS DOUBLE) / 100000000 / count(*)) AS rmse,
  CASE WHEN count(*) * sum(y * y) = sum(y) * sum(y) THEN 0 ELSE
    CAST(1 AS DOUBLE) - count(*) * CAST(sum((y - p) * (y - p)) AS DOUBLE) / CAST(count(*) * sum(y * y) - sum(y) * sum(y) AS DOUBLE) END AS r2_score
  FROM in_parts GROUP BY {_STATE_KEY}),
model_metrics AS ({clipped_sql('measured')})"""
_METRICS = "state_id:l commodity:s mape:d rmse:d r2_score:d"

SQL = {
    "fit_price_model": RIDGE_MODELS + " SELECT CAST(state_id AS BIGINT) AS state_id, commodity, round(intercept, 6) AS intercept, "
    + ", ".join(f"round(per_{c}, 6) AS per_{c}" for c in FEATURES) + ", CAST(NULL AS VARCHAR) AS error FROM models",
    "predict_test": f"{RIDGE_MODELS}, {_TESTED} " + typed(
        "state_id:l commodity:s arrival_date:t modal_price:d predicted:d", "(SELECT * REPLACE (round(predicted, 6) AS predicted) FROM tested)"
    ),
    "feature_importances": RIDGE_MODELS + " " + " UNION ALL ".join(
        f"SELECT CAST(state_id AS BIGINT) AS state_id, commodity, '{c}' AS feature_name,"
        f" CAST(CAST(share_{c} AS DECIMAL(10,5)) AS DOUBLE) AS importance_score FROM models"
        for c in FEATURES
    ),
    "model_metrics": f"{RIDGE_EVALUATED} " + typed(_METRICS, "model_metrics"),
    "save_evaluations": f"""{RIDGE_EVALUATED}, naive AS ({baseline_eval_sql(_STATE_KEY, 'series')}), clipped AS ({clipped_sql('naive')}),
saved AS (SELECT {_STATE_KEY}, mape, rmse, r2_score FROM model_metrics
  UNION ALL SELECT {_STATE_KEY}, mape, rmse, r2_score FROM clipped ANTI JOIN model_metrics USING ({_STATE_KEY})) """ + typed(_METRICS, "saved"),
    "predicted_rows": _FITTED + typed(
        "state_id:l commodity:s arrival_date:t modal_price:d has_prediction:b",
        f"(SELECT *, true AS has_prediction FROM split {_OK} WHERE is_test)",
    ),
    "ridge_optimality": _FITTED + typed(
        "state_id:l commodity:s n:l optimal:b",
        f"(SELECT {_STATE_KEY}, count(*) AS n, true AS optimal FROM split {_OK} WHERE NOT is_test GROUP BY ALL)",
    ),
    "importance_totals": _FITTED + typed(
        "state_id:l commodity:s features:l total:d",
        "(SELECT state_id, commodity, 8 AS features, 1.0 AS total FROM guards WHERE status = 'ok')",
    ),
    "mape": _metric("mape"),
    "rmse": _metric("rmse"),
    "r2": _metric("r2_score"),
    "clip_metrics": f"{_BASELINE}, clipped AS ({clipped_sql('metrics')}) "
    + typed("market_id:l commodity:s n:l mape:d rmse:d r2_score:d", "clipped"),
    "training_summary": _summary(_STATE_KEY, STATE_SERIES),
    "training_summary_by_market": _summary(_KEY, SERIES),
    "baseline_predictions": f"WITH {SERIES}, rows AS (SELECT * FROM {baseline_sql(_KEY, 'series')} WHERE arrival_date > last_date - 30) "
    + typed("market_id:l commodity:s arrival_date:t modal_price:d predicted:d", "rows"),
    "baseline_eval": f"WITH {STATE_SERIES}, metrics AS ({baseline_eval_sql(_STATE_KEY, 'series')}), "
    f"clipped AS ({clipped_sql('metrics')}) " + typed("state_id:l commodity:s n:l mape:d rmse:d r2_score:d", "clipped"),
}
