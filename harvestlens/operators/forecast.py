"""Recursive forecasts, their bands and the hold/sell decision, for all series in one plan."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import (
    BUFFER_ROWS, CONFIDENCE_Z, DEFAULT_METRICS, HORIZON, RECOMMENDATION_PCT, RECOMMENDATIONS,
)
from harvestlens.functions.dates import weekday_number
from harvestlens.functions.numeric import round_half_even
from harvestlens.operators.features import KEYS
from harvestlens.sources.star_store import Star

Predictor = Callable[[dict[str, Column]], Column]
Scorer = Callable[[DataFrame, dict[str, Column]], DataFrame]


def model_for_name(star: Star) -> DataFrame:
    """(market_id, commodity) -> the commodity_id to forecast.

    The id with the best R2; without any evaluation the lowest id. A left join serves
    both, as ids without an R2 sort last.
    """
    sold = star.fact.select(*KEYS).distinct()
    scores = star.model_evaluation.select(*KEYS, "r2_score")
    candidates = sold.join(star.commodity_dim.select("commodity_id", "commodity"), "commodity_id").join(
        scores, KEYS, "left"
    )
    best = W.partitionBy("market_id", "commodity").orderBy(F.desc_nulls_last("r2_score"), "commodity_id")
    return (
        candidates.withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .select("market_id", "commodity", "commodity_id", "r2_score")
    )


def metrics_lookup(series: DataFrame, evaluations: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Metrics of each series, or the defaults for one without any."""
    names = list(DEFAULT_METRICS)
    found = evaluations.select(*keys, *names, F.lit(True).alias("found"))
    joined = series.join(found, keys, "left")
    return joined.withColumns({
        name: F.when(F.col("found"), F.col(name).cast("double")).otherwise(F.lit(default))
        for name, default in DEFAULT_METRICS.items()
    }).drop("found")


def feature_drivers(importances: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Importances per model, strongest first, as (rank, feature, importance)."""
    strongest = W.partitionBy(*keys).orderBy(F.desc("importance_score"), "feature_name")
    return importances.select(
        *keys,
        F.row_number().over(strongest).alias("rank"),
        F.col("feature_name").alias("feature"),
        round_half_even(F.col("importance_score").cast("double"), 4).alias("importance"),
    )


def latest_buffer(series: DataFrame, keys: list[str] = KEYS, rows: int = BUFFER_ROWS) -> DataFrame:
    """The newest rows of each series as one array, oldest first; shorter ones included.

    Spark keeps at most `rows` rows per series before the shuffle already.
    """
    newest = W.partitionBy(*keys).orderBy(F.desc("arrival_date"))
    kept = series.withColumn("newness", F.row_number().over(newest)).filter(F.col("newness") <= rows)
    price = F.col("modal_price").cast("double").alias("price")
    points = F.sort_array(F.collect_list(F.struct("arrival_date", price)))
    buffers = kept.groupBy(*keys).agg(points.alias("points"))
    return buffers.select(
        *keys,
        F.size("points").alias("n_rows"),
        F.element_at("points", -1).arrival_date.alias("last_date"),
        F.element_at("points", -1).price.alias("last_price"),
        F.col("points.price").alias("prices"),
    )


def latest_14(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Buffers of the series with enough rows."""
    return latest_buffer(series, keys).filter(F.col("n_rows") == BUFFER_ROWS)


def too_short(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Series a forecast is refused for, with the reason."""
    need = F.concat(F.lit(f"Need {BUFFER_ROWS} days, found "), F.col("n_rows").cast("string"))
    return latest_buffer(series, keys).filter(F.col("n_rows") < BUFFER_ROWS).select(
        *keys, "n_rows", need.alias("reason")
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def step_features(prices: Column, day: Column) -> dict[str, Column]:
    """The features of `day` from the 14 prices before it."""
    week = F.slice(prices, BUFFER_ROWS - 6, 7)
    mean = _total(week) / 7.0
    off = F.transform(week, lambda x: (x - mean) * (x - mean))
    return {
        "lag_1": F.element_at(prices, -1),
        "lag_7": F.element_at(prices, -7),
        "lag_14": F.element_at(prices, -14),
        "roll_mean_7": mean,
        "roll_mean_14": _total(prices) / 14.0,
        "roll_std_7": F.sqrt(_total(off) / 6.0),
        "weekday_num": weekday_number(day),
        "month": F.month(day),
    }


def recursive_forecast(
    buffers: DataFrame, predictor: Predictor, keys: list[str] = KEYS, horizon: int = HORIZON
) -> DataFrame:
    """(keys, last_date, last_price, step, date, predicted) for steps 1..horizon.

    Each step is one projection over all series: predict the next day from the buffer,
    then push the prediction into it. `predictor` maps feature columns to a price column
    and may use any other column of `buffers`.
    """
    return stepwise_forecast(buffers, lambda rows, values: rows.withColumn("raw", predictor(values)), keys, horizon)


def stepwise_forecast(
    buffers: DataFrame, scorer: Scorer, keys: list[str] = KEYS, horizon: int = HORIZON
) -> DataFrame:
    """recursive_forecast with a predictor over frames: it adds the price `raw` to the rows."""
    rows = buffers
    for step in range(1, horizon + 1):
        values = step_features(F.col("prices"), F.date_add("last_date", step))
        price = F.greatest(F.lit(0.0), round_half_even(F.col("raw"), 2))
        rows = scorer(rows, values).withColumn(f"step_{step}", price).drop("raw")
        pushed = F.concat(F.slice("prices", 2, BUFFER_ROWS - 1), F.array(f"step_{step}"))
        rows = rows.withColumn("prices", pushed)
    steps = F.array(*[
        F.struct(
            F.lit(step).alias("step"),
            F.date_add("last_date", step).alias("date"),
            F.col(f"step_{step}").alias("predicted"),
        )
        for step in range(1, horizon + 1)
    ])
    return rows.select(*keys, "last_date", "last_price", F.explode(steps).alias("at")).select(
        *keys, "last_date", "last_price", "at.*"
    )


def mean_of_week(features: dict[str, Column]) -> Column:
    """The naive predictor: the mean of the last seven prices."""
    return features["roll_mean_7"]


def confidence_band(forecast: DataFrame) -> DataFrame:
    """lower and upper: predicted -+ 1.96 * rmse * sqrt(step), the lower at least 0."""
    reach = F.lit(CONFIDENCE_Z) * F.col("rmse") * F.sqrt(F.col("step").cast("double"))
    return forecast.withColumns({
        "lower": F.greatest(F.lit(0.0), round_half_even(F.col("predicted") - reach, 2)),
        "upper": round_half_even(F.col("predicted") + reach, 2),
    })


def recommendation(forecast: DataFrame, keys: list[str] = KEYS, horizon: int = HORIZON) -> DataFrame:
    """The decision per series from the last step's change to the last actual price."""
    final = forecast.filter(F.col("step") == horizon)
    actual = F.col("last_price")
    change = F.when(
        actual > 0, round_half_even((F.col("predicted") - actual) / actual * 100, 2)
    ).otherwise(0.0)
    pct = F.col("pct_change")
    action = F.when(pct > RECOMMENDATION_PCT, "HOLD").when(pct < -RECOMMENDATION_PCT, "SELL").otherwise("STABLE")
    texts = F.create_map(*[
        part
        for name, (description, kind) in RECOMMENDATIONS.items()
        for part in (F.lit(name), F.struct(F.lit(description).alias("description"), F.lit(kind).alias("trend_class")))
    ])
    return (
        final.select(*keys, "last_date", "last_price", change.alias("pct_change"))
        .withColumn("action", action)
        .withColumn("text", F.element_at(texts, F.col("action")))
        .select(*keys, "last_date", "last_price", "pct_change", "action", "text.*")
    )


def forecast_document(
    banded: DataFrame, importances: DataFrame, keys: list[str] = KEYS
) -> DataFrame:
    """One JSON document per series: last price, forecast, metrics, drivers, decision."""
    point = F.struct(
        "step",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("predicted").alias("predicted_modal_price"),
        F.col("lower").alias("lower_bound"),
        F.col("upper").alias("upper_bound"),
    )
    forecasts = banded.groupBy(*keys).agg(
        F.sort_array(F.collect_list(point)).alias("forecast"),  # one per step
        *[F.first(c).alias(c) for c in DEFAULT_METRICS],
    )
    drivers = feature_drivers(importances, keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("rank", "feature", "importance"))).alias("drivers")  # one per feature
    )
    decided = recommendation(banded, keys)
    document = F.struct(
        *keys,
        F.struct(
            F.date_format("last_date", "yyyy-MM-dd").alias("date"), F.col("last_price").alias("price")
        ).alias("latest_actual"),
        F.transform("forecast", lambda f: f.dropFields("step")).alias("forecast"),
        F.struct(*DEFAULT_METRICS).alias("metrics"),
        F.coalesce(
            F.transform("drivers", lambda d: d.dropFields("rank")),
            F.array().cast("array<struct<feature:string,importance:double>>"),
        ).alias("featureDrivers"),
        F.struct(
            "action", "description", "pct_change", F.col("trend_class").alias("class")
        ).alias("recommendation"),
    )
    return (
        decided.join(forecasts, keys).join(drivers, keys, "left")
        .select(*keys, F.to_json(document).alias("document"))
    )


