"""Batch forecasts for every series, and documents for the dashboard."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.constants import BUFFER_ROWS, NO_COMMODITY, NO_MODEL, TOO_SHORT
from harvestlens.operators import forecast, models
from harvestlens.operators.features import KEYS, recent_series
from harvestlens.operators.forecast import Predictor
from harvestlens.sources.star_store import Star


def forecast_series(
    series: DataFrame, evaluations: DataFrame, predictor: Predictor | None = None,
    fitted: DataFrame | None = None, keys: list[str] = KEYS, boosted: PipelineModel | None = None,
) -> DataFrame:
    """Banded three-step forecasts of all series: by their models, by the boosted model, or by a plain predictor."""
    buffers = forecast.latest_14(series, keys)
    if boosted is not None:
        steps = forecast.stepwise_forecast(buffers, models.boosted_scorer(boosted), keys)
    else:
        if fitted is not None:
            buffers = buffers.join(fitted.select(*keys, "intercept", "coefficients"), keys)
            predictor = models.linear_prediction
        steps = forecast.recursive_forecast(buffers, predictor, keys)
    return forecast.confidence_band(forecast.metrics_lookup(steps, evaluations, keys))


def forecast_by_name(star: Star, fitted: DataFrame, market_id: int, commodity: str) -> DataFrame:
    """Forecast of one market and name through its best-scored id; empty if there is none."""
    wanted = forecast.model_for_name(star).filter(f"market_id = {int(market_id)}")
    wanted = wanted.filter(wanted.commodity == commodity).select(*KEYS)
    series = recent_series(star, wanted, BUFFER_ROWS)
    return forecast_series(series, star.model_evaluation, fitted=fitted)


def forecast_requests(star: Star, fitted: DataFrame, importances: DataFrame, requests: DataFrame) -> DataFrame:
    """Answers to many forecast requests at once: each a document, or the reason why there is none.

    requests: market_id, commodity_id, commodity; a request without an id goes by name, to the id with the best
    score. Returns the market, the id (NULL if the name is not sold there), the name asked for, `refusal` and `document`, of which
    one is NULL. Repeated requests get one answer. Only the newest months of the series asked for are read.
    """
    asked = requests.select("market_id", "commodity_id", "commodity").distinct()
    by_name = forecast.model_for_name(star).select("market_id", "commodity", F.col("commodity_id").alias("found"))
    found = asked.join(by_name, ["market_id", "commodity"], "left").withColumn(
        "commodity_id", F.coalesce("commodity_id", "found")
    )
    series = recent_series(star, found.select(*KEYS).distinct(), BUFFER_ROWS)
    lengths = forecast.latest_buffer(series).select(*KEYS, "n_rows")
    modelled = fitted.select(*KEYS, F.lit(True).alias("modelled"))
    documents = forecast.forecast_document(
        forecast_series(series, star.model_evaluation, fitted=fitted), importances
    )
    n_rows = F.coalesce("n_rows", F.lit(0))
    text = lambda pattern, *values: F.format_string(pattern.replace("{}", "%s"), *values)
    refusal = (
        F.when(F.col("commodity_id").isNull(), text(NO_COMMODITY, F.col("commodity"), F.col("market_id")))
        .when(F.col("modelled").isNull(), F.lit(NO_MODEL))
        .when(n_rows < BUFFER_ROWS, text(TOO_SHORT, F.lit(BUFFER_ROWS), n_rows))
    )
    return (
        found.join(modelled, KEYS, "left").join(lengths, KEYS, "left").join(documents, KEYS, "left")
        .select(*KEYS, "commodity", refusal.alias("refusal"), "document")
    )
