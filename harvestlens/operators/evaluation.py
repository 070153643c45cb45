"""Forecast errors per series."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.constants import METRIC_LIMITS
from harvestlens.functions.numeric import clamp, exact_avg
from harvestlens.operators.features import KEYS, add_features, time_split
from harvestlens.schemas import MODEL_EVALUATION


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over rows with a price; 0 if there are none. Each row's share counts in billionths, so the sum is exact."""
    share = F.abs(F.try_divide((actual - predicted).cast("double"), actual.cast("double")))
    return F.coalesce(exact_avg(share.cast("decimal(28,9)")) * 100, F.lit(0.0))


def rmse(actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return F.sqrt(F.sum(error * error).cast("double") / F.count(error))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - SSres/SStot; 0 for a constant price.

    With decimal prices both sums are exact: n*SStot = n*sum(y^2) - sum(y)^2.
    """
    n = F.count(actual).cast("decimal(10,0)")
    error = actual - predicted
    spread = n * F.sum(actual * actual) - F.sum(actual) * F.sum(actual)
    unexplained = F.count(actual) * F.sum(error * error).cast("double")
    return F.when(spread == 0, 0.0).otherwise(1.0 - F.try_divide(unexplained, spread.cast("double")))


def evaluate(predictions: DataFrame, keys: list[str] = KEYS, actual: str = "modal_price", predicted: str = "predicted") -> DataFrame:
    y, p = F.col(actual), F.col(predicted)
    return predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        mape(y, p).alias("mape"),
        rmse(y, p).alias("rmse"),
        r2(y, p).alias("r2_score"),
    )


def clip_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics within the stored columns' ranges and types."""
    return metrics.withColumns({
        name: clamp(F.col(name), *limits).cast(MODEL_EVALUATION[name].dataType)
        for name, limits in METRIC_LIMITS.items()
    })


def baseline_predictions(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Test rows with the price seven rows earlier as prediction."""
    rows = add_features(series, keys).filter("lag_14 IS NOT NULL")
    return time_split(rows, keys).filter("is_test").select(
        *keys, "arrival_date", "modal_price", F.col("lag_7").cast("decimal(12,2)").alias("predicted")
    )


def baseline_eval(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return evaluate(baseline_predictions(series, keys), keys)


def persistence_eval(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Stored-form metrics of the previous row's price as prediction, over all rows."""
    rows = add_features(series, keys).filter("lag_1 IS NOT NULL").select(
        *keys, "modal_price", F.col("lag_1").cast("decimal(12,2)").alias("predicted")
    )
    return clip_metrics(evaluate(rows, keys)).drop("n")
