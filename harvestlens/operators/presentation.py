"""Tables a dashboard derives from the query results."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import CONFIDENCE_Z, DEFAULT_METRICS, FEATURE_LABELS, HORIZON
from harvestlens.operators.features import KEYS
from harvestlens.operators.forecast import feature_drivers
from harvestlens.sources.star_store import Star

ACTUAL_ROWS = 4
TOP_DRIVERS = 4
MIN_CONFIDENCE = 70


def whole(value: Column) -> Column:
    """Round to a whole number, halves up, as a browser's Math.round does."""
    return F.floor(value + 0.5)


def forecast_chart_rows(series: DataFrame, banded: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The last four actual prices and the forecast steps as one labelled table per series."""
    newest = W.partitionBy(*keys).orderBy(F.desc("arrival_date"))
    age = F.row_number().over(newest) - 1
    price = F.col("modal_price").cast("double")
    label = F.when(F.col("age") == 0, "Today").otherwise(F.concat(F.lit("Day -"), F.col("age").cast("string")))
    actual = (
        series.withColumn("age", age)
        .filter(F.col("age") < ACTUAL_ROWS)
        .join(banded.select(*keys).distinct(), keys, "left_semi")
        .select(
            *keys, (-F.col("age")).alias("day_offset"), label.alias("name"), price.alias("actual"),
            price.alias("forecast"), price.alias("lower"), price.alias("upper"),
        )
    )
    ahead = banded.select(
        *keys,
        F.col("step").alias("day_offset"),
        F.concat(F.lit("Day +"), F.col("step").cast("string")).alias("name"),
        F.lit(None).cast("double").alias("actual"),
        F.col("predicted").alias("forecast"), "lower", "upper",
    )
    return actual.unionByName(ahead)


def top4_drivers(importances: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """The four strongest features with label and whole per cent."""
    labels = F.create_map(*[F.lit(text) for pair in FEATURE_LABELS.items() for text in pair])
    drivers = feature_drivers(importances, keys).filter(F.col("rank") <= TOP_DRIVERS)
    return drivers.select(
        *keys, "rank",
        F.coalesce(F.try_element_at(labels, F.col("feature")), F.col("feature")).alias("label"),
        whole(F.col("importance") * 100).alias("percentage"),
    )


def confidence_display(evaluations: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Shown confidence, at least 70, next to the R2 it hides."""
    score = F.col("r2_score").cast("double")
    shown = F.when(score.isNull() | (score == 0), DEFAULT_METRICS["r2_score"]).otherwise(score)
    return evaluations.select(
        *keys, F.greatest(F.lit(MIN_CONFIDENCE).cast("bigint"), whole(shown * 100)).alias("confidence"), "r2_score"
    )


def forecast_range(banded: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Lower bound of the first step, upper bound of the last, and the one-step spread."""
    at = lambda step, c: F.max(F.when(F.col("step") == step, F.col(c)))
    return banded.groupBy(*keys).agg(
        at(1, "lower").alias("forecast_min"),
        at(HORIZON, "upper").alias("forecast_max"),
        (F.max("rmse") * CONFIDENCE_Z).alias("spread"),
    )


def state_coverage(star: Star, pricing: DataFrame) -> DataFrame:
    """Every state with whether it has prices."""
    priced = pricing.select("state_id", "avg_price", "record_count")
    joined = star.state_dim.join(priced, "state_id", "left")
    return joined.withColumn("has_data", F.coalesce(F.col("record_count") > 0, F.lit(False)))


def ranked_top(top: DataFrame) -> DataFrame:
    """1-based ranks for a top-k table (k rows, so one window over all of them)."""
    order = W.partitionBy(F.lit(0)).orderBy(F.desc("report_count"), "commodity")
    return top.withColumn("rank", F.row_number().over(order))


def resolve_states(names: DataFrame, star: Star) -> DataFrame:
    """state -> state_id for a frame of state names."""
    return names.join(star.state_dim, "state")


def resolve_markets(names: DataFrame, star: Star) -> DataFrame:
    """(state_id, district, market) -> market_id; a market's name is unique only within those."""
    return names.join(star.market_dim, ["state_id", "district", "market"])
