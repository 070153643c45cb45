"""Time-series features over the rows of each series.

A series is the rows of one key, at most one per day, so its length is bounded by the
calendar and a window over it fits one task whatever share of the raw quotes it came from.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import (
    FEATURES, MIN_FEATURE_ROWS, MIN_SERIES_ROWS, MIN_TEST_ROWS, MIN_TRAIN_ROWS, TEST_DAYS,
)
from harvestlens.functions.dates import weekday_number
from harvestlens.functions.numeric import sample_std
from harvestlens.operators.usage import since_newest
from harvestlens.sources.star_store import Star, within_ids

KEYS = ["market_id", "commodity_id"]
LAGS = (1, 7, 14)


def fact_series(star: Star) -> DataFrame:
    """All series of the fact: keys, date, month, price."""
    return _dated_prices(star.fact)


def _dated_prices(fact: DataFrame) -> DataFrame:
    day = F.date_from_unix_date("date_id")
    return fact.select(*KEYS, day.alias("arrival_date"), F.month(day).alias("month"), "modal_price")


def recent_series(star: Star, wanted: DataFrame, rows: int) -> DataFrame:
    """The wanted series (distinct keys) with at least their newest `rows` rows; earlier months of a stored fact are not opened."""
    asked = None if star.usage is None else star.usage.join(wanted, KEYS, "left_semi")
    return _dated_prices(since_newest(star, asked, rows, KEYS).join(wanted, KEYS, "left_semi"))


def whole_series(star: Star, wanted: DataFrame) -> DataFrame:
    """All rows of the wanted series (distinct keys). The limits on their ids reach the scan: of months laid out by series, only pages with them are read."""
    return _dated_prices(within_ids(star.fact, wanted, *KEYS).join(wanted, KEYS, "left_semi"))


def eligible_series(series: DataFrame, keys: list[str] = KEYS, min_rows: int = MIN_SERIES_ROWS) -> DataFrame:
    counts = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("days"))
    return counts.filter(F.col("days") >= min_rows).orderBy(F.desc("days"), *keys)


def series_extract(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows with their position in the series, oldest first."""
    order = W.partitionBy(*keys).orderBy("arrival_date")
    return series.withColumn("position", F.row_number().over(order))


def add_features(series: DataFrame, keys: list[str] = KEYS, causal: bool = False) -> DataFrame:
    """The eight features and `position`; NULL where a lag or frame is not full.

    Lags and frames count rows, not days. Frames include the row itself; with `causal`
    they end one row earlier, as they do when a forecast is made.
    """
    order = W.partitionBy(*keys).orderBy("arrival_date")
    position = F.row_number().over(order)
    price = F.col("modal_price").cast("decimal(12,2)")
    cents = (price * 100).cast("bigint")
    squared = (price * 100).cast("decimal(12,0)") * (price * 100).cast("decimal(12,0)")
    behind = 1 if causal else 0

    def frame(rows):
        return order.rowsBetween(1 - rows - behind, -behind)

    def when_full(rows, value):
        return F.when(position >= rows + behind, value)

    def mean(rows):
        return F.sum(cents).over(frame(rows)).cast("double") / 100.0 / rows

    total = F.sum(cents).over(frame(7)).cast("decimal(18,0)")
    squares = F.sum(squared).over(frame(7))
    columns = {"position": position}
    columns |= {f"lag_{n}": F.lag(price.cast("double"), n).over(order) for n in LAGS}
    columns |= {
        "roll_mean_7": when_full(7, mean(7)),
        "roll_mean_14": when_full(14, mean(14)),
        "roll_std_7": when_full(7, sample_std(F.lit(7).cast("decimal(1,0)"), total, squares) / 100.0),
        "weekday_num": weekday_number(F.col("arrival_date")),
    }
    return series.withColumns(columns)


def feature_matrix(series: DataFrame, keys: list[str] = KEYS, causal: bool = False) -> DataFrame:
    """Complete feature rows only (all but the first 14 of each series)."""
    return add_features(series, keys, causal).dropna(subset=FEATURES).select(
        *keys, "arrival_date", "modal_price", *FEATURES
    )


def time_split(features: DataFrame, keys: list[str] = KEYS, days: int = TEST_DAYS) -> DataFrame:
    """`is_test`: the last `days` calendar days of each series."""
    last = F.max("arrival_date").over(W.partitionBy(*keys))
    return features.withColumn("is_test", F.col("arrival_date") > F.date_sub(last, days))


def series_guards(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Row counts per series and the first guard it fails ('ok' if none), in one pass."""
    # A row has all features from the 15th on, so its position tells.
    order = W.partitionBy(*keys).orderBy("arrival_date")
    rows = time_split(series.withColumn("position", F.row_number().over(order)), keys)
    complete = F.col("position") > max(LAGS)
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(complete).alias("feature_rows"),
        F.count_if(complete & F.col("is_test")).alias("test_rows"),
        F.count_if(complete & ~F.col("is_test")).alias("train_rows"),
    )
    status = (
        F.when(F.col("rows") < MIN_SERIES_ROWS, "too few rows")
        .when(F.col("feature_rows") < MIN_FEATURE_ROWS, "too few feature rows")
        .when(F.col("test_rows") < MIN_TEST_ROWS, "too few test rows")
        .when(F.col("train_rows") < MIN_TRAIN_ROWS, "too few train rows")
        .otherwise("ok")
    )
    return counts.withColumn("status", status)


def trainable(split: DataFrame, guards: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of the series that pass every guard."""
    return split.join(guards.filter("status = 'ok'").select(*keys), keys, "left_semi")
