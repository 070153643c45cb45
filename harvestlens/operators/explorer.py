"""Price explorer: newest rows, price velocity, the made-up volume, variety comparison."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import (
    ELASTICITY, FACTOR_RANGE, HISTORY_ROWS, PRICE_COLUMNS, VOLUME_PER_PRICE,
)
from harvestlens.functions.numeric import clamp, ratio_of, round_half_even
from harvestlens.operators.usage import figures, since_newest
from harvestlens.sources.star_store import Star

ROW_ORDER = ["date_id", "market_id", "commodity_id"]


def all_of(selected: dict[str, object]) -> Column:
    """The conjunction of column = value for the values that are given; none means all rows."""
    tests = [F.col(c) == value for c, value in selected.items() if value is not None]
    return reduce(Column.__and__, tests, F.lit(True))


def dynamic_filter(
    star: Star, commodity: str | None = None, state_id: int | None = None,
    district: str | None = None, market_id: int | None = None,
) -> DataFrame:
    """Fact rows of any selection. A dimension is joined only if something of it is selected."""
    return _fact_rows(_selected(_fact_rows(star.fact), star, commodity, state_id, district, market_id))


def _fact_rows(fact: DataFrame) -> DataFrame:
    return fact.select(*ROW_ORDER, *PRICE_COLUMNS)


def _selected(
    rows: DataFrame, star: Star, commodity: str | None = None, state_id: int | None = None,
    district: str | None = None, market_id: int | None = None,
) -> DataFrame:
    """Rows with market_id and commodity_id, of the fact or its summary, that belong to a selection."""
    found = rows.filter(all_of({"market_id": market_id}))
    if state_id is not None or district:
        place = all_of({"state_id": state_id, "district": district or None})
        found = found.join(star.market_dim.filter(place).select("market_id"), "market_id", "left_semi")
    if commodity:
        named = star.commodity_dim.filter(F.col("commodity") == commodity).select("commodity_id")
        found = found.join(named, "commodity_id", "left_semi")
    return found


def history_of(star: Star, rows: int = HISTORY_ROWS, **selection) -> DataFrame:
    """price_history of a selection (as in dynamic_filter); on a stored star only months that hold these rows are opened."""
    summary = None if star.usage is None else _selected(star.usage, star, **selection)
    recent = _selected(_fact_rows(since_newest(star, summary, rows, [])), star, **selection)
    return price_history(_fact_rows(recent), rows)


def price_history(selection: DataFrame, rows: int = HISTORY_ROWS) -> DataFrame:
    """The newest `rows` rows (not days) of a selection, oldest first."""
    newest = selection.orderBy(*[F.desc(c) for c in ROW_ORDER]).limit(rows)
    return newest.withColumn("arrival_date", F.date_from_unix_date("date_id")).orderBy(*ROW_ORDER)


def price_history_by(rows: DataFrame, keys: list[str], limit: int = HISTORY_ROWS) -> DataFrame:
    """price_history of every key at once. Spark cuts to `limit` rows before the shuffle too."""
    newest = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in ROW_ORDER])
    return (
        rows.withColumn("newness", F.row_number().over(newest))
        .filter(F.col("newness") <= limit)
        .drop("newness")
        .withColumn("arrival_date", F.date_from_unix_date("date_id"))
    )


def price_velocity(history: DataFrame, keys: list[str]) -> DataFrame:
    """Relative change to the row before; 0 for a key's first row or after a price of 0.

    `history` holds at most `limit` rows per key (one key: a constant), so each window is
    short.
    """
    order = W.partitionBy(*(keys or [F.lit(0)])).orderBy(*ROW_ORDER)
    price = F.col("modal_price").cast("double")
    before = F.lag(price).over(order)
    change = F.when(before > 0, (price - before) / before).otherwise(0.0)
    return history.withColumn("velocity", change)


def elasticity_factor(velocity: Column) -> Column:
    return clamp(1.0 - velocity * ELASTICITY, *FACTOR_RANGE)


def synthetic_volume(velocity: Column) -> Column:
    """An invented arrival volume: price-driven base, elasticity, and 0-4.9 by the date."""
    base = F.col("modal_price").cast("double") * VOLUME_PER_PRICE / 10.0
    daily = F.pmod(F.col("date_id") * 17, F.lit(50)) / 10.0
    return round_half_even(base * elasticity_factor(velocity) + daily, 2)


def with_volume(history: DataFrame, keys: list[str]) -> DataFrame:
    moved = price_velocity(history, keys)
    return moved.withColumns({
        "elasticity_factor": elasticity_factor(F.col("velocity")),
        "synthetic_volume": synthetic_volume(F.col("velocity")),
    })


def compared(star: Star) -> DataFrame:
    """Unrounded averages, highest and lowest prices per market and commodity id."""
    by_id = figures(star, "market_id", "commodity_id").select(
        "market_id", "commodity_id", ratio_of(F.col("total"), F.col("n")).alias("average"),
        F.col("high").alias("max_price"), F.col("low").alias("min_price"),
    )
    return by_id.join(star.commodity_dim, "commodity_id")


def _comparison_columns() -> list:
    average = round_half_even(F.col("average"), 2).alias("avg_price")
    return ["variety", "grade", average, "max_price", "min_price"]


def variety_comparison_by_market(star: Star) -> DataFrame:
    """Average, highest and lowest price per market, name, variety and grade."""
    return compared(star).select("market_id", "commodity", *_comparison_columns())


def variety_comparison(star: Star, market_id: int, commodity: str) -> DataFrame:
    """The comparison of one market and name, dearest first."""
    one = compared(star).filter((F.col("market_id") == market_id) & (F.col("commodity") == commodity))
    return one.orderBy(F.desc("average"), "variety", "grade").select(*_comparison_columns())


def grade_class(grade: Column) -> Column:
    return F.when(grade == "Premium", "premium").otherwise("regular")
