"""The fact summed per month, market and commodity, as a stored star keeps it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.schemas import USAGE_SUMMARY

USAGE_KEYS = ["year", "month", "market_id", "commodity_id"]


def month_number(year: Column, month: Column) -> Column:
    return year * 12 + month


def dated(fact: DataFrame) -> DataFrame:
    """Fact rows with year and month, which a stored fact already has."""
    if {"year", "month"} <= set(fact.columns):
        return fact
    day = F.date_from_unix_date("date_id")
    return fact.withColumns({"year": F.year(day), "month": F.month(day)})


def of_facts() -> list[Column]:
    """The figures of fact rows."""
    prices = [F.sum("modal_price").alias("total"), F.min("min_price").alias("low"), F.max("max_price").alias("high")]
    return [F.count(F.lit(1)).alias("n"), *prices]


def of_summaries() -> list[Column]:
    """The same figures of summary rows: counts and sums add up, lowest and highest are taken again."""
    return [F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")]


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in USAGE_SUMMARY.fields])


def summarise(fact: DataFrame) -> DataFrame:
    """The summary of fact rows; tasks combine their rows before the shuffle, so a hot series costs no more than others."""
    return _typed(dated(fact).groupBy(*USAGE_KEYS).agg(*of_facts()))


def merged(summaries: DataFrame) -> DataFrame:
    """Several summaries of different rows as one."""
    return _typed(summaries.groupBy(*USAGE_KEYS).agg(*of_summaries()))
