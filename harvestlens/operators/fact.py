"""Fact building, its checks, and the denormalised view."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.constants import PRICE_COLUMNS
from harvestlens.schemas import PRICE
from harvestlens.sources.star_store import Star

FACT_KEYS = ["date_id", "market_id", "commodity_id"]
FOREIGN_KEYS = ["state_id", "commodity_id", "market_id", "date_id"]


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """`columns` of the first row of each key by `order`.

    A minimum over structs, so every task sends at most one row per key to the shuffle:
    a key that holds a third of all rows costs no more than any other. Such a minimum sorts the rows of
    every task; the key's hash goes first, as it tells most keys apart without a look into the rows. What the order
    has behind the last of `columns` cannot change them and is left out.
    """
    ranked = [*order, *[c for c in columns if c not in order]]
    while ranked[-1] not in columns:
        ranked.pop()
    first = rows.groupBy(F.xxhash64(*keys).alias("key_hash"), *keys).agg(F.min(F.struct(*ranked)).alias("first"))
    return first.select(*keys, *[F.col(f"first.{c}").alias(c) for c in columns])


def build_fact(quotes: DataFrame, order: list[str]) -> DataFrame:
    """Quotes with all ids -> the first row by `order` per (date, market, commodity); rows with NULL drop out."""
    complete = quotes.select(*dict.fromkeys([*FACT_KEYS, *PRICE_COLUMNS, *order])).dropna(
        subset=[*FACT_KEYS, *PRICE_COLUMNS]
    )
    first = first_per_key(complete, FACT_KEYS, order, PRICE_COLUMNS)
    return first.withColumns({c: F.col(c).cast(PRICE) for c in PRICE_COLUMNS})


def null_fk_audit(quotes: DataFrame) -> DataFrame:
    """(column, missing): NULLs per foreign key."""
    counts = quotes.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FOREIGN_KEYS])
    return counts.unpivot([], FOREIGN_KEYS, "column", "missing")


def load_report(fact: DataFrame) -> DataFrame:
    """Rows inserted per day."""
    return fact.groupBy(F.date_from_unix_date("date_id").alias("arrival_date")).agg(
        F.count(F.lit(1)).alias("inserted")
    )


def denormalised_view(star: Star) -> DataFrame:
    """Fact joined to all four dimensions. Spark broadcasts those it finds small."""
    return (
        star.fact.select(*FACT_KEYS, *PRICE_COLUMNS)
        .join(star.date_dim, "date_id")
        .join(star.market_dim, "market_id")
        .join(star.state_dim, "state_id")
        .join(star.commodity_dim, "commodity_id")
    )
