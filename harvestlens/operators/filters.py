"""Cascading filter options: states, districts, markets, commodities."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.operators.usage import ids_in_use
from harvestlens.sources.star_store import Star


def list_states(star: Star) -> DataFrame:
    return star.state_dim.select("state_id", "state").orderBy("state")


def list_commodities(star: Star) -> DataFrame:
    return star.commodity_dim.select("commodity").distinct().orderBy("commodity")


def markets_in_state(star: Star, state_id: int) -> DataFrame:
    markets = star.market_dim.filter(F.col("state_id") == state_id)
    return markets.select("market_id", "market").orderBy("market", "market_id")


def districts_in_state(star: Star, state_id: int) -> DataFrame:
    markets = star.market_dim.filter(F.col("state_id") == state_id)
    return markets.select("district").distinct().orderBy("district")


def markets_in_district(star: Star, state_id: int, district: str) -> DataFrame:
    markets = star.market_dim.filter((F.col("state_id") == state_id) & (F.col("district") == district))
    return markets.select("market_id", "market").orderBy("market", "market_id")


def commodities_in_market(star: Star, market_id: int) -> DataFrame:
    """Names with any fact in the market; ids are reduced to distinct ones first."""
    active = ids_in_use(star).filter(F.col("market_id") == market_id).select("commodity_id").distinct()
    names = star.commodity_dim.join(active, "commodity_id", "left_semi")
    return names.select("commodity").distinct().orderBy("commodity")


def commodities_by_market(star: Star) -> DataFrame:
    """commodities_in_market for every market at once."""
    active = ids_in_use(star).select("market_id", "commodity_id").distinct()
    return active.join(star.commodity_dim, "commodity_id").select("market_id", "commodity").distinct()


def filter_options(
    star: Star, state_id: int | None = None, district: str | None = None,
    market_id: int | None = None, all_markets: bool = False,
) -> dict[str, DataFrame]:
    """The next level's options for what is selected so far.

    A state without a district wins over a market; a district without a state is an error
    unless a market decides.
    """
    if state_id is not None and district is None:
        if all_markets:
            return {"markets": markets_in_state(star, state_id)}
        return {"districts": districts_in_state(star, state_id)}
    if market_id is not None:
        return {"commodities": commodities_in_market(star, market_id)}
    if state_id is not None:
        return {"markets": markets_in_district(star, state_id, district)}
    if district is None:
        return {"states": list_states(star), "commodities": list_commodities(star)}
    raise ValueError("a district needs its state")
