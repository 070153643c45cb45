"""Cascading filter options."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.operators import filters, presentation
from harvestlens.queries.common import STAR, plain, typed
from harvestlens.sources.tables import TradeTables


def star(spark, sf_dir):
    return TradeTables(spark, sf_dir)


def list_states(spark, sf_dir):
    return plain(filters.list_states(star(spark, sf_dir)))


def list_commodities(spark, sf_dir):
    return filters.list_commodities(star(spark, sf_dir))


def markets_in_state(spark, sf_dir):
    return plain(filters.markets_in_state(star(spark, sf_dir), 2))


def districts_in_state(spark, sf_dir):
    return filters.districts_in_state(star(spark, sf_dir), 2)


def markets_in_district(spark, sf_dir):
    return plain(filters.markets_in_district(star(spark, sf_dir), 2, "ASIA-1"))


def commodities_in_market(spark, sf_dir):
    return filters.commodities_in_market(star(spark, sf_dir), 7)


def commodities_by_market(spark, sf_dir):
    return plain(filters.commodities_by_market(star(spark, sf_dir)))


def filter_dispatch(spark, sf_dir):
    """The options of every branch, labelled by selection and level."""
    selections = {
        "none": {},
        "state": {"state_id": 1},
        "state, all markets": {"state_id": 1, "all_markets": True},
        "state and market": {"state_id": 1, "market_id": 3},
        "state and district": {"state_id": 1, "district": "AMERICA-0"},
        "market": {"market_id": 3},
    }
    tables = star(spark, sf_dir)
    rows = [
        options.select(
            F.lit(label).alias("selection"), F.lit(level).alias("level"),
            F.concat_ws(":", *[F.col(c).cast("string") for c in options.columns]).alias("option"),
        )
        for label, selection in selections.items()
        for level, options in filters.filter_options(tables, **selection).items()
    ]
    return reduce(DataFrame.unionByName, rows)


def resolve_id(spark, sf_dir):
    """Ids of all markets by the names of state, district and market."""
    tables = TradeTables(spark, sf_dir)
    names = tables.market_dim.join(tables.state_dim, "state_id").select("state", "district", "market")
    with_state = presentation.resolve_states(names, tables)
    return plain(presentation.resolve_markets(with_state, tables))


QUERIES = {
    f.__name__: f
    for f in (
        list_states, list_commodities, markets_in_state, districts_in_state, markets_in_district,
        commodities_in_market, commodities_by_market, filter_dispatch, resolve_id,
    )
}

SQL = {
    "list_states": f"WITH {STAR} " + typed("state_id:l state:s", "state_dim ORDER BY state"),
    "list_commodities": f"WITH {STAR} SELECT DISTINCT commodity FROM commodity_dim ORDER BY commodity",
    "markets_in_state": f"WITH {STAR} " + typed("market_id:l market:s", "market_dim WHERE state_id = 2 ORDER BY market"),
    "districts_in_state": f"WITH {STAR} SELECT DISTINCT district FROM market_dim WHERE state_id = 2 ORDER BY district",
    "markets_in_district": f"WITH {STAR} "
    + typed("market_id:l market:s", "market_dim WHERE state_id = 2 AND district = 'ASIA-1' ORDER BY market"),
    "commodities_in_market": f"WITH {STAR} SELECT DISTINCT commodity FROM named WHERE market_id = 7 ORDER BY commodity",
    "commodities_by_market": f"WITH {STAR} " + typed("market_id:l commodity:s", "(SELECT DISTINCT market_id, commodity FROM named)"),
    "filter_dispatch": f"""WITH {STAR}
SELECT 'none' AS selection, 'states' AS level, state_id || ':' || state AS option FROM state_dim
UNION ALL SELECT DISTINCT 'none', 'commodities', commodity FROM commodity_dim
UNION ALL SELECT DISTINCT 'state', 'districts', district FROM market_dim WHERE state_id = 1
UNION ALL SELECT 'state, all markets', 'markets', market_id || ':' || market FROM market_dim WHERE state_id = 1
UNION ALL SELECT DISTINCT 'state and market', 'districts', district FROM market_dim WHERE state_id = 1
UNION ALL SELECT 'state and district', 'markets', market_id || ':' || market FROM market_dim
  WHERE state_id = 1 AND district = 'AMERICA-0'
UNION ALL SELECT DISTINCT 'market', 'commodities', commodity FROM named WHERE market_id = 3""",
    "resolve_id": f"WITH {STAR} " + typed(
        "state_id:l state:s district:s market:s market_id:l", "market_dim JOIN state_dim USING (state_id)"
    ),
}
