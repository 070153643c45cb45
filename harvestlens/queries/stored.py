"""Queries on a written star: the fact arrives in two loads, then the days of its last month are built again without market 7."""

from pyspark.sql import functions as F

from harvestlens.constants import PRICE_COLUMNS
from harvestlens.operators import explorer, features, overview
from harvestlens.queries.common import STAR, plain, typed
from harvestlens.queries.explorer import COMPARED
from harvestlens.queries.overview import SQL as OVERVIEW
from harvestlens.schemas import PRICE
from harvestlens.session import scratch_path, write_and_read
from harvestlens.sources.star_store import FACT, StarStore
from harvestlens.sources.summary import summarise
from harvestlens.sources.tables import TradeTables


def written(spark, sf_dir):
    """The store after both loads (even days, then odd ones, so all months grow) and the reload."""
    store, tables = StarStore(spark, scratch_path(spark, "stored")), TradeTables(spark, sf_dir)
    for name in ("state_dim", "market_dim", "commodity_dim", "date_dim"):
        store.append(name, getattr(tables, name))
    fact = write_and_read(tables.fact.withColumns({c: F.col(c).cast(PRICE) for c in PRICE_COLUMNS}), "fact")
    for half in (0, 1):
        store.append_fact(fact.filter(F.col("date_id") % 2 == half))
    tables.fact = fact  # the metrics read the rows written above; their prices already had the stored type
    store.upsert("model_evaluation", tables.model_evaluation.drop("n"), features.KEYS)
    last = F.trunc(fact.select(F.date_from_unix_date(F.max("date_id"))).scalar(), "month")
    again = fact.filter(F.date_from_unix_date("date_id") >= last)
    days = again.select(F.date_from_unix_date("date_id").alias("arrival_date")).distinct()
    folder = max(store.months(FACT), key=lambda m: [int(part.split("=")[1]) for part in m.split("/")])
    store.replace_days(FACT, again.filter("market_id <> 7"), days, [folder])
    return store


def usage_summary(spark, sf_dir):
    """The summary as kept, beside the number of rows that a summary of the stored fact has anew for the key."""
    star = written(spark, sf_dir).star()
    keys = ["year", "month", "market_id", "commodity_id"]
    anew = summarise(star.fact).select(*keys, F.col("n").alias("n_anew"))
    return plain(star.usage.join(anew, keys, "full"))


def star_overview_kpis(spark, sf_dir):
    return plain(overview.overview_kpis(written(spark, sf_dir).star()))


def star_overview_by_state(spark, sf_dir):
    return plain(overview.overview_by_state(written(spark, sf_dir).star()))


def star_series_scan(spark, sf_dir):
    """The newest 90 rows of a name in a market."""
    history = explorer.history_of(written(spark, sf_dir).star(), commodity="PROMO", market_id=3)
    return plain(history.select("date_id", "market_id", "commodity_id", "modal_price", "arrival_date"))


def star_whole_series(spark, sf_dir):
    """All rows of a name's series in three markets, from a store whose months are laid out by series (all but the last)."""
    store = written(spark, sf_dir)
    store.arrange_by_series()
    star = store.star()
    named = star.commodity_dim.filter("commodity = 'PROMO'").select("commodity_id")
    wanted = star.usage.filter(F.col("market_id").between(3, 5)).join(named, "commodity_id", "left_semi").select(*features.KEYS).distinct()
    return plain(features.whole_series(star, wanted))


def star_variety_comparison(spark, sf_dir):
    """All varieties in all markets, from the summary."""
    return plain(explorer.variety_comparison_by_market(written(spark, sf_dir).star()))


QUERIES = {
    f.__name__: f
    for f in (usage_summary, star_overview_kpis, star_overview_by_state, star_series_scan, star_whole_series, star_variety_comparison)
}

_RELOADED = """fact AS (
  SELECT * EXCLUDE (last_day) REPLACE (CAST(min_price AS DECIMAL(12,2)) AS min_price, CAST(max_price AS DECIMAL(12,2)) AS max_price)
  FROM (SELECT *, max(arrival_date) OVER () AS last_day FROM whole_fact)
  WHERE market_id <> 7 OR arrival_date < date_trunc('month', last_day)),
date_dim AS ("""


def _stored(sql: str) -> str:
    """A twin over the fact after the reload; dates and metrics are those of the whole fact, as in the store."""
    head, rest = sql.split("date_dim AS (", 1)
    head = head.replace("fact AS (", "whole_fact AS (", 1)
    rest = rest.replace("FROM fact) WHERE predicted", "FROM whole_fact) WHERE predicted", 1)
    return head + _RELOADED + rest


SQL = {
    "usage_summary": _stored(f"WITH {STAR}, summed AS (SELECT year(arrival_date) AS year, month(arrival_date) AS month, market_id,"
        " commodity_id, count(*) AS n, sum(modal_price) AS total, min(min_price) AS low, max(max_price) AS high, count(*) AS n_anew"
        " FROM fact GROUP BY ALL) "
        + typed("year:l month:l market_id:l commodity_id:l n:l total:d low:d high:d n_anew:l", "summed")),
    "star_overview_kpis": _stored(OVERVIEW["overview_kpis"]),
    "star_overview_by_state": _stored(OVERVIEW["overview_by_state"]),
    "star_series_scan": _stored(f"WITH {STAR} " + typed(
        "date_id:l market_id:l commodity_id:l modal_price:d arrival_date:t",
        "(SELECT * FROM named WHERE commodity = 'PROMO' AND market_id = 3 ORDER BY date_id DESC, commodity_id DESC LIMIT 90)",
    )),
    "star_whole_series": _stored(f"WITH {STAR} " + typed(
        "market_id:l commodity_id:l arrival_date:t month:l modal_price:d",
        "(SELECT *, month(arrival_date) AS month FROM named WHERE commodity = 'PROMO' AND market_id BETWEEN 3 AND 5)",
    )),
    "star_variety_comparison": _stored(f"WITH {STAR}, {COMPARED} " + typed(
        "market_id:l commodity:s variety:s grade:s avg_price:d max_price:d min_price:d", "compared",
    )),
}
