"""Overview figures."""

from pyspark.sql import functions as F

from harvestlens.functions import dates
from harvestlens.operators import overview, presentation
from harvestlens.queries.common import PERSISTENCE, STAR, mean, plain, rounded, typed
from harvestlens.sources.tables import TradeTables

STATE = "ASIA"


def star(spark, sf_dir):
    return TradeTables(spark, sf_dir)


def latest_date(spark, sf_dir):
    return plain(overview.latest_date(star(spark, sf_dir)))


def previous_date(spark, sf_dir):
    return plain(overview.previous_date(star(spark, sf_dir)))


def kpi_total_records(spark, sf_dir):
    return overview.kpi_total_records(star(spark, sf_dir))


def kpi_commodity_count(spark, sf_dir):
    return overview.kpi_commodity_count(star(spark, sf_dir), STATE)


def kpi_market_count(spark, sf_dir):
    return overview.kpi_market_count(star(spark, sf_dir), STATE)


def kpi_state_count(spark, sf_dir):
    return overview.kpi_state_count(star(spark, sf_dir))


def kpi_model_count(spark, sf_dir):
    return overview.kpi_model_count(star(spark, sf_dir), STATE)


def kpi_forecast_trust(spark, sf_dir):
    return overview.kpi_forecast_trust(star(spark, sf_dir))


def overview_kpis(spark, sf_dir):
    """All KPIs without a state."""
    return plain(overview.overview_kpis(star(spark, sf_dir)))


def overview_kpis_of_state(spark, sf_dir):
    return plain(overview.overview_kpis(star(spark, sf_dir), STATE))


def latest_avg_price(spark, sf_dir):
    return overview.latest_avg_price(star(spark, sf_dir).last_days(0))


def state_pricing(spark, sf_dir):
    return plain(overview.state_pricing(star(spark, sf_dir).last_days(0)))


def price_trend_14d(spark, sf_dir):
    return plain(overview.price_trend(star(spark, sf_dir).last_days(14)))


def price_trend_of_state(spark, sf_dir):
    return plain(overview.price_trend(star(spark, sf_dir).last_days(14), state=STATE))


def top5_commodities(spark, sf_dir):
    return overview.top_commodities(star(spark, sf_dir).last_days(0))


def price_movers(spark, sf_dir):
    return plain(overview.price_movers(star(spark, sf_dir).since_previous_day()))


def gainers_losers(spark, sf_dir):
    return overview.gainers_losers(star(spark, sf_dir).since_previous_day())


def overview_by_state(spark, sf_dir):
    return plain(overview.overview_by_state(star(spark, sf_dir)))


def trend_by_state(spark, sf_dir):
    """The last days' prices of every state, and of all together (state_id NULL)."""
    return plain(overview.trend_by_state(star(spark, sf_dir).last_days(14)))


def top_by_state(spark, sf_dir):
    return plain(overview.top_by_state(star(spark, sf_dir).last_days(0)))


def top5_of_state(spark, sf_dir):
    return plain(overview.top_commodities(star(spark, sf_dir).last_days(0), state=STATE))


def price_movers_of_state(spark, sf_dir):
    return plain(overview.price_movers(star(spark, sf_dir).since_previous_day(), STATE))


def state_coverage(spark, sf_dir):
    tables = star(spark, sf_dir).last_days(0)
    return plain(presentation.state_coverage(tables, overview.state_pricing(tables)))


def ranked_top5(spark, sf_dir):
    return plain(presentation.ranked_top(overview.top_commodities(star(spark, sf_dir).last_days(0))))


def short_date(spark, sf_dir):
    days = star(spark, sf_dir).date_dim
    return plain(days.select("arrival_date", dates.short_date(F.col("arrival_date")).alias("label")))


def priciest_commodities(spark, sf_dir):
    return overview.priciest_commodities(star(spark, sf_dir))


def monthly_trend(spark, sf_dir):
    return plain(overview.monthly_trend(star(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        latest_date, previous_date, kpi_total_records, kpi_commodity_count, kpi_market_count,
        kpi_state_count, kpi_model_count, kpi_forecast_trust, overview_kpis, overview_kpis_of_state,
        latest_avg_price, state_pricing, price_trend_14d, price_trend_of_state, top5_commodities,
        price_movers, gainers_losers, overview_by_state, trend_by_state, top_by_state,
        top5_of_state, price_movers_of_state, state_coverage, ranked_top5, short_date,
        priciest_commodities, monthly_trend,
    )
}

_PRICE = rounded(mean("modal_price"))
_TWO_DAYS = """
CAST(sum(modal_price) FILTER (WHERE arrival_date = latest_date) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE arrival_date = latest_date), 0) AS price_latest,
CAST(sum(modal_price) FILTER (WHERE arrival_date = previous_date) AS DOUBLE)
  / nullif(count(*) FILTER (WHERE arrival_date = previous_date), 0) AS price_previous"""
_MOVERS = f"""
two AS (SELECT commodity_id, {_TWO_DAYS} FROM fact, latest, previous GROUP BY commodity_id),
movers AS (SELECT *, (price_latest - price_previous) / price_previous * 100 AS pct_change FROM two
  WHERE price_latest IS NOT NULL AND price_previous > 0)"""
_PRICING = f"""
pricing AS (SELECT state_id, state AS state_name, {_PRICE} AS avg_price, count(*) AS record_count
  FROM named, latest WHERE arrival_date = latest_date GROUP BY ALL)"""
_TOP = f"""
top AS (SELECT commodity, {_PRICE} AS avg_price, count(*) AS report_count
  FROM named, latest WHERE arrival_date = latest_date GROUP BY commodity ORDER BY report_count DESC, commodity LIMIT 5)"""
_TRUST = f"coalesce({rounded('100.0 - ' + mean('mape'), 1)}, 92.0)"
_OF_STATE = f"FROM (SELECT * FROM named WHERE state = '{STATE}')"
_SCOPED = "(SELECT * FROM named UNION ALL SELECT * REPLACE (NULL AS state_id) FROM named)"
_EVALUATED = "model_evaluation JOIN market_dim USING (market_id) JOIN state_dim USING (state_id)"


def _trend(source):
    return (
        f"(SELECT arrival_date, {_PRICE} AS price FROM {source}, latest "
        "WHERE arrival_date >= latest_date - 14 GROUP BY arrival_date) ORDER BY arrival_date"
    )


SQL = {
    "latest_date": f"WITH {STAR} " + typed("latest_date:t", "latest"),
    "previous_date": f"WITH {STAR} " + typed("previous_date:t", "previous"),
    "kpi_total_records": f"WITH {STAR} SELECT count(*) AS total_records FROM fact",
    "kpi_commodity_count": f"WITH {STAR} SELECT count(DISTINCT commodity_id) AS total_commodities FROM named WHERE state = '{STATE}'",
    "kpi_market_count": f"WITH {STAR} SELECT count(DISTINCT market_id) AS total_markets FROM named WHERE state = '{STATE}'",
    "kpi_state_count": f"WITH {STAR} SELECT count(*) AS total_states FROM state_dim",
    "kpi_model_count": f"WITH {PERSISTENCE} SELECT count(*) AS total_models FROM {_EVALUATED} WHERE state = '{STATE}'",
    "kpi_forecast_trust": f"WITH {PERSISTENCE} SELECT {_TRUST} AS forecast_trust FROM model_evaluation",
    "overview_kpis": f"""WITH {PERSISTENCE} SELECT
  (SELECT coalesce({_PRICE}, 0.0) FROM fact, latest WHERE arrival_date = latest_date) AS avg_price,
  (SELECT count(*) FROM fact) AS total_records, (SELECT count(*) FROM state_dim) AS total_states,
  (SELECT count(*) FROM market_dim) AS total_markets, (SELECT count(*) FROM commodity_dim) AS total_commodities,
  (SELECT count(*) FROM model_evaluation) AS total_models,
  (SELECT {_TRUST} FROM model_evaluation) AS forecast_trust,
  (SELECT strftime(latest_date, '%Y-%m-%d') FROM latest) AS latest_date""",
    "overview_kpis_of_state": f"""WITH {PERSISTENCE}, one AS (SELECT * FROM named WHERE state = '{STATE}') SELECT
  (SELECT coalesce({_PRICE}, 0.0) FROM one, latest WHERE arrival_date = latest_date) AS avg_price,
  (SELECT count(*) FROM one) AS total_records, CAST(1 AS BIGINT) AS total_states,
  (SELECT count(DISTINCT market_id) FROM one) AS total_markets,
  (SELECT count(DISTINCT commodity_id) FROM one) AS total_commodities,
  (SELECT count(*) FROM {_EVALUATED} WHERE state = '{STATE}') AS total_models,
  (SELECT {_TRUST} FROM {_EVALUATED} WHERE state = '{STATE}') AS forecast_trust,
  (SELECT strftime(latest_date, '%Y-%m-%d') FROM latest) AS latest_date""",
    "latest_avg_price": f"WITH {STAR} SELECT coalesce({_PRICE}, 0.0) AS avg_price FROM fact, latest WHERE arrival_date = latest_date",
    "state_pricing": f"WITH {STAR}, {_PRICING} " + typed("state_id:l state_name:s avg_price:d record_count:l", "pricing"),
    "price_trend_14d": f"WITH {STAR} " + typed("arrival_date:t price:d", _trend("fact")),
    "price_trend_of_state": f"WITH {STAR} "
    + typed("arrival_date:t price:d", _trend(f"(SELECT * FROM named WHERE state = '{STATE}')")),
    "top5_commodities": f"WITH {STAR}, {_TOP} " + typed("commodity:s avg_price:d report_count:l", "top"),
    "price_movers": f"WITH {STAR}, {_MOVERS} "
    + typed("commodity_id:l price_latest:d price_previous:d pct_change:d", "movers"),
    "gainers_losers": f"WITH {STAR}, {_MOVERS} SELECT count(*) FILTER (WHERE pct_change > 0.1) AS gainers,"
    " count(*) FILTER (WHERE pct_change < -0.1) AS losers FROM movers",
    "overview_by_state": f"""WITH {PERSISTENCE},
usage AS (SELECT state_id, count(*) AS total_records, count(DISTINCT commodity_id) AS total_commodities,
    count(DISTINCT market_id) AS total_markets FROM named GROUP BY 1),
prices AS (SELECT state_id, {_PRICE} AS avg_price FROM named, latest WHERE arrival_date = latest_date GROUP BY 1),
two AS (SELECT state_id, commodity_id, {_TWO_DAYS} FROM named, latest, previous GROUP BY ALL),
moves AS (SELECT state_id, (price_latest - price_previous) / price_previous * 100 AS pct FROM two WHERE price_previous > 0),
counts AS (SELECT state_id, count(*) FILTER (WHERE pct > 0.1) AS gainers, count(*) FILTER (WHERE pct < -0.1) AS losers FROM moves GROUP BY 1),
evals AS (SELECT state_id, count(*) AS total_models, {_TRUST} AS forecast_trust FROM model_evaluation JOIN market_dim USING (market_id) GROUP BY 1)
SELECT CAST(state_id AS BIGINT) AS state_id, state, coalesce(avg_price, 0.0) AS avg_price,
  coalesce(total_records, 0) AS total_records, coalesce(total_commodities, 0) AS total_commodities,
  coalesce(total_markets, 0) AS total_markets, coalesce(total_models, 0) AS total_models,
  coalesce(gainers, 0) AS gainers, coalesce(losers, 0) AS losers, coalesce(forecast_trust, 92.0) AS forecast_trust
FROM state_dim LEFT JOIN usage USING (state_id) LEFT JOIN prices USING (state_id)
  LEFT JOIN counts USING (state_id) LEFT JOIN evals USING (state_id)""",
    "trend_by_state": f"WITH {STAR} " + typed(
        "state_id:l arrival_date:t price:d",
        f"(SELECT state_id, arrival_date, {_PRICE} AS price FROM {_SCOPED}, latest"
        " WHERE arrival_date >= latest_date - 14 GROUP BY ALL)",
    ),
    "top_by_state": f"WITH {STAR}, " + f"""
counted AS (SELECT state_id, commodity, {_PRICE} AS avg_price, count(*) AS report_count
  FROM {_SCOPED}, latest WHERE arrival_date = latest_date GROUP BY state_id, commodity),
placed AS (SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY report_count DESC, commodity) AS rank FROM counted)
""" + typed("state_id:l rank:l commodity:s avg_price:d report_count:l", "placed WHERE rank <= 5"),
    "top5_of_state": f"WITH {STAR}, {_TOP.replace('FROM named', _OF_STATE)} " + typed("commodity:s avg_price:d report_count:l", "top"),
    "price_movers_of_state": f"WITH {STAR}, {_MOVERS.replace('FROM fact', _OF_STATE)} "
    + typed("commodity_id:l price_latest:d price_previous:d pct_change:d", "movers"),
    "state_coverage": f"WITH {STAR}, {_PRICING} " + typed(
        "state_id:l state:s avg_price:d record_count:l has_data:b",
        "(SELECT state_id, state, avg_price, record_count, coalesce(record_count > 0, false) AS has_data"
        " FROM state_dim LEFT JOIN pricing USING (state_id))",
    ),
    "ranked_top5": f"WITH {STAR}, {_TOP} " + typed(
        "commodity:s avg_price:d report_count:l rank:l",
        "(SELECT *, row_number() OVER (ORDER BY report_count DESC, commodity) AS rank FROM top)",
    ),
    "short_date": f"WITH {STAR} " + typed(
        "arrival_date:t label:s", "(SELECT arrival_date, strftime(arrival_date, '%b %d') AS label FROM date_dim)"
    ),
    "priciest_commodities": f"WITH {STAR} SELECT commodity, {mean('modal_price')} AS avg_price FROM named"
    " GROUP BY commodity ORDER BY avg_price DESC, commodity LIMIT 10",
    "monthly_trend": f"WITH {STAR} " + typed(
        "commodity:s month_number:l month:s modal_price:d",
        f"(SELECT commodity, month(arrival_date) AS month_number, any_value(strftime(arrival_date, '%b')) AS month,"
        f" {mean('modal_price')} AS modal_price FROM named GROUP BY commodity, month_number)",
    ),
}
