"""Price explorer."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestlens.operators import explorer
from harvestlens.plans import documents
from harvestlens.queries.common import STAR, mean, plain, rounded, typed
from harvestlens.sources.tables import TradeTables

KEYS = ["market_id", "commodity"]


def star(spark, sf_dir):
    return TradeTables(spark, sf_dir)


def named_fact(spark, sf_dir):
    tables = star(spark, sf_dir)
    return tables.fact.join(tables.commodity_dim.select("commodity_id", "commodity"), "commodity_id")


def dynamic_filter(spark, sf_dir):
    return plain(explorer.dynamic_filter(star(spark, sf_dir), commodity="PROMO", state_id=2, district="ASIA-1"))


def price_history_90(spark, sf_dir):
    selection = explorer.dynamic_filter(star(spark, sf_dir), commodity="PROMO", state_id=2)
    return plain(explorer.price_history(selection))


def price_history_by_series(spark, sf_dir):
    return plain(explorer.price_history_by(named_fact(spark, sf_dir), KEYS))


def price_velocity(spark, sf_dir):
    """The newest 90 rows of a selection with velocity, factor and volume."""
    selection = explorer.dynamic_filter(star(spark, sf_dir), commodity="PROMO", state_id=2)
    return plain(explorer.with_volume(explorer.price_history(selection), []))


def volume_by_series(with_columns):
    def query(spark, sf_dir):
        history = explorer.price_history_by(named_fact(spark, sf_dir), KEYS)
        moved = explorer.with_volume(history, KEYS)
        return plain(moved.select(*KEYS, "date_id", "commodity_id", *with_columns))

    return query


def variety_comparison(spark, sf_dir):
    return plain(explorer.variety_comparison(star(spark, sf_dir), 7, "PROMO"))


def variety_comparison_by_market(spark, sf_dir):
    return plain(explorer.variety_comparison_by_market(star(spark, sf_dir)))


def explorer_document(spark, sf_dir):
    return plain(documents.explorer_documents(star(spark, sf_dir)))


SELECTIONS = {
    "all": {},
    "name in a state": {"commodity": "PROMO", "state_id": 2},
    "name in a market": {"commodity": "PROMO", "market_id": 7},
    "district": {"district": "ASIA-1"},
    "nothing": {"commodity": "PROMO", "state_id": 99},
}


def explorer_document_of_selection(spark, sf_dir):
    """One document per selection; only a name in a market has a comparison."""
    tables = star(spark, sf_dir)
    parts = [
        documents.explorer_document(tables, **selected).select(F.lit(label).alias("selection"), "document")
        for label, selected in SELECTIONS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def grade_class(spark, sf_dir):
    grades = star(spark, sf_dir).commodity_dim
    return plain(grades.select("commodity_id", "grade", explorer.grade_class(F.col("grade")).alias("grade_class")))


QUERIES = {
    "dynamic_filter": dynamic_filter,
    "price_history_90": price_history_90,
    "price_history_by_series": price_history_by_series,
    "price_velocity": price_velocity,
    "elasticity_factor": volume_by_series(["velocity", "elasticity_factor"]),
    "synthetic_volume": volume_by_series(["modal_price", "synthetic_volume"]),
    "variety_comparison": variety_comparison,
    "variety_comparison_by_market": variety_comparison_by_market,
    "explorer_document": explorer_document,
    "explorer_document_of_selection": explorer_document_of_selection,
    "grade_class": grade_class,
}


def _moved(keys, source):
    """Velocity, factor and volume over the newest 90 rows per key."""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
newest AS (SELECT * FROM (SELECT *, row_number() OVER ({part}ORDER BY date_id DESC, market_id DESC, commodity_id DESC) AS newness
  FROM {source}) WHERE newness <= 90),
priced_rows AS (SELECT *, CAST(modal_price AS DOUBLE) AS price,
  lag(CAST(modal_price AS DOUBLE)) OVER ({part}ORDER BY date_id, market_id, commodity_id) AS before FROM newest),
velocities AS (SELECT *, CASE WHEN before > 0 THEN (price - before) / before ELSE 0 END AS velocity FROM priced_rows),
factors AS (SELECT *, greatest(CAST(0.4 AS DOUBLE), least(CAST(2.2 AS DOUBLE),
  CAST(1 AS DOUBLE) - velocity * CAST(3.5 AS DOUBLE))) AS elasticity_factor FROM velocities),
moved AS (SELECT *, {rounded("price * CAST(1.2 AS DOUBLE) / CAST(10 AS DOUBLE) * elasticity_factor"
                             " + CAST((date_id * 17) % 50 AS DOUBLE) / CAST(10 AS DOUBLE)")} AS synthetic_volume FROM factors)"""


_SELECTION = "(SELECT * FROM named WHERE commodity = 'PROMO' AND state_id = 2)"
_ROWS = "date_id:l market_id:l commodity_id:l min_price:d max_price:d modal_price:d"
COMPARED = f"""
compared AS (SELECT market_id, commodity, variety, grade, {mean('modal_price')} AS average,
  {rounded(mean('modal_price'))} AS avg_price, max(max_price) AS max_price, min(min_price) AS min_price
  FROM named GROUP BY market_id, commodity, variety, grade)"""

_SELECTED = {
    "all": "true",
    "name in a state": "commodity = 'PROMO' AND state_id = 2",
    "name in a market": "commodity = 'PROMO' AND market_id = 7",
    "district": "district = 'ASIA-1'",
    "nothing": "false",
}
_SELECTIONS = "(" + " UNION ALL ".join(
    f"SELECT '{label}' AS selection, named.* FROM named WHERE {test}" for label, test in _SELECTED.items()
) + ")"

SQL = {
    "dynamic_filter": f"WITH {STAR} "
    + typed(_ROWS, "named WHERE commodity = 'PROMO' AND state_id = 2 AND district = 'ASIA-1'"),
    "price_history_90": f"WITH {STAR}, {_moved('', _SELECTION)} " + typed(_ROWS + " arrival_date:t", "newest"),
    "price_history_by_series": f"WITH {STAR}, {_moved('market_id, commodity', 'named')} "
    + typed(_ROWS + " commodity:s arrival_date:t", "newest"),
    "price_velocity": f"WITH {STAR}, {_moved('', _SELECTION)} "
    + typed(_ROWS + " arrival_date:t velocity:d elasticity_factor:d synthetic_volume:d", "moved"),
    "elasticity_factor": f"WITH {STAR}, {_moved('market_id, commodity', 'named')} "
    + typed("market_id:l commodity:s date_id:l commodity_id:l velocity:d elasticity_factor:d", "moved"),
    "synthetic_volume": f"WITH {STAR}, {_moved('market_id, commodity', 'named')} "
    + typed("market_id:l commodity:s date_id:l commodity_id:l modal_price:d synthetic_volume:d", "moved"),
    "variety_comparison": f"WITH {STAR}, {COMPARED} " + typed(
        "variety:s grade:s avg_price:d max_price:d min_price:d",
        "(SELECT * FROM compared WHERE market_id = 7 AND commodity = 'PROMO' ORDER BY average DESC, variety, grade)",
    ),
    "variety_comparison_by_market": f"WITH {STAR}, {COMPARED} "
    + typed("market_id:l commodity:s variety:s grade:s avg_price:d max_price:d min_price:d", "compared"),
    "explorer_document": f"""WITH {STAR}, {_moved('market_id, commodity', 'named')}, {COMPARED},
histories AS (SELECT market_id, commodity, list({{'date': strftime(arrival_date, '%Y-%m-%d'),
    'min_price': {rounded('CAST(min_price AS DOUBLE)')}, 'max_price': {rounded('CAST(max_price AS DOUBLE)')},
    'modal_price': price, 'arrival_volume': synthetic_volume}} ORDER BY date_id, commodity_id) AS history
  FROM moved GROUP BY ALL),
varieties AS (SELECT market_id, commodity, list({{'variety': variety, 'grade': grade, 'avg_price': avg_price,
    'max_price': {rounded('CAST(max_price AS DOUBLE)')}, 'min_price': {rounded('CAST(min_price AS DOUBLE)')}}}
    ORDER BY average DESC, variety, grade) AS comparison FROM compared GROUP BY ALL)
SELECT CAST(market_id AS BIGINT) AS market_id, commodity,
  CAST(to_json({{'history': history, 'varietyComparison': comparison}}) AS VARCHAR) AS document
FROM histories JOIN varieties USING (market_id, commodity)""",
    "explorer_document_of_selection": f"""WITH {STAR}, {_moved('selection', _SELECTIONS)}, {COMPARED},
labels AS (SELECT unnest({list(_SELECTED)}) AS selection),
histories AS (SELECT selection, list({{'date': strftime(arrival_date, '%Y-%m-%d'),
    'min_price': {rounded('CAST(min_price AS DOUBLE)')}, 'max_price': {rounded('CAST(max_price AS DOUBLE)')},
    'modal_price': price, 'arrival_volume': synthetic_volume}} ORDER BY date_id, market_id, commodity_id) AS history
  FROM moved GROUP BY ALL),
varieties AS (SELECT 'name in a market' AS selection, list({{'variety': variety, 'grade': grade, 'avg_price': avg_price,
    'max_price': {rounded('CAST(max_price AS DOUBLE)')}, 'min_price': {rounded('CAST(min_price AS DOUBLE)')}}}
    ORDER BY average DESC, variety, grade) AS comparison FROM compared WHERE commodity = 'PROMO' AND market_id = 7)
SELECT selection, CAST(to_json({{'history': coalesce(history, []), 'varietyComparison': coalesce(comparison, [])}}) AS VARCHAR) AS document
FROM labels LEFT JOIN histories USING (selection) LEFT JOIN varieties USING (selection)""",
    "grade_class": f"WITH {STAR} " + typed(
        "commodity_id:l grade:s grade_class:s",
        "(SELECT *, CASE WHEN grade = 'Premium' THEN 'premium' ELSE 'regular' END AS grade_class FROM commodity_dim)",
    ),
}
