"""Time-series features."""

from pyspark.sql import functions as F

from harvestlens.operators import features
from harvestlens.queries.common import SERIES, STATE_QUOTES, STATE_SERIES, plain, series_sql, typed
from harvestlens.sources.tables import TradeTables

KEYS = ["market_id", "commodity"]
STATE_KEYS = ["state_id", "commodity"]


def series(spark, sf_dir):
    return TradeTables(spark, sf_dir).series()


def feature_columns(*names, causal=False):
    """Some feature columns of every row, before incomplete rows are dropped."""

    def query(spark, sf_dir):
        rows = features.add_features(series(spark, sf_dir), KEYS, causal)
        return plain(rows.select(*KEYS, "arrival_date", *names))

    return query


def eligible_series(spark, sf_dir):
    return plain(features.eligible_series(series(spark, sf_dir), KEYS))


def series_extract(spark, sf_dir):
    return plain(features.series_extract(series(spark, sf_dir), KEYS))


def feature_matrix(spark, sf_dir):
    return plain(features.feature_matrix(series(spark, sf_dir), KEYS))


def feature_matrix_causal(spark, sf_dir):
    return plain(features.feature_matrix(series(spark, sf_dir), KEYS, causal=True))


def time_split(spark, sf_dir):
    split = features.time_split(features.feature_matrix(series(spark, sf_dir), KEYS), KEYS)
    return plain(split.select(*KEYS, "arrival_date", "is_test"))


def series_guards(spark, sf_dir):
    """Guards of the market series and of the denser state series."""
    tables = TradeTables(spark, sf_dir)
    markets = features.series_guards(tables.series(), KEYS).withColumnRenamed("market_id", "place_id")
    states = features.series_guards(tables.state_series(), STATE_KEYS).withColumnRenamed("state_id", "place_id")
    return plain(
        markets.withColumn("level", F.lit("market")).unionByName(states.withColumn("level", F.lit("state")))
    )


def trainable(spark, sf_dir):
    """Split rows of the state series that pass every guard."""
    rows = TradeTables(spark, sf_dir).state_series()
    split = features.time_split(features.feature_matrix(rows, STATE_KEYS), STATE_KEYS)
    usable = features.trainable(split, features.series_guards(rows, STATE_KEYS), STATE_KEYS)
    return plain(usable.select(*STATE_KEYS, "arrival_date", "modal_price", "is_test"))


QUERIES = {
    "eligible_series": eligible_series,
    "series_extract": series_extract,
    "weekday_feature": feature_columns("weekday_num", "month"),
    "lag_features": feature_columns("lag_1", "lag_7", "lag_14"),
    "rolling_mean": feature_columns("roll_mean_7", "roll_mean_14"),
    "rolling_std": feature_columns("roll_std_7"),
    "rolling_causal": feature_columns("roll_mean_7", "roll_mean_14", "roll_std_7", causal=True),
    "feature_matrix": feature_matrix,
    "feature_matrix_causal": feature_matrix_causal,
    "time_split": time_split,
    "series_guards": series_guards,
    "trainable": trainable,
}


def features_sql(keys: str, source: str, causal: bool = False) -> str:
    """All features per row; sums run over whole cents."""
    shift = 1 if causal else 0

    def frame(rows):
        return f"(PARTITION BY {keys} ORDER BY arrival_date ROWS BETWEEN {rows - 1 + shift} PRECEDING AND {shift} PRECEDING)"

    def full(rows, value):
        return f"CASE WHEN position >= {rows + shift} THEN {value} END"

    return f"""
cents AS (SELECT *, CAST(modal_price * 100 AS HUGEINT) AS c,
  row_number() OVER (PARTITION BY {keys} ORDER BY arrival_date) AS position FROM {source}),
summed AS (SELECT *,
  lag(CAST(modal_price AS DOUBLE), 1) OVER (PARTITION BY {keys} ORDER BY arrival_date) AS lag_1,
  lag(CAST(modal_price AS DOUBLE), 7) OVER (PARTITION BY {keys} ORDER BY arrival_date) AS lag_7,
  lag(CAST(modal_price AS DOUBLE), 14) OVER (PARTITION BY {keys} ORDER BY arrival_date) AS lag_14,
  sum(c) OVER {frame(7)} AS s7, sum(c) OVER {frame(14)} AS s14, sum(c * c) OVER {frame(7)} AS q7,
  isodow(arrival_date) - 1 AS weekday_num FROM cents),
featured AS (SELECT *,
  {full(7, "CAST(s7 AS DOUBLE) / CAST(100 AS DOUBLE) / CAST(7 AS DOUBLE)")} AS roll_mean_7,
  {full(14, "CAST(s14 AS DOUBLE) / CAST(100 AS DOUBLE) / CAST(14 AS DOUBLE)")} AS roll_mean_14,
  {full(7, "sqrt(CAST(7 * q7 - s7 * s7 AS DOUBLE) / CAST(42 AS DOUBLE)) / CAST(100 AS DOUBLE)")} AS roll_std_7
  FROM summed),
matrix AS (SELECT * FROM featured WHERE lag_14 IS NOT NULL AND roll_mean_14 IS NOT NULL AND roll_std_7 IS NOT NULL),
split AS (SELECT *, arrival_date > max(arrival_date) OVER (PARTITION BY {keys}) - 30 AS is_test FROM matrix)"""


def guards_sql(keys: str, source: str, name: str) -> str:
    return f"""
{name}_rows AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY arrival_date) > 14 AS full_row,
  arrival_date > max(arrival_date) OVER (PARTITION BY {keys}) - 30 AS late FROM {source}),
{name}_counts AS (SELECT {keys}, count(*) AS rows, count(*) FILTER (WHERE full_row) AS feature_rows,
  count(*) FILTER (WHERE full_row AND late) AS test_rows, count(*) FILTER (WHERE full_row AND NOT late) AS train_rows
  FROM {name}_rows GROUP BY {keys}),
{name} AS (SELECT *, CASE WHEN rows < 180 THEN 'too few rows' WHEN feature_rows < 40 THEN 'too few feature rows'
  WHEN test_rows < 10 THEN 'too few test rows' WHEN train_rows < 30 THEN 'too few train rows' ELSE 'ok' END AS status
  FROM {name}_counts)"""


_KEY = "market_id, commodity"
_STATE_KEY = "state_id, commodity"


def _featured(columns, source="featured", causal=False):
    return f"WITH {SERIES}, {features_sql(_KEY, 'series', causal)} " + typed("market_id:l commodity:s arrival_date:t " + columns, source)


_ALL = "modal_price:d lag_1:d lag_7:d lag_14:d roll_mean_7:d roll_mean_14:d roll_std_7:d weekday_num:l month:l"

SQL = {
    "eligible_series": f"WITH {SERIES} SELECT CAST(market_id AS BIGINT) AS market_id, commodity, count(*) AS days"
    " FROM series GROUP BY ALL HAVING count(*) >= 180 ORDER BY days DESC",
    "series_extract": _featured("month:l modal_price:d position:l"),
    "weekday_feature": _featured("weekday_num:l month:l"),
    "lag_features": _featured("lag_1:d lag_7:d lag_14:d"),
    "rolling_mean": _featured("roll_mean_7:d roll_mean_14:d"),
    "rolling_std": _featured("roll_std_7:d"),
    "rolling_causal": _featured("roll_mean_7:d roll_mean_14:d roll_std_7:d", causal=True),
    "feature_matrix": _featured(_ALL, "matrix"),
    "feature_matrix_causal": _featured(_ALL, "matrix", causal=True),
    "time_split": _featured("is_test:b", "split"),
    "series_guards": f"WITH {SERIES}, {series_sql(_STATE_KEY, STATE_QUOTES, 'dense')}, "
    f"{guards_sql(_KEY, 'series', 'markets')}, {guards_sql(_STATE_KEY, 'dense', 'states')}, "
    "both_levels AS (SELECT market_id AS place_id, * EXCLUDE (market_id), 'market' AS level FROM markets "
    "UNION ALL SELECT state_id, * EXCLUDE (state_id), 'state' FROM states) "
    + typed(
        "place_id:l commodity:s rows:l feature_rows:l test_rows:l train_rows:l status:s level:s", "both_levels"
    ),
    "trainable": f"WITH {STATE_SERIES}, {features_sql(_STATE_KEY, 'series')}, {guards_sql(_STATE_KEY, 'series', 'guards')} "
    + typed(
        "state_id:l commodity:s arrival_date:t modal_price:d is_test:b",
        "split SEMI JOIN (SELECT * FROM guards WHERE status = 'ok') USING (state_id, commodity)",
    ),
}
