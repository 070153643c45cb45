"""Shared parts of the registered queries and of their SQL twins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestlens.constants import STATE_ALIASES, STATE_SEED
from harvestlens.sources.tables import RAW_STATES


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, other numbers as double, dates as text, as in `typed`."""
    def cast(field):
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(kind, T.DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(field) for field in df.schema.fields])


_TYPES = {
    "l": "CAST({0} AS BIGINT)",
    "d": "CAST({0} AS DOUBLE)",
    "s": "CAST({0} AS VARCHAR)",
    "b": "CAST({0} AS BOOLEAN)",
    "t": "strftime({0}, '%Y-%m-%d')",
}


def typed(columns: str, source: str) -> str:
    """SELECT with casts: "state_id:l avg_price:d day:t" FROM source."""
    fields = [column.split(":") for column in columns.split()]
    chosen = ", ".join(f"{_TYPES[kind].format(name)} AS {name}" for name, kind in fields)
    return f"SELECT {chosen} FROM {source}"


def rounded(value: str, places: int = 2) -> str:
    """Exact rounding of a double, ties to even, through its printed form."""
    return f"CAST(printf('%.{places}f', {value}) AS DOUBLE) + 0.0"


def mean(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE) / count({value})"


# -- star tables in SQL -------------------------------------------------------------------

_GRADE = "CASE WHEN p_size <= 16 THEN 'Faq' WHEN p_size <= 33 THEN 'Medium' ELSE 'Premium' END"


def numbered(keys: list[str]) -> str:
    """Ids in the order of the key's hash bucket, then of the key."""
    spelled = "concat_ws(chr(31), " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
    return f"row_number() OVER (ORDER BY substr(md5({spelled}), 1, 3), {', '.join(keys)})"


TRIPLE = ["commodity", "variety", "grade"]

STAR = f"""
products AS (SELECT p_partkey, p_type AS commodity, p_brand AS variety, {_GRADE} AS grade FROM part),
commodity_dim AS (
  SELECT {numbered(TRIPLE)} AS commodity_id, * FROM (SELECT DISTINCT commodity, variety, grade FROM products)),
state_dim AS (SELECT r_regionkey AS state_id, r_name AS state FROM region),
market_dim AS (
  SELECT n_nationkey AS market_id, n_name AS market, r_name || '-' || (n_nationkey % 3) AS district,
         n_regionkey AS state_id
  FROM nation JOIN region ON n_regionkey = r_regionkey),
priced AS (
  SELECT *, CAST(l_shipdate AS DATE) AS arrival_date,
         datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS date_id,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS modal_price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4)) AS min_price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(16,4)) AS max_price
  FROM lineitem),
quotes AS (
  SELECT date_id, arrival_date, s_nationkey AS market_id, commodity_id, commodity, variety, grade,
         l_orderkey, l_linenumber, modal_price, min_price, max_price
  FROM priced JOIN supplier ON l_suppkey = s_suppkey JOIN products ON l_partkey = p_partkey
  JOIN commodity_dim USING (commodity, variety, grade)),
fact AS (
  SELECT date_id, arrival_date, market_id, commodity_id, min_price, max_price, modal_price FROM (
    SELECT *, row_number() OVER (PARTITION BY date_id, market_id, commodity_id
      ORDER BY l_orderkey, l_linenumber, modal_price, min_price, max_price) AS place FROM quotes)
  WHERE place = 1),
date_dim AS (
  SELECT DISTINCT date_id, arrival_date, day(arrival_date) AS day, month(arrival_date) AS month,
         year(arrival_date) AS year, dayname(arrival_date) AS weekday FROM priced),
latest AS (SELECT max(arrival_date) AS latest_date FROM date_dim),
previous AS (SELECT max(arrival_date) AS previous_date FROM date_dim, latest WHERE arrival_date < latest_date),
named AS (
  SELECT fact.*, market, district, state_id, state, commodity, variety, grade
  FROM fact JOIN market_dim USING (market_id) JOIN state_dim USING (state_id)
  JOIN commodity_dim USING (commodity_id))"""


def series_sql(keys: str, source: str, name: str = "series") -> str:
    """First quote of each day per key."""
    return f"""
{name} AS (
  SELECT {keys}, arrival_date, month(arrival_date) AS month, modal_price FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys}, arrival_date
      ORDER BY l_orderkey, l_linenumber, modal_price, min_price, max_price) AS place FROM {source})
  WHERE place = 1)"""


SERIES = STAR + "," + series_sql("market_id, commodity", "quotes")
STATE_QUOTES = "(SELECT quotes.*, state_id FROM quotes JOIN market_dim USING (market_id))"
STATE_SERIES = STAR + "," + series_sql("state_id, commodity", STATE_QUOTES)


def errors_sql(keys: str, source: str) -> str:
    """n, mape, rmse, r2_score of (modal_price, predicted) per key, sums in whole cents."""
    return f"""
SELECT {keys}, count(*) AS n,
  coalesce(CAST(sum(CASE WHEN modal_price <> 0 THEN
    CAST(abs(CAST(modal_price - predicted AS DOUBLE) / CAST(modal_price AS DOUBLE)) AS DECIMAL(28,9)) END) AS DOUBLE)
    / count(*) FILTER (WHERE modal_price <> 0) * 100, 0) AS mape,
  sqrt(CAST(sum((y - p) * (y - p)) AS DOUBLE) / 10000.0 / count(*)) AS rmse,
  CASE WHEN count(*) * sum(y * y) = sum(y) * sum(y) THEN 0 ELSE
    1.0 - count(*) * CAST(sum((y - p) * (y - p)) AS DOUBLE)
        / CAST(count(*) * sum(y * y) - sum(y) * sum(y) AS DOUBLE) END AS r2_score
FROM (SELECT *, CAST(modal_price * 100 AS HUGEINT) AS y, CAST(predicted * 100 AS HUGEINT) AS p FROM {source})
GROUP BY {keys}"""


def clipped_sql(source: str) -> str:
    return f"""
SELECT * REPLACE (
  CAST(greatest(0.0, least(999.99, mape)) AS DECIMAL(5,2)) AS mape,
  CAST(greatest(0.0, least(99999999.99, rmse)) AS DECIMAL(10,2)) AS rmse,
  CAST(greatest(-999.99, least(1.0, r2_score)) AS DECIMAL(5,2)) AS r2_score) FROM {source}"""


def lagged_sql(keys: str, source: str, lag: int) -> str:
    return (
        f"(SELECT *, lag(modal_price, {lag}) OVER (PARTITION BY {keys} ORDER BY arrival_date) AS predicted,"
        f" row_number() OVER (PARTITION BY {keys} ORDER BY arrival_date) AS position FROM {source})"
    )


PERSISTENCE = STAR + f""",
persistence AS ({errors_sql("market_id, commodity_id",
    "(SELECT * FROM " + lagged_sql("market_id, commodity_id", "fact", 1) + " WHERE predicted IS NOT NULL)")}),
model_evaluation AS ({clipped_sql("persistence")})"""


def baseline_sql(keys: str, source: str) -> str:
    """Test rows with the price seven rows earlier."""
    return (
        f"(SELECT *, max(arrival_date) OVER (PARTITION BY {keys}) AS last_date"
        f" FROM {lagged_sql(keys, source, 7)} WHERE position > 14)"
    )


def baseline_eval_sql(keys: str, source: str) -> str:
    return errors_sql(keys, f"(SELECT * FROM {baseline_sql(keys, source)} WHERE arrival_date > last_date - 30)")


# -- raw quotes and cleaning in SQL ----------------------------------------------------------

_RAW_STATES = "[" + ", ".join(f"'{name}'" for name in RAW_STATES) + "]"

RAW = f"""
numbered AS (
  SELECT *, (l_orderkey * 7 + l_linenumber) % 40 AS number, r_name || '-' || (n_nationkey % 3) AS place
  FROM priced JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
raw AS (
  SELECT CASE WHEN number = 1 THEN 'Atlantis' ELSE {_RAW_STATES}[r_regionkey + 1] END AS state,
    CASE WHEN number = 11 THEN '  ' || lower(place) || ' ' ELSE place END AS district,
    lower(n_name) AS market,
    CASE WHEN number % 2 = 0 THEN lower(p_type) || ' (' || p_brand || ')(x)'
         ELSE p_type || '(' || p_brand || ')' END AS commodity,
    CASE WHEN number <> 5 THEN p_brand END AS variety,
    CASE WHEN p_size <= 16 THEN 'FAQ' WHEN p_size <= 33 THEN 'Medium' ELSE 'premium' END AS grade,
    CASE WHEN number = 6 THEN '31/02/2025'
         WHEN number = 14 THEN strftime(arrival_date, '%Y-%m-%d')
         WHEN number % 3 = 0 THEN strftime(arrival_date, '%d-%m-%Y')
         ELSE strftime(arrival_date, '%d/%m/%Y') END AS arrival_date,
    CAST(CAST(CASE WHEN number = 7 THEN -min_price WHEN number = 8 THEN max_price + 1 ELSE min_price END
         AS DECIMAL(16,4)) AS VARCHAR) AS min_price,
    CAST(max_price AS VARCHAR) AS max_price,
    CAST(CAST(CASE WHEN number = 9 THEN modal_price * 50 ELSE modal_price END AS DECIMAL(16,2)) AS VARCHAR) AS modal_price,
    arrival_date AS day
  FROM (SELECT *, unnest(generate_series(1, CASE WHEN number = 10 THEN 2 ELSE 1 END)) AS copy FROM numbered))"""

_TITLE = (
    "array_to_string(list_transform(regexp_extract_all({0}, '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+'),"
    " lambda x: upper(x[1]) || lower(x[2:])), '')"
)


def titled(value: str) -> str:
    return _TITLE.format(f"trim({value})")


_ALIASES = " ".join(f"WHEN '{alias}' THEN '{name}'" for alias, name in STATE_ALIASES.items())


def canonical(value: str) -> str:
    return f"CASE {value} {_ALIASES} ELSE {value} END"


SEED = "state_seed AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{name}')" for i, name in STATE_SEED
) + ") AS v(state_id, state))"

NAME_MAP = """
name_map AS (SELECT DISTINCT upper(p_type[1]) || lower(p_type[2:]) AS raw_name, lower(p_type) || ' goods' AS english_name
  FROM part WHERE p_type < 'N')"""

_TYPED = "state, district, market, commodity, variety, grade, arrival_date, min_price, max_price, modal_price"

CLEAN = STAR + "," + RAW + "," + SEED + "," + NAME_MAP + f""",
parsed AS (
  SELECT state, district, market, commodity, variety, grade,
    CAST(coalesce(try_strptime(arrival_date, '%d/%m/%Y'), try_strptime(arrival_date, '%d-%m-%Y'),
                  try_strptime(arrival_date, '%Y-%m-%d')) AS DATE) AS arrival_date,
    CAST(min_price AS DECIMAL(20,6)) AS min_price, CAST(max_price AS DECIMAL(20,6)) AS max_price,
    CAST(modal_price AS DECIMAL(20,6)) AS modal_price FROM raw),
dated AS (SELECT * FROM parsed WHERE arrival_date IS NOT NULL),
deduped AS (SELECT DISTINCT * FROM dated),
complete AS (SELECT * FROM deduped WHERE variety IS NOT NULL),
signed AS (SELECT * FROM complete WHERE least(min_price, max_price, modal_price) >= 0),
ranked AS (
  SELECT arrival_date, modal_price, count(*) OVER (PARTITION BY arrival_date) - 1 AS top,
         row_number() OVER (PARTITION BY arrival_date ORDER BY modal_price) - 1 AS place FROM signed),
neighbours AS (
  SELECT arrival_date, max(top) AS top,
    max(modal_price) FILTER (WHERE place = top // 4) AS low1,
    max(modal_price) FILTER (WHERE place = (top + 3) // 4) AS high1,
    max(modal_price) FILTER (WHERE place = (top * 3) // 4) AS low3,
    max(modal_price) FILTER (WHERE place = (top * 3 + 3) // 4) AS high3
  FROM ranked GROUP BY arrival_date),
quartiles AS (
  SELECT arrival_date,
    low1 + (high1 - low1) * CAST(top % 4 AS DECIMAL(1,0)) * 0.25 AS q1,
    low3 + (high3 - low3) * CAST(top * 3 % 4 AS DECIMAL(1,0)) * 0.25 AS q3 FROM neighbours),
inside AS (
  SELECT signed.* FROM signed JOIN quartiles USING (arrival_date)
  WHERE least(min_price, max_price, modal_price) >= q1 - (q3 - q1) * 1.5
    AND greatest(min_price, max_price, modal_price) <= q3 + (q3 - q1) * 1.5),
based AS (SELECT * REPLACE ({titled("split_part(commodity, '(', 1)")} AS commodity) FROM inside),
translated AS (
  SELECT based.* REPLACE (coalesce(english_name, commodity) AS commodity)
  FROM based LEFT JOIN name_map ON commodity = raw_name),
texts AS (
  SELECT * REPLACE ({titled("state")} AS state, {titled("district")} AS district, {titled("market")} AS market,
    {titled("variety")} AS variety, {titled("grade")} AS grade) FROM translated),
states AS (SELECT * REPLACE ({canonical("state")} AS state) FROM texts),
cleaned AS (SELECT * FROM states WHERE min_price <= modal_price AND modal_price <= max_price),
known AS (SELECT cleaned.*, state_id FROM cleaned JOIN state_seed USING (state))"""
