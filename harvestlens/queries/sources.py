"""Scans, sources and sinks."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import FEATURES
from harvestlens.operators import audit, cleaning, evaluation, features, models
from harvestlens.plans import documents, training
from harvestlens.queries.common import (
    CLEAN, NAME_MAP, PERSISTENCE, RAW, SEED, SERIES, STAR, STATE_SERIES, baseline_eval_sql, canonical, clipped_sql,
    errors_sql, lagged_sql, mean, plain, rounded, titled, typed,
)
from harvestlens.queries.features import features_sql, guards_sql
from harvestlens.queries.models import ridge_sql
from harvestlens.session import scratch_path, write_and_read
from harvestlens.sources import daily_files, lookups, star_store
from harvestlens.sources.star_store import Star, StarStore
from harvestlens.sources.tables import TradeTables


def scan_daily_quotes(spark, sf_dir):
    """Days before 1998 in the primary folder, all days in the fallback; one folder per day, the files gzipped, both trees from one pass."""
    raw = TradeTables(spark, sf_dir).raw_quotes().withColumnRenamed("day", "folder_day")
    path, early = scratch_path(spark, "daily"), F.col("folder_day") < F.lit("1998-01-01").cast("date")
    roots = {"primary": early, "fallback": F.lit(True)}
    daily_files.write_daily_quotes(raw, "folder_day", path, roots=roots, compression="gzip")
    scanned = daily_files.scan_daily_quotes(spark, *[daily_files.root_folder(path, name) for name in roots])
    return plain(cleaning.rename_quotes(scanned))


def quote_days(tables: TradeTables):
    return tables.priced().select("arrival_date")


def month_spine(days):
    """All days of all months the quotes touch."""
    bounds = days.agg(
        F.trunc(F.min("arrival_date"), "month").alias("first"), F.last_day(F.max("arrival_date")).alias("last")
    )
    return daily_files.day_rows(bounds.select(F.sequence("first", "last").alias("days")))


def date_spine(spark, sf_dir):
    return plain(month_spine(quote_days(TradeTables(spark, sf_dir))))


PAGE_SIZE = 2  # records per page of the fetch in these queries


def record_pages(spark, tables):
    """All quotes written as pages of a fetch per day and market, and read back."""
    path = scratch_path(spark, "pages")
    daily_files.write_record_pages(tables.raw_quotes(), "day", path, PAGE_SIZE)
    return daily_files.read_record_pages(spark, path)


def missing_days(spark, sf_dir):
    """Days without quotes, and days a fetch of which ended with a full page."""
    tables = TradeTables(spark, sf_dir)
    failed = daily_files.failed_days(record_pages(spark, tables), PAGE_SIZE)
    days = quote_days(tables)
    return plain(daily_files.missing_days(month_spine(days).select("arrival_date"), days, failed))


def flatten_record_pages(spark, sf_dir):
    """Quotes written as JSON pages of several records and read back."""
    pages = record_pages(spark, TradeTables(spark, sf_dir))
    return cleaning.rename_quotes(daily_files.flatten_record_pages(pages))


def load_name_map(spark, sf_dir):
    """The names of all product types, written as one JSON object and read back."""
    types = TradeTables(spark, sf_dir).table("part").select("p_type").distinct()
    pair = F.struct(F.initcap("p_type"), F.concat(F.lower("p_type"), F.lit(" goods")))
    path = scratch_path(spark, "names")
    types.agg(F.to_json(F.map_from_entries(F.collect_set(pair))).alias("value")).write.text(path)
    return lookups.load_name_map(spark, path)


def unmapped_names(spark, sf_dir):
    tables = TradeTables(spark, sf_dir)
    quotes = cleaning.base_commodity(cleaning.rename_quotes(tables.raw_quotes()))
    return lookups.unmapped_names(quotes, tables.name_map())


def extended_name_map(spark, sf_dir):
    tables = TradeTables(spark, sf_dir)
    quotes = cleaning.base_commodity(cleaning.rename_quotes(tables.raw_quotes()))
    return lookups.extend_name_map(quotes, tables.name_map())


def table_scan(spark, sf_dir):
    """The whole fact, keys and modal price."""
    fact = TradeTables(spark, sf_dir).fact
    return plain(star_store.table_scan(fact, columns=["date_id", "market_id", "commodity_id", "modal_price"]))


def series_scan(spark, sf_dir):
    """One market's rows."""
    fact = TradeTables(spark, sf_dir).fact
    return plain(star_store.table_scan(fact, F.col("market_id") == 7, ["date_id", "commodity_id", "modal_price"]))


def append_fact(spark, sf_dir):
    """The fact written by year and month, then read back."""
    store = star_store.StarStore(spark, scratch_path(spark, "append"))
    tables = TradeTables(spark, sf_dir)
    store.append_fact(tables.fact.withColumns({
        c: F.col(c).cast("decimal(12,2)") for c in ("min_price", "max_price", "modal_price")
    }))
    return plain(store.read("fact_market_prices").select("date_id", "market_id", "commodity_id", "modal_price", "year", "month"))


def bulk_upsert(spark, sf_dir):
    """Previous-row metrics of all series, replaced by weekly-lag metrics where those exist."""
    keys = ["market_id", "commodity"]
    series = TradeTables(spark, sf_dir).series()
    target = evaluation.persistence_eval(series, keys)
    updates = evaluation.clip_metrics(evaluation.baseline_eval(series, keys)).drop("n")
    return plain(star_store.bulk_upsert(target, updates, keys))


def constraint_audit(spark, sf_dir):
    """Every rule of the star; the fact is built and written once, for itself and for the metrics of its series."""
    tables = TradeTables(spark, sf_dir)
    star = Star(
        tables.state_dim, tables.market_dim, tables.commodity_dim, tables.date_dim, write_and_read(tables.fact, "fact")
    )
    star.model_evaluation = evaluation.persistence_eval(features.fact_series(star))
    return audit.constraint_audit(star)


def raw_key_audit(spark, sf_dir):
    """Keys the raw tables repeat: the quote key before the fact is built, order and line."""
    tables = TradeTables(spark, sf_dir)
    quotes = tables.keyed(tables.products())
    reports = audit.unique_violations("quotes", quotes, ["date_id", "market_id", "commodity", "variety", "grade"])
    return reports.unionByName(
        audit.unique_violations("lineitem", tables.table("lineitem"), ["l_orderkey", "l_linenumber"])
    )


def seed_state_dim(spark, sf_dir):
    """The 36 seed states with the number of raw quotes that name each."""
    quotes = cleaning.canonical_state(cleaning.clean_text(cleaning.rename_quotes(TradeTables(spark, sf_dir).raw_quotes())))
    counts = quotes.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    seeded = lookups.seed_states(spark).join(counts, "state", "left")
    return plain(seeded.select("state_id", "state", F.coalesce("n", F.lit(0)).alias("n_quotes")))


def model_store(spark, sf_dir):
    """Models stored and loaded: all series with a strong penalty, then states 0 and 1 again with the usual one.

    A commodity has its place among the sorted names as id; every series is asked for and, in each state, an id that is not
    sold, which has no model (NULLs).
    """
    tables = TradeTables(spark, sf_dir)
    series = write_and_read(tables.state_series(), "series")
    names = series.select("commodity").distinct().withColumn("commodity_id", F.row_number().over(W.orderBy("commodity")))
    ids = lambda rows: rows.join(names, "commodity").drop("commodity").withColumnRenamed("state_id", "market_id")
    learned = training.train_series(series, ["state_id", "commodity"]).train
    store = StarStore(spark, scratch_path(spark, "models"))
    for penalty, part in ((models.RIDGE * 10, F.lit(True)), (models.RIDGE, F.col("state_id") < 2)):
        fitted = models.solved(models.fit_ridge(learned.filter(part), ["state_id", "commodity"], penalty))
        store.upsert("series_models", ids(fitted), features.KEYS)
    asked = ids(series.select("state_id", "commodity").distinct()).select(*features.KEYS)
    asked = asked.unionByName(asked.select("market_id", F.lit(0).alias("commodity_id")))
    loaded = store.read_latest("series_models")
    weights = [F.round(F.col("coefficients")[i], 6).alias(f"per_{c}") for i, c in enumerate(FEATURES)]
    found = loaded.select(*features.KEYS, F.round("intercept", 6).alias("intercept"), *weights)
    return plain(found.unionByName(models.missing_models(asked, loaded), allowMissingColumns=True))


def written_star(spark, sf_dir):
    """The star with fact and dates written once, which every part of a document then reads."""
    tables = TradeTables(spark, sf_dir)
    fact, dates = write_and_read(tables.fact, "fact"), write_and_read(tables.date_dim, "dates")
    star = Star(tables.state_dim, tables.market_dim, tables.commodity_dim, dates, fact)
    star.model_evaluation = write_and_read(evaluation.persistence_eval(features.fact_series(star)), "evaluations")
    return star


def overview_document(spark, sf_dir):
    return documents.overview_document(written_star(spark, sf_dir))


def overview_documents(spark, sf_dir):
    """One document per state and a national one (state NULL)."""
    return documents.overview_documents(written_star(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        scan_daily_quotes, date_spine, missing_days, flatten_record_pages, load_name_map, unmapped_names,
        extended_name_map, table_scan, series_scan, append_fact, bulk_upsert, constraint_audit,
        raw_key_audit, seed_state_dim, model_store, overview_document, overview_documents,
    )
}

_SPINE = """
spine AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(arrival_date)), last_day(max(arrival_date)),
  INTERVAL 1 DAY)) AS DATE) AS arrival_date FROM priced)"""

_RAW_COLUMNS = (
    "state:s district:s market:s commodity:s variety:s grade:s arrival_date:s min_price:s max_price:s modal_price:s"
)


def _unique(table, keys):
    inner = f"SELECT 1 FROM {table[1]} GROUP BY {', '.join(keys)} HAVING count(*) > 1"
    return f"SELECT '{table[0]}' AS table_name, 'unique({', '.join(keys)})' AS rule, count(*) AS n FROM ({inner})"


def _references(table, key, parent):
    return (
        f"SELECT '{table[0]}', 'references({key})', count(*) FROM {table[1]} "
        f"WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})"
    )


def _not_null(table, columns):
    return [f"SELECT '{table[0]}', 'not null({c})', count(*) FILTER (WHERE {c} IS NULL) FROM {table[1]}" for c in columns]


def _audit_sql():
    state, commodity = ("state_dim", "state_dim"), ("commodity_dim", "commodity_dim")
    market, date = ("market_dim", "market_dim"), ("date_dim", "date_dim")
    fact, model = ("fact_market_prices", "fact"), ("model_evaluation", "model_evaluation")
    parts = [
        _unique(state, ["state_id"]), _unique(state, ["state"]), *_not_null(state, ["state"]),
        _unique(commodity, ["commodity_id"]), _unique(commodity, ["commodity", "variety", "grade"]),
        *_not_null(commodity, ["commodity", "variety", "grade"]),
        _unique(market, ["market_id"]), _unique(market, ["market", "district", "state_id"]),
        _references(market, "state_id", "state_dim"), *_not_null(market, ["market", "district"]),
        _unique(date, ["date_id"]), _unique(date, ["arrival_date"]),
        *_not_null(date, ["arrival_date", "day", "month", "year", "weekday"]),
        _unique(fact, ["date_id", "market_id", "commodity_id"]),
        _references(fact, "date_id", "date_dim"), _references(fact, "market_id", "market_dim"),
        _references(fact, "commodity_id", "commodity_dim"),
        *_not_null(fact, ["min_price", "max_price", "modal_price"]),
        _unique(model, ["market_id", "commodity_id"]), _references(model, "market_id", "market_dim"),
        _references(model, "commodity_id", "commodity_dim"),
    ]
    return f"WITH {PERSISTENCE} " + " UNION ALL ".join(parts)


_KEYS = "market_id, commodity"

SQL = {
    "model_store": f"""WITH {STATE_SERIES}, {features_sql("state_id, commodity", 'series', causal=True)}, {guards_sql("state_id, commodity", 'series', 'guards')},
learned AS (SELECT * FROM split SEMI JOIN (SELECT * FROM guards WHERE status = 'ok') USING (state_id, commodity) WHERE NOT is_test),
{ridge_sql("state_id, commodity", "learned", "strong", models.RIDGE * 10)}, {ridge_sql("state_id, commodity", "learned", "usual")},
numbers AS (SELECT commodity, row_number() OVER (ORDER BY commodity) AS commodity_id FROM (SELECT DISTINCT commodity FROM series)),
stored AS (SELECT * FROM usual WHERE state_id < 2 UNION ALL SELECT * FROM strong WHERE state_id >= 2),
asked AS (SELECT DISTINCT state_id, commodity FROM series UNION ALL SELECT DISTINCT state_id, NULL FROM series)
SELECT CAST(state_id AS BIGINT) AS market_id, CAST(coalesce(commodity_id, 0) AS BIGINT) AS commodity_id, round(intercept, 6) AS intercept,
  {", ".join(f"round(per_{c}, 6) AS per_{c}" for c in FEATURES)}
FROM asked LEFT JOIN numbers USING (commodity) LEFT JOIN stored USING (state_id, commodity)""",
    "scan_daily_quotes": f"WITH {STAR}, {RAW} "
    + typed(_RAW_COLUMNS + " file_day:t", "(SELECT *, CAST(day AS DATE) AS file_day FROM raw)"),
    "date_spine": f"WITH {STAR}, {_SPINE} "
    + typed("arrival_date:t day_text:s", "(SELECT *, strftime(arrival_date, '%d/%m/%Y') AS day_text FROM spine)"),
    "missing_days": f"WITH {STAR}, {RAW}, {_SPINE} " + typed(
        "arrival_date:t reason:s",
        "(SELECT arrival_date, 'no data' AS reason FROM spine WHERE arrival_date NOT IN (SELECT arrival_date FROM priced)"
        " UNION ALL SELECT DISTINCT CAST(day AS DATE), 'fetch failed midway' FROM raw GROUP BY day, market HAVING count(*) % 2 = 0)",
    ),
    "flatten_record_pages": f"WITH {STAR}, {RAW} " + typed(_RAW_COLUMNS, "raw"),
    "load_name_map": "SELECT DISTINCT upper(p_type[1]) || lower(p_type[2:]) AS raw_name, lower(p_type) || ' goods' AS english_name FROM part",
    "unmapped_names": f"WITH {CLEAN}, names AS (SELECT DISTINCT {titled('split_part(commodity, chr(40), 1)')} AS name FROM raw) "
    "SELECT name AS raw_name, name AS english_name FROM names WHERE name NOT IN (SELECT raw_name FROM name_map)",
    "extended_name_map": f"WITH {CLEAN}, names AS (SELECT DISTINCT {titled('split_part(commodity, chr(40), 1)')} AS name FROM raw) "
    "SELECT name AS raw_name, name AS english_name FROM names WHERE name NOT IN (SELECT raw_name FROM name_map) "
    "UNION ALL SELECT * FROM name_map",
    "table_scan": f"WITH {STAR} " + typed("date_id:l market_id:l commodity_id:l modal_price:d", "fact"),
    "series_scan": f"WITH {STAR} " + typed("date_id:l commodity_id:l modal_price:d", "fact WHERE market_id = 7"),
    "append_fact": f"WITH {STAR} " + typed(
        "date_id:l market_id:l commodity_id:l modal_price:d year:l month:l",
        "(SELECT *, year(arrival_date) AS year, month(arrival_date) AS month FROM fact)",
    ),
    "bulk_upsert": f"""WITH {SERIES},
target AS ({clipped_sql('(' + errors_sql(_KEYS, '(SELECT * FROM ' + lagged_sql(_KEYS, 'series', 1) + ' WHERE predicted IS NOT NULL)') + ')')}),
updates AS ({clipped_sql('(' + baseline_eval_sql(_KEYS, 'series') + ')')}),
merged AS (SELECT * FROM updates UNION ALL SELECT * FROM target
  WHERE (market_id, commodity) NOT IN (SELECT (market_id, commodity) FROM updates))
""" + typed("market_id:l commodity:s mape:d rmse:d r2_score:d", "merged"),
    "constraint_audit": _audit_sql(),
    "raw_key_audit": f"WITH {STAR} " + " UNION ALL ".join([
        _unique(("quotes", "quotes"), ["date_id", "market_id", "commodity", "variety", "grade"]),
        _unique(("lineitem", "lineitem"), ["l_orderkey", "l_linenumber"]),
    ]),
    "seed_state_dim": f"""WITH {STAR}, {RAW}, {SEED},
titled AS (SELECT {titled('state')} AS state FROM raw),
counts AS (SELECT {canonical('state')} AS state, count(*) AS n FROM titled GROUP BY 1)
""" + typed("state_id:l state:s n_quotes:l",
            "(SELECT state_id, state, coalesce(n, 0) AS n_quotes FROM state_seed LEFT JOIN counts USING (state))"),
    "overview_document": f"""WITH {PERSISTENCE},
of_day AS (SELECT named.* FROM named, latest WHERE arrival_date = latest_date),
pricing AS (SELECT state_id, state AS state_name, {rounded(mean('modal_price'))} AS avg_price, count(*) AS record_count
  FROM of_day GROUP BY ALL),
trend AS (SELECT arrival_date, {rounded(mean('modal_price'))} AS price FROM fact, latest
  WHERE arrival_date >= latest_date - 14 GROUP BY arrival_date),
top AS (SELECT commodity, {rounded(mean('modal_price'))} AS avg_price, count(*) AS report_count FROM of_day
  GROUP BY commodity ORDER BY report_count DESC, commodity LIMIT 5),
two AS (SELECT commodity_id,
    CAST(sum(modal_price) FILTER (WHERE arrival_date = latest_date) AS DOUBLE) / nullif(count(*) FILTER (WHERE arrival_date = latest_date), 0) AS now,
    CAST(sum(modal_price) FILTER (WHERE arrival_date = previous_date) AS DOUBLE) / nullif(count(*) FILTER (WHERE arrival_date = previous_date), 0) AS before
  FROM fact, latest, previous WHERE arrival_date IN (latest_date, previous_date) GROUP BY commodity_id),
movers AS (SELECT (now - before) / before * 100 AS pct FROM two WHERE now IS NOT NULL AND before > 0)
SELECT CAST(to_json({{
  'kpis': {{
    'avgPrice': (SELECT coalesce({rounded(mean('modal_price'))}, 0.0) FROM of_day),
    'totalRecords': (SELECT count(*) FROM fact), 'totalStates': (SELECT count(*) FROM state_dim),
    'totalMarkets': (SELECT count(*) FROM market_dim), 'totalCommodities': (SELECT count(*) FROM commodity_dim),
    'totalModels': (SELECT count(*) FROM model_evaluation),
    'forecastTrust': (SELECT coalesce({rounded('100.0 - ' + mean('mape'), 1)}, 92.0) FROM model_evaluation),
    'latestDate': (SELECT strftime(latest_date, '%Y-%m-%d') FROM latest)}},
  'statePricing': (SELECT map(list(CAST(state_id AS VARCHAR) ORDER BY CAST(state_id AS VARCHAR)),
     list({{'state_name': state_name, 'avg_price': avg_price, 'record_count': record_count}} ORDER BY CAST(state_id AS VARCHAR))) FROM pricing),
  'nationalTrend': (SELECT list({{'date': strftime(arrival_date, '%Y-%m-%d'), 'price': price}} ORDER BY arrival_date) FROM trend),
  'topCommodities': (SELECT list({{'commodity': commodity, 'avg_price': avg_price, 'report_count': report_count}}
     ORDER BY report_count DESC, commodity) FROM top),
  'gainersCount': (SELECT count(*) FROM movers WHERE pct > 0.1),
  'losersCount': (SELECT count(*) FROM movers WHERE pct < -0.1)}}) AS VARCHAR) AS document""",
    "overview_documents": f"""WITH {PERSISTENCE},
scopes AS (SELECT state_id, state FROM state_dim UNION ALL SELECT -1, NULL),
scoped AS (SELECT * FROM named UNION ALL SELECT * REPLACE (-1 AS state_id) FROM named),
of_day AS (SELECT scoped.* FROM scoped, latest WHERE arrival_date = latest_date),
usage AS (SELECT state_id, count(*) AS records, count(DISTINCT market_id) AS markets, count(DISTINCT commodity_id) AS names
  FROM scoped GROUP BY state_id),
prices AS (SELECT state_id, {rounded(mean('modal_price'))} AS price FROM of_day GROUP BY state_id),
evals AS (SELECT state_id, count(*) AS models, {rounded('100.0 - ' + mean('mape'), 1)} AS trust FROM
  (SELECT state_id, mape FROM model_evaluation JOIN market_dim USING (market_id) UNION ALL SELECT -1, mape FROM model_evaluation) GROUP BY state_id),
pricing AS (SELECT map(list(CAST(state_id AS VARCHAR) ORDER BY CAST(state_id AS VARCHAR)),
    list({{'state_name': state, 'avg_price': avg_price, 'record_count': n}} ORDER BY CAST(state_id AS VARCHAR))) AS entries FROM
  (SELECT state_id, state, {rounded(mean('modal_price'))} AS avg_price, count(*) AS n FROM of_day WHERE state_id >= 0 GROUP BY ALL)),
days AS (SELECT state_id, arrival_date, {rounded(mean('modal_price'))} AS price FROM scoped, latest
  WHERE arrival_date >= latest_date - 14 GROUP BY state_id, arrival_date),
trends AS (SELECT state_id, list({{'date': strftime(arrival_date, '%Y-%m-%d'), 'price': price}} ORDER BY arrival_date) AS trend FROM days GROUP BY state_id),
counted AS (SELECT state_id, commodity, {rounded(mean('modal_price'))} AS avg_price, count(*) AS n FROM of_day GROUP BY state_id, commodity),
placed AS (SELECT *, row_number() OVER (PARTITION BY state_id ORDER BY n DESC, commodity) AS place FROM counted),
tops AS (SELECT state_id, list({{'commodity': commodity, 'avg_price': avg_price, 'report_count': n}} ORDER BY place) AS top
  FROM placed WHERE place <= 5 GROUP BY state_id),
two AS (SELECT state_id, commodity_id,
    CAST(sum(modal_price) FILTER (WHERE arrival_date = latest_date) AS DOUBLE) / nullif(count(*) FILTER (WHERE arrival_date = latest_date), 0) AS now,
    CAST(sum(modal_price) FILTER (WHERE arrival_date = previous_date) AS DOUBLE) / nullif(count(*) FILTER (WHERE arrival_date = previous_date), 0) AS before
  FROM scoped, latest, previous WHERE arrival_date IN (latest_date, previous_date) GROUP BY state_id, commodity_id),
movers AS (SELECT state_id, count(*) FILTER (WHERE (now - before) / before * 100 > 0.1) AS gainers,
    count(*) FILTER (WHERE (now - before) / before * 100 < -0.1) AS losers FROM two WHERE before > 0 GROUP BY state_id)
SELECT state, CAST(to_json({{
  'kpis': {{
    'avgPrice': coalesce(price, 0.0), 'totalRecords': coalesce(records, 0),
    'totalStates': CASE WHEN state_id >= 0 THEN 1 ELSE (SELECT count(*) FROM state_dim) END,
    'totalMarkets': CASE WHEN state_id >= 0 THEN coalesce(markets, 0) ELSE (SELECT count(*) FROM market_dim) END,
    'totalCommodities': CASE WHEN state_id >= 0 THEN coalesce(names, 0) ELSE (SELECT count(*) FROM commodity_dim) END,
    'totalModels': coalesce(models, 0), 'forecastTrust': coalesce(trust, 92.0),
    'latestDate': (SELECT strftime(latest_date, '%Y-%m-%d') FROM latest)}},
  'statePricing': (SELECT entries FROM pricing),
  'nationalTrend': coalesce(trend, []), 'topCommodities': coalesce(top, []),
  'gainersCount': coalesce(gainers, 0), 'losersCount': coalesce(losers, 0)}}) AS VARCHAR) AS document
FROM scopes LEFT JOIN usage USING (state_id) LEFT JOIN prices USING (state_id) LEFT JOIN evals USING (state_id)
  LEFT JOIN trends USING (state_id) LEFT JOIN tops USING (state_id) LEFT JOIN movers USING (state_id)""",
}
