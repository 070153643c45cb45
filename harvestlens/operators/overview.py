"""Overview figures: KPIs, state prices, trend, top names and movers.

Facts are summed per market or commodity id before any dimension is joined, so the joins
see at most one row per id (and day) however many facts there are. Dates are compared as
day numbers, which date_id is, so no query has to join date_dim.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.constants import DEFAULT_TRUST, MOVER_PCT
from harvestlens.functions.numeric import exact_avg, ratio_of, round_half_even
from harvestlens.operators.usage import distinct_ids, figures
from harvestlens.sources.star_store import Star, between_days

#: Stands for all states together where states are joined by id: ids are not negative, and NULL meets nothing in a join.
ALL_STATES = -1


def latest_date(star: Star) -> DataFrame:
    """Latest date of date_dim, whether or not it has facts."""
    return star.date_dim.agg(F.max("arrival_date").alias("latest_date"))


def previous_date(star: Star) -> DataFrame:
    """The last date before the latest, that is the previous reported day."""
    earlier = star.date_dim.filter(F.col("arrival_date") < latest_date(star).scalar())
    return earlier.agg(F.max("arrival_date").alias("previous_date"))


def _latest(star: Star, days_before: int = 0) -> DataFrame:
    """The latest date, or a day before it, as the first of the sorted dates.

    Not an aggregate: Spark would merge the subqueries that read it into one struct, whose
    fields it could not push into scans.
    """
    last = star.date_dim.select("arrival_date").orderBy(F.desc("arrival_date")).limit(1)
    return last.select(F.date_sub("arrival_date", days_before).alias("day"))


def _latest_id(star: Star) -> Column:
    return _latest(star).select(F.unix_date("day")).scalar()


def _latest_facts(star: Star) -> DataFrame:
    return between_days(star.fact, _latest(star), _latest(star))


def previous_day(star: Star) -> DataFrame:
    """previous_date as the first of the sorted dates: no row if there is none."""
    earlier = star.date_dim.filter(F.col("arrival_date") < latest_date(star).scalar())
    return earlier.select("arrival_date").orderBy(F.desc("arrival_date")).limit(1)


def _previous_id(star: Star) -> Column:
    return previous_day(star).select(F.unix_date("arrival_date")).scalar()


def _last_two(star: Star) -> DataFrame:
    """The earlier of the last two dates, or the only one, as a one-row frame."""
    last = star.date_dim.select("arrival_date").orderBy(F.desc("arrival_date")).limit(2)
    return last.select("arrival_date").orderBy("arrival_date").limit(1)


def _state_markets(star: Star, state: str | None) -> DataFrame:
    """market_id, state_id and state of every market, or of one state's."""
    states = star.state_dim if state is None else star.state_dim.filter(F.col("state") == state)
    return star.market_dim.join(states, "state_id").select("market_id", "state_id", "state")


def _totals(fact: DataFrame, *by) -> DataFrame:
    return fact.groupBy(*by).agg(F.sum("modal_price").alias("total"), F.count(F.lit(1)).alias("n"))


def _in_state(totals: DataFrame, star: Star, state: str | None) -> DataFrame:
    if state is None:
        return totals
    return totals.join(_state_markets(star, state).select("market_id"), "market_id", "left_semi")


def _evaluations(star: Star, state: str | None) -> DataFrame:
    return _in_state(star.model_evaluation, star, state)


def _used(star: Star, state: str, count: str) -> DataFrame:
    """A number of distinct ids with facts in a state, 0 if there are none."""
    return distinct_ids(star, _state_markets(star, state), "state_id").agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))


# -- KPIs: each a one-row frame --------------------------------------------------------


def kpi_total_records(star: Star, state: str | None = None) -> DataFrame:
    counts = figures(star) if state is None else _in_state(figures(star, "market_id"), star, state)
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"))


def kpi_commodity_count(star: Star, state: str | None = None) -> DataFrame:
    """All (commodity, variety, grade) triples, or the distinct ids with facts in a state."""
    if state is None:
        return star.commodity_dim.agg(F.count(F.lit(1)).alias("total_commodities"))
    return _used(star, state, "total_commodities")


def kpi_market_count(star: Star, state: str | None = None) -> DataFrame:
    if state is None:
        return star.market_dim.agg(F.count(F.lit(1)).alias("total_markets"))
    return _used(star, state, "total_markets")


def kpi_state_count(star: Star, state: str | None = None) -> DataFrame:
    if state is None:
        return star.state_dim.agg(F.count(F.lit(1)).alias("total_states"))
    return star.state_dim.sparkSession.range(1).select(F.lit(1).cast("bigint").alias("total_states"))


def kpi_model_count(star: Star, state: str | None = None) -> DataFrame:
    return _evaluations(star, state).agg(F.count(F.lit(1)).alias("total_models"))


def trust(average_mape: Column) -> Column:
    return F.coalesce(round_half_even(100.0 - average_mape, 1), F.lit(DEFAULT_TRUST))


def kpi_forecast_trust(star: Star, state: str | None = None) -> DataFrame:
    return _evaluations(star, state).agg(trust(exact_avg(F.col("mape"))).alias("forecast_trust"))


def latest_avg_price(star: Star, state: str | None = None) -> DataFrame:
    """Average modal price on the latest date; 0 if that date has no facts."""
    latest = _latest_facts(star)
    totals = _in_state(_totals(latest, "market_id"), star, state)
    average = round_half_even(ratio_of(F.sum("total"), F.sum("n")), 2)
    return totals.agg(F.coalesce(average, F.lit(0.0)).alias("avg_price"))


def overview_kpis(star: Star, state: str | None = None) -> DataFrame:
    """All KPIs in one row, each a scalar subquery."""
    parts = {
        "avg_price": latest_avg_price(star, state),
        "total_records": kpi_total_records(star, state),
        "total_states": kpi_state_count(star, state),
        "total_markets": kpi_market_count(star, state),
        "total_commodities": kpi_commodity_count(star, state),
        "total_models": kpi_model_count(star, state),
        "forecast_trust": kpi_forecast_trust(star, state),
        "latest_date": latest_date(star),
    }
    one = star.state_dim.sparkSession.range(1)
    return one.select(*[part.scalar().alias(name) for name, part in parts.items()])


# -- tables -----------------------------------------------------------------------------


def state_pricing(star: Star) -> DataFrame:
    """Average modal price and row count per state on the latest date, always national."""
    latest = _latest_facts(star)
    by_market = _totals(latest, "market_id").join(_state_markets(star, None), "market_id")
    return by_market.groupBy("state_id", F.col("state").alias("state_name")).agg(
        round_half_even(ratio_of(F.sum("total"), F.sum("n")), 2).alias("avg_price"),
        F.sum("n").alias("record_count"),
    )


def price_trend(star: Star, days: int = 14, state: str | None = None) -> DataFrame:
    """Daily average from `days` before the latest date on (days + 1 calendar days)."""
    recent = between_days(star.fact, _latest(star, days))
    if state is None:
        totals = _totals(recent, "date_id")
    else:
        by_market = _in_state(_totals(recent, "date_id", "market_id"), star, state)
        totals = by_market.groupBy("date_id").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    price = round_half_even(ratio_of(F.col("total"), F.col("n")), 2)
    return totals.select(F.date_from_unix_date("date_id").alias("arrival_date"), price.alias("price")).orderBy("arrival_date")


def _latest_by_name(star: Star, state: str | None) -> DataFrame:
    latest = _latest_facts(star)
    if state is None:
        by_id = _totals(latest, "commodity_id")
    else:
        by_id = _in_state(_totals(latest, "commodity_id", "market_id"), star, state)
    return by_id.join(star.commodity_dim, "commodity_id").groupBy("commodity").agg(
        round_half_even(ratio_of(F.sum("total"), F.sum("n")), 2).alias("avg_price"),
        F.sum("n").alias("report_count"),
    )


def top_commodities(star: Star, k: int = 5, state: str | None = None) -> DataFrame:
    """The k most reported names of the latest date; equal counts by name."""
    return _latest_by_name(star, state).orderBy(F.desc("report_count"), "commodity").limit(k)


def price_movers(star: Star, state: str | None = None) -> DataFrame:
    """Per commodity id: averages of the latest and the previous date and the % change.

    One scan with conditional sums instead of a join of two aggregates.
    """
    latest, previous = _latest_id(star), _previous_id(star)
    both = between_days(star.fact, previous_day(star))
    by = ["commodity_id", "date_id"]
    if state is None:
        totals = _totals(both, *by)
    else:
        totals = _in_state(_totals(both, *by, "market_id"), star, state)
    of_day = lambda day, c: F.sum(F.when(F.col("date_id") == day, F.col(c)))
    averages = totals.groupBy("commodity_id").agg(
        ratio_of(of_day(latest, "total"), of_day(latest, "n")).alias("price_latest"),
        ratio_of(of_day(previous, "total"), of_day(previous, "n")).alias("price_previous"),
    )
    change = (F.col("price_latest") - F.col("price_previous")) / F.col("price_previous") * 100
    return averages.filter("price_latest IS NOT NULL AND price_previous > 0").withColumn(
        "pct_change", change
    )


def gainers_losers(star: Star, state: str | None = None) -> DataFrame:
    return price_movers(star, state).agg(
        F.count_if(F.col("pct_change") > MOVER_PCT).alias("gainers"),
        F.count_if(F.col("pct_change") < -MOVER_PCT).alias("losers"),
    )


def overview_by_state(star: Star) -> DataFrame:
    """The overview of every state at once, one row per state (zeros where it has no facts).

    One pass over the usage summary and one over the facts of the two last dates.
    """
    return _overview(star, [["state_id"]]).drop("total_states")


def overview_by_scope(star: Star) -> DataFrame:
    """overview_by_state, and a row for all states together (state_id NULL) with the figures of `overview_kpis` and `gainers_losers`.

    Prices, movers and models of both come from the same passes, by grouping sets over totals that are summed per market
    before; facts and models of markets without a state count in the row of all only.
    """
    return _overview(star, [["state_id"], []])


def _overview(star: Star, scopes: list[list[str]]) -> DataFrame:
    latest, previous = _latest_id(star), _previous_id(star)
    markets, whole = _state_markets(star, None), [] in scopes
    all_states = F.grouping("state_id").alias("all_states")
    scope = F.when(F.col("all_states") == 1, F.lit(ALL_STATES)).otherwise(F.col("state_id")).alias("scope")

    usage = distinct_ids(star, markets, "state_id").withColumnRenamed("state_id", "scope")

    two_days = between_days(star.fact, _last_two(star))
    days = _totals(two_days, "market_id", "commodity_id", "date_id").join(markets, "market_id", "left")
    of_day = lambda day, c: F.sum(F.when(F.col("date_id") == day, F.col(c)))
    by_commodity = days.groupingSets([[*s, "commodity_id"] for s in scopes], "state_id", "commodity_id").agg(
        all_states,
        of_day(latest, "total").alias("total"),
        of_day(latest, "n").alias("n"),
        of_day(previous, "total").alias("previous_total"),
        of_day(previous, "n").alias("previous_n"),
    )
    now = ratio_of(F.col("total"), F.col("n"))
    before = ratio_of(F.col("previous_total"), F.col("previous_n"))
    change = F.when(before > 0, (now - before) / before * 100)
    prices = by_commodity.withColumn("change", change).groupBy(scope).agg(
        round_half_even(ratio_of(F.sum("total"), F.sum("n")), 2).alias("avg_price"),
        F.count_if(F.col("change") > MOVER_PCT).alias("gainers"),
        F.count_if(F.col("change") < -MOVER_PCT).alias("losers"),
    )

    scored = star.model_evaluation.join(markets, "market_id", "left").groupingSets(scopes, "state_id").agg(
        all_states, F.count(F.lit(1)).alias("total_models"), exact_avg(F.col("mape")).alias("mape")
    )
    models = scored.select(scope, "total_models", "mape")
    counts = ["total_records", "total_commodities", "total_markets", "total_models", "gainers", "losers"]
    rows = star.state_dim.select("state_id", "state", F.lit(1).cast("bigint").alias("total_states"))
    totals = {}
    if whole:
        none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("state_id", "state")]
        rows = rows.unionByName(kpi_state_count(star).select(*none, "total_states"))
        of_all = {"total_records": kpi_total_records, "total_commodities": kpi_commodity_count, "total_markets": kpi_market_count}
        totals = {c: F.when(F.col("scope") == ALL_STATES, kpi(star).scalar()) for c, kpi in of_all.items()}
    return (
        rows.withColumn("scope", F.coalesce("state_id", F.lit(ALL_STATES)))
        .join(usage, "scope", "left")
        .join(prices, "scope", "left")
        .join(models, "scope", "left")
        .select(
            "state_id",
            "state",
            "total_states",
            F.coalesce("avg_price", F.lit(0.0)).alias("avg_price"),
            *[F.coalesce(*([totals[c]] if c in totals else []), c, F.lit(0)).alias(c) for c in counts],
            trust(F.col("mape")).alias("forecast_trust"),
        )
    )


def _by_scope(by_market: DataFrame, star: Star, *by) -> DataFrame:
    """Totals per market summed per state, and over all states with a state_id of NULL."""
    states = by_market.join(_state_markets(star, None).select("market_id", "state_id"), "market_id")
    totals = [F.sum("total").alias("total"), F.sum("n").alias("n")]
    by_state = states.groupBy("state_id", *by).agg(*totals)
    scopes = F.explode(F.array("state_id", F.lit(None).cast("int"))).alias("state_id")
    return by_state.select(scopes, *by, "total", "n").groupBy("state_id", *by).agg(*totals)


def trend_by_state(star: Star, days: int = 14) -> DataFrame:
    """price_trend of every state and of all together (state_id NULL)."""
    recent = _totals(between_days(star.fact, _latest(star, days)), "date_id", "market_id")
    price = round_half_even(ratio_of(F.col("total"), F.col("n")), 2)
    return _by_scope(recent, star, "date_id").select(
        "state_id", F.date_from_unix_date("date_id").alias("arrival_date"), price.alias("price")
    )


def top_by_state(star: Star, k: int = 5) -> DataFrame:
    """top_commodities of every state and of all together (state_id NULL), with their rank."""
    by_id = _totals(_latest_facts(star), "commodity_id", "market_id")
    names = star.commodity_dim.select("commodity_id", "commodity")
    by_name = by_id.join(names, "commodity_id").groupBy("commodity", "market_id").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    most = W.partitionBy("state_id").orderBy(F.desc("n"), "commodity")
    ranked = _by_scope(by_name, star, "commodity").withColumn("rank", F.row_number().over(most))
    return ranked.filter(F.col("rank") <= k).select(
        "state_id", "rank", "commodity",
        round_half_even(ratio_of(F.col("total"), F.col("n")), 2).alias("avg_price"),
        F.col("n").alias("report_count"),
    )


def priciest_commodities(star: Star, k: int = 10) -> DataFrame:
    """The k names of the highest average modal price over all dates."""
    by_id = figures(star, "commodity_id").join(star.commodity_dim, "commodity_id")
    averages = by_id.groupBy("commodity").agg(
        ratio_of(F.sum("total"), F.sum("n")).alias("avg_price")
    )
    return averages.orderBy(F.desc("avg_price"), "commodity").limit(k)


def monthly_trend(star: Star) -> DataFrame:
    """Average modal price per name and calendar month over all years, as (month, price)."""
    by_id = figures(star, "commodity_id", "month").withColumnRenamed("month", "month_number")
    name = F.date_format(F.make_date(F.lit(2000), F.col("month_number"), F.lit(1)), "MMM")
    return (
        by_id.join(star.commodity_dim, "commodity_id")
        .groupBy("commodity", "month_number")
        .agg(ratio_of(F.sum("total"), F.sum("n")).alias("modal_price"))
        .select("commodity", "month_number", name.alias("month"), "modal_price")
    )


def trend_lists(monthly: DataFrame) -> DataFrame:
    """monthly_trend with one row per name: an array of at most 12 (month, price)."""
    months = F.sort_array(F.collect_list(F.struct("month_number", "month", "modal_price")))
    return monthly.groupBy("commodity").agg(
        F.transform(months, lambda m: F.struct(m.month.alias("month"), m.modal_price.alias("modal_price"))).alias("trend")
    )
