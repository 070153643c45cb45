"""Nested documents as JSON text: the overview and the explorer."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.constants import PRICE_COLUMNS
from harvestlens.functions.numeric import round_half_even
from harvestlens.operators import explorer, overview
from harvestlens.sources.star_store import Star

_ISO = "yyyy-MM-dd"


def _cents(columns: list[str]) -> list[Column]:
    return [round_half_even(F.col(c).cast("double"), 2).alias(c) for c in columns]


def _list(rows: DataFrame, order: str, *fields) -> Column:
    """A bounded table as an array column, in the order of `order`."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), *fields)))
    return rows.agg(F.transform(ordered, lambda r: r.dropFields("_order")).alias("list")).scalar()


def _kpis(latest: Column) -> Column:
    return F.struct(
        F.col("avg_price").alias("avgPrice"),
        F.col("total_records").alias("totalRecords"),
        F.col("total_states").alias("totalStates"),
        F.col("total_markets").alias("totalMarkets"),
        F.col("total_commodities").alias("totalCommodities"),
        F.col("total_models").alias("totalModels"),
        F.col("forecast_trust").alias("forecastTrust"),
        F.date_format(latest, _ISO).alias("latestDate"),
    ).alias("kpis")


def _pricing(star: Star) -> Column:
    entries = F.struct(F.col("state_id").cast("string"), F.struct("state_name", "avg_price", "record_count"))
    return overview.state_pricing(star).agg(F.map_from_entries(F.sort_array(F.collect_list(entries))).alias("pricing")).scalar()


def overview_document(star: Star, state: str | None = None) -> DataFrame:
    """One JSON document. Its lists have one entry per state, per day of the trend, or five."""
    kpis = overview.overview_kpis(star, state).select(_kpis(F.col("latest_date")))
    trend = _list(
        overview.price_trend(star, state=state), "arrival_date",
        F.date_format("arrival_date", _ISO).alias("date"), "price",
    )
    ranked = overview.top_commodities(star, state=state).withColumn("fewest", -F.col("report_count"))
    top = ranked.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("fewest", "commodity", "avg_price", "report_count"))),
            lambda r: r.dropFields("fewest"),
        ).alias("top")
    ).scalar()
    movers = overview.gainers_losers(star, state)
    document = F.struct(
        kpis.scalar().alias("kpis"),
        _pricing(star).alias("statePricing"),
        trend.alias("nationalTrend"),
        top.alias("topCommodities"),
        movers.select("gainers").scalar().alias("gainersCount"),
        movers.select("losers").scalar().alias("losersCount"),
    )
    return star.state_dim.sparkSession.range(1).select(F.to_json(document).alias("document"))


def overview_documents(star: Star) -> DataFrame:
    """overview_document of every state and of all together (state NULL), in one plan.

    Facts are summed once per figure for all states; a document's lists have the bounds they have alone.
    """
    scope = F.coalesce("state_id", F.lit(overview.ALL_STATES))
    point = F.struct("arrival_date", F.date_format("arrival_date", _ISO).alias("date"), "price")
    trends = overview.trend_by_state(star).groupBy(scope.alias("scope")).agg(
        F.transform(F.sort_array(F.collect_list(point)), lambda p: p.dropFields("arrival_date")).alias("trend")
    )
    entry = F.struct("rank", "commodity", "avg_price", "report_count")
    tops = overview.top_by_state(star).groupBy(scope.alias("scope")).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e.dropFields("rank")).alias("top")
    )
    figures = overview.overview_by_scope(star).withColumn("scope", scope)
    no_points, no_names = "array<struct<date:string,price:double>>", "array<struct<commodity:string,avg_price:double,report_count:bigint>>"
    document = F.struct(
        _kpis(overview.latest_date(star).scalar()),
        _pricing(star).alias("statePricing"),
        F.coalesce("trend", F.array().cast(no_points)).alias("nationalTrend"),
        F.coalesce("top", F.array().cast(no_names)).alias("topCommodities"),
        F.col("gainers").alias("gainersCount"),
        F.col("losers").alias("losersCount"),
    )
    return figures.join(trends, "scope", "left").join(tops, "scope", "left").select("state", F.to_json(document).alias("document"))


def explorer_documents(star: Star) -> DataFrame:
    """One JSON document per market and name: at most 90 history rows, and the varieties.

    The comparison has one entry per variety and grade of a name.
    """
    keys = ["market_id", "commodity"]
    named = star.fact.join(star.commodity_dim.select("commodity_id", "commodity"), "commodity_id")
    history = explorer.with_volume(explorer.price_history_by(named, keys), keys)
    point = F.struct(
        "date_id", "commodity_id",
        F.date_format("arrival_date", _ISO).alias("date"),
        *_cents(PRICE_COLUMNS),
        F.col("synthetic_volume").alias("arrival_volume"),
    )
    histories = history.groupBy(*keys).agg(
        F.transform(
            F.sort_array(F.collect_list(point)), lambda p: p.dropFields("date_id", "commodity_id")
        ).alias("history")
    )
    compared = explorer.compared(star).withColumns({
        "cheapness": -F.col("average"), "avg_price": round_half_even(F.col("average"), 2)
    })
    varieties = compared.groupBy(*keys).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(
                "cheapness", "variety", "grade", "avg_price", *_cents(["max_price", "min_price"])
            ))),
            lambda v: v.dropFields("cheapness"),
        ).alias("varietyComparison")
    )
    return histories.join(varieties, keys).select(
        *keys, F.to_json(F.struct("history", "varietyComparison")).alias("document")
    )


def explorer_document(
    star: Star, commodity: str | None = None, state_id: int | None = None,
    district: str | None = None, market_id: int | None = None,
) -> DataFrame:
    """One JSON document of any selection; without rows its lists are empty.

    The history has the newest 90 rows. Varieties are compared only if a name and a market are selected.
    """
    newest = explorer.history_of(star, commodity=commodity, state_id=state_id, district=district, market_id=market_id)
    point = [F.date_format("arrival_date", _ISO).alias("date"), *_cents(PRICE_COLUMNS), F.col("synthetic_volume").alias("arrival_volume")]
    place = F.struct(*explorer.ROW_ORDER).alias("place")
    history = _list(explorer.with_volume(newest, []).withColumn("place", place), "place", *point)
    entries = "array<struct<variety:string,grade:string,avg_price:double,max_price:double,min_price:double>>"
    varieties = F.array().cast(entries)
    if commodity and market_id is not None:
        one = explorer.compared(star).filter((F.col("market_id") == market_id) & (F.col("commodity") == commodity))
        dearest = F.struct(-F.col("average"), "variety", "grade").alias("place")
        average = round_half_even(F.col("average"), 2).alias("avg_price")
        varieties = _list(
            one.withColumn("place", dearest), "place", "variety", "grade", average, *_cents(["max_price", "min_price"])
        )
    document = F.struct(history.alias("history"), varieties.alias("varietyComparison"))
    return star.market_dim.sparkSession.range(1).select(F.to_json(document).alias("document"))
