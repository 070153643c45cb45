"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Names without a prefix run from the raw tables, deduplicating the fact each time. Names
with `star_` run on a stored star (written once, timed as `star_load`), as the daily
queries do. Each query's time is the better of two runs into a sink that keeps nothing; `load_quotes`, the
whole load from raw quotes into a new store, runs once.
"""

import json
import os
import time

from harvestlens.operators import explorer, features, forecast, overview
from harvestlens.plans.inference import forecast_series
from harvestlens.queries import MODULES
from harvestlens.session import build_session, scratch_path
from harvestlens.sources.star_store import StarStore
from harvestlens.sources.tables import TradeTables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())

RAW = [
    "state_pricing", "price_trend_14d", "top5_commodities", "gainers_losers", "denormalised_view",
    "price_quartiles", "clean_quotes", "feature_matrix", "baseline_eval", "recursive_forecast",
    "variety_comparison_by_market", "fit_price_model", "constraint_audit", "overview_documents",
]


def star_queries(store: StarStore) -> dict:
    series = lambda: features.fact_series(store.star())
    return {
        "star_state_pricing": lambda: overview.state_pricing(store.star()),
        "star_price_trend": lambda: overview.price_trend(store.star()),
        "star_top_commodities": lambda: overview.top_commodities(store.star()),
        "star_gainers_losers": lambda: overview.gainers_losers(store.star()),
        "star_overview_kpis": lambda: overview.overview_kpis(store.star()),
        "star_overview_by_state": lambda: overview.overview_by_state(store.star()),
        "star_price_history": lambda: explorer.price_history(
            explorer.dynamic_filter(store.star(), commodity="PROMO", market_id=7)
        ),
        "star_feature_matrix": lambda: features.feature_matrix(series()),
        "star_forecast": lambda: forecast_series(
            series(), store.star().model_evaluation, forecast.mean_of_week
        ),
    }


def load_star(spark) -> StarStore:
    store, tables = StarStore(spark, scratch_path(spark, "bench")), TradeTables(spark, SF_DIR)
    for name in ("state_dim", "market_dim", "commodity_dim", "date_dim"):
        store.append(name, getattr(tables, name))
    prices = ("min_price", "max_price", "modal_price")
    store.append_fact(tables.fact.withColumns({c: tables.fact[c].cast("decimal(12,2)") for c in prices}))
    return store


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "harvestlens-bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = {name: query for module in MODULES for name, query in module.QUERIES.items()}
    run = lambda df: df.write.format("noop").mode("overwrite").save()

    queries = {}
    for name in RAW:
        queries[name] = min(timed(lambda: run(registered[name](spark, SF_DIR))) for _ in range(2))
    queries["load_quotes"] = timed(lambda: run(registered["load_accounting"](spark, SF_DIR)))
    stores = []
    queries["star_load"] = timed(lambda: stores.append(load_star(spark)))
    for name, query in star_queries(stores[0]).items():
        queries[name] = min(timed(lambda: run(query())) for _ in range(2))
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(os.path.normpath(SF_DIR)),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
