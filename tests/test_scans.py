"""What the queries over the trade tables read, write and move, on tables of a few rows."""

import datetime
import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harvestlens.functions import quantiles
from harvestlens.operators import fact
from harvestlens.queries import cleaning as cleaning_queries
from harvestlens.queries import forecast as forecast_queries
from harvestlens.queries import sources as source_queries
from harvestlens.queries import star as star_queries
from harvestlens.queries import stored
from harvestlens.queries import streaming as streaming_queries
from harvestlens.sources import daily_files
from harvestlens.sources.star_store import StarStore
from harvestlens.sources.tables import QUOTE_ORDER, SCHEMAS, TradeTables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trade_dir(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("trade")
    day = lambda i: datetime.datetime(2021, 1, 1) + datetime.timedelta(days=i)
    rows = {
        "region": [(i, name) for i, name in enumerate(["AFRICA", "ASIA"])],
        "nation": [(i, f"NATION {i}", i % 2) for i in range(3)],
        "supplier": [(i, f"s{i}", i % 3, 0.0) for i in range(4)],
        "part": [(i, f"p{i}", f"Brand#{i % 2}", ["PROMO", "SMALL"][i % 2], 10 + 20 * (i % 2), 1.0) for i in range(6)],
        "lineitem": [
            (i // 3, i % 6, i % 4, i % 3 + 1, 1.0, 100.0 + i % 17, 0.05, 0.02, "N", "O", day(i % 40)) for i in range(240)
        ],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_rows_of_a_task_are_sorted_by_the_hash_of_their_key(spark):
    rows = spark.createDataFrame([(1, "a", 3, 5), (1, "a", 2, 7), (None, "a", 1, 9), (1, "b", None, 4), (1, "b", 0, 1)], "k int, t string, o int, v int")
    first = fact.first_per_key(rows, ["k", "t"], ["o"], ["v"])
    assert sorted(map(tuple, first.collect()), key=str) == sorted([(1, "a", 7), (None, "a", 9), (1, "b", 4)], key=str)
    sorts = [line for line in plan_of(first).splitlines() if "Sort [" in line]
    assert sorts and all("Sort [key_hash" in line or "Sort [xxhash64" in line or "Sort [_groupingexpression" in line for line in sorts)


def test_what_cannot_change_the_first_row_is_not_read(spark):
    """Rows that tie up to the price have that price; the other prices behind it are not computed."""
    rows = spark.createDataFrame(
        [(1, 5, 1, "2.00", "1.00", "9.00"), (1, 4, 2, "3.00", "1.00", "9.00"), (1, 4, 2, "2.50", "8.00", "9.00"), (2, 4, 2, None, "8.00", "9.00")],
        "k int, l_orderkey int, l_linenumber int, modal_price string, min_price string, max_price string",
    )
    rows = rows.select("k", "l_orderkey", "l_linenumber", *[F.col(c).cast("decimal(12,2)").alias(c) for c in QUOTE_ORDER[2:]])
    first = fact.first_per_key(rows, ["k"], QUOTE_ORDER, ["modal_price"])
    assert sorted(map(tuple, first.collect())) == [(1, Decimal("2.50")), (2, None)]
    aggregates = [line for line in plan_of(first).splitlines() if "Aggregate" in line]
    assert aggregates and not any("min_price" in line for line in aggregates)


def test_metrics_of_a_written_star_come_from_the_written_fact(spark, trade_dir, monkeypatch):
    read, upsert = [], StarStore.upsert
    monkeypatch.setattr(StarStore, "upsert", lambda store, table, rows, keys: (read.extend(rows.inputFiles()), upsert(store, table, rows, keys)))
    star = stored.written(spark, trade_dir).star()
    assert read and not any("lineitem" in name for name in read)
    assert star.model_evaluation.count() > 0


def test_a_forecast_reads_the_series_its_models_learnt_from(spark, trade_dir, monkeypatch):
    seen = []

    def captured(rows, evaluations, **kwargs):
        seen.append(rows)
        return rows

    monkeypatch.setattr(forecast_queries, "forecast_series", captured)
    monkeypatch.setattr(forecast_queries.models, "fit_boosted", lambda *args, **kwargs: None)
    forecast_queries.recursive_forecast_boosted(spark, trade_dir)
    forecast_queries.recursive_forecast_models(spark, trade_dir)
    assert len(seen) == 2 and not any("lineitem" in name for rows in seen for name in rows.inputFiles())


@pytest.mark.parametrize("query, columns", [
    ("build_state_dim", {"state"}),
    ("build_commodity_dim", {"state", "commodity", "variety", "grade"}),
    ("build_date_dim", {"state", "arrival_date"}),
])
def test_a_dimension_writes_the_columns_of_the_quotes_that_it_reads(spark, trade_dir, monkeypatch, query, columns):
    kept, write = [], star_queries.write_and_read
    monkeypatch.setattr(star_queries, "write_and_read", lambda df, name: (kept.append({*df.columns}), write(df, name))[1])
    assert getattr(star_queries, query)(spark, trade_dir).count() > 0
    assert kept == [columns]


def test_quotes_get_their_ids_without_a_shuffle(spark, trade_dir):
    """States, commodities and markets are small, and Spark knows that before it shuffles quotes for the joins."""
    plan = plan_of(star_queries.keyed_quotes(spark, trade_dir))
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("query, columns", [
    ("build_state_dim", {"state"}),
    ("build_date_dim", {"state"}),
    ("build_commodity_dim", {"state", "commodity", "variety", "grade"}),
])
def test_quotes_behind_the_duplicate_step_are_written_once(spark, trade_dir, monkeypatch, query, columns):
    """Fences and quotes come from the written rows; of the texts, those that are read."""
    kept, write = [], cleaning_queries.write_and_read
    monkeypatch.setattr(cleaning_queries, "write_and_read", lambda df, name: (kept.append({*df.columns}), write(df, name))[1])
    assert getattr(star_queries, query)(spark, trade_dir).count() > 0
    assert kept == [columns | {"arrival_date", "min_price", "modal_price", "max_price"}]


def test_quartiles_of_few_groups_shuffle_the_values_near_a_quartile(spark):
    """Of 4000 values per day, those of four ranges at most are counted one by one; both ways agree with numpy."""
    import numpy as np

    rows = [(day, (i * 7919 % 4000) / 4 - day * 100) for day in range(3) for i in range(4000)] + [(9, 5.0), (None, 1.0), (1, None)]
    df = spark.createDataFrame(rows, "day int, p double").select("day", F.col("p").cast("decimal(20,6)").alias("p")).repartition(5)
    expected = {day: tuple(np.quantile([p for d, p in rows if d == day and p is not None], [0.25, 0.75])) for day in (0, 1, 2, 9)}
    few = quantiles.group_quartiles(df, ["day"], "p", few_groups=True)
    for found in (few, quantiles.group_quartiles(df, ["day"], "p")):
        assert {r.day: (float(r.q1), float(r.q3)) for r in found.collect()} == expected
    ranges = df.dropna().withColumn("range", quantiles._value_range(F.col("p"))).groupBy("day", "range").agg(F.count("p").alias("range_n"))
    near = quantiles._ranges_of_quartiles(ranges, ["day"]).join(ranges, ["day", "range"]).agg(F.sum("range_n")).first()[0]
    assert 0 < near < 12001 / 4
    keys = [line for line in plan_of(few).splitlines() if "Exchange hashpartitioning" in line and "p#" in line]
    assert keys and all("range_start" in line for line in keys)


def test_the_stream_lands_gzipped_files(spark, trade_dir, monkeypatch, tmp_path):
    class Landed(Exception):
        pass

    def stop(*args, **options):
        raise Landed

    monkeypatch.setattr(streaming_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(streaming_queries.ingest, "stream_daily_ingest", stop)
    with pytest.raises(Landed):
        streaming_queries.stream_daily_ingest_small_batches(spark, trade_dir)
    names = glob.glob(f"{tmp_path}/landing/**/part-*", recursive=True)
    assert names and all(name.endswith(".csv.gz") for name in names)
    assert daily_files.read_quote_files(spark, str(tmp_path / "landing")).count() == TradeTables(spark, trade_dir).raw_quotes().count()


@pytest.fixture
def days_files(spark, monkeypatch, tmp_path):
    """Where scan_daily_quotes keeps its files, and the quotes that were made for them."""
    made, raw_quotes = spark.sparkContext.accumulator(0), TradeTables.raw_quotes

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def raw(tables):
        quotes = raw_quotes(tables)
        quotes = quotes.withColumn("day", F.when(F.col("Min_Price") != "95.0000", F.date_sub("day", 23 * 365 + 20)))
        return quotes.mapInArrow(counted, quotes.schema)

    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(TradeTables, "raw_quotes", raw)
    return tmp_path, made


def test_both_folders_of_the_scan_come_from_one_pass(spark, trade_dir, days_files):
    """The quotes are made once, the files are gzipped, and days without a file of their own or without a date come from the fallback."""
    folder, made = days_files
    found = source_queries.scan_daily_quotes(spark, trade_dir)
    quotes = TradeTables(spark, trade_dir).raw_quotes()
    assert made.value == 246
    days = {r.day and str(r.day): r["count"] for r in quotes.groupBy("day").count().collect()}
    assert None in days and any(d and d < "1998" for d in days) and any(d and d > "1998" for d in days)
    assert {r.file_day: r["count"] for r in found.groupBy("file_day").count().collect()} == days
    names = glob.glob(f"{folder}/**/part-*", recursive=True)
    assert len(names) > 40 and all(name.endswith(".csv.gz") for name in names)


@pytest.mark.parametrize("held", [False, True])
def test_a_tree_without_quotes_is_there(spark, tmp_path, held):
    quotes = spark.createDataFrame([("a",) * 10] if held else [], ", ".join(f"{c} string" for c in daily_files.QUOTE_COLUMNS))
    roots = {"one": F.lit(True), "two": F.lit(None).cast("boolean"), "three": F.lit(False)}
    daily_files.write_daily_quotes(quotes.withColumn("day", F.lit(datetime.date(2024, 2, 29))), "day", str(tmp_path / "days"), roots=roots)
    counts = [daily_files.read_quote_files(spark, daily_files.root_folder(str(tmp_path / "days"), name)).count() for name in roots]
    assert counts == [int(held), 0, 0]
