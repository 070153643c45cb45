"""Streams of quotes against the batch operators over the same rows."""

import random
from decimal import Decimal

from harvestlens.operators import fact, forecast
from harvestlens.streaming import daily_price, series
from pyspark.sql import functions as F

SCHEMA = "date_id int, market_id int, commodity_id int, min_price decimal(12,2), max_price decimal(12,2), modal_price decimal(12,2), place long"
ORDER, KEYS = ["place"], ["market_id", "commodity_id"]


def some_quotes(n, seed=5):
    """Half of all rows are of one series; days in any order, equal places, NULL in each column."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        market, commodity = (1, 1) if i % 2 else (draw.randrange(1, 6), draw.randrange(1, 4))
        prices = [Decimal(draw.randrange(100, 999)).scaleb(-2) for _ in range(3)]
        row = [19700 + draw.randrange(40), market, commodity, *prices, draw.randrange(n // 4)]
        if i % 50 == 0:
            row[(i // 50) % len(row)] = None
        rows.append(tuple(row))
    return rows


def run(spark, source, stream_of, keys, folder):
    """All new files, one a batch, from where the last run ended; returns the newest state of each key."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    updates = stream_of(stream)
    query = daily_price.write_updates(updates, str(folder / "updates"), str(folder / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    return daily_price.read_updates(spark, str(folder / "updates"), updates.schema, keys)


def in_order(rows):
    return sorted(map(repr, rows.collect()))


def test_first_quotes_and_buffers_follow_a_stream(spark, tmp_path):
    source, rows = tmp_path / "quotes", some_quotes(600)
    first_quotes = lambda s: series.stream_first_quotes(s, ORDER, "4000 days")
    dated = lambda s: s.withColumn("arrival_date", F.date_from_unix_date("date_id"))
    buffers = lambda s: series.stream_latest_buffer(dated(s), KEYS, ORDER)
    for part in (rows[:400], rows[400:]):  # the second run goes on from the checkpoint
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(str(source))
        quotes = spark.read.schema(SCHEMA).parquet(str(source))
        fact_rows = fact.build_fact(quotes, ORDER)
        got = run(spark, source, first_quotes, fact.FACT_KEYS, tmp_path / "first")
        assert in_order(got) == in_order(fact_rows.select(*got.columns))
        known = quotes.dropna(subset=["date_id", *KEYS, "modal_price", *ORDER])
        points = fact.first_per_key(known, ["date_id", *KEYS], ["place", "modal_price"], ["modal_price"])
        got = run(spark, source, buffers, KEYS, tmp_path / "buffers")
        assert in_order(got) == in_order(forecast.latest_buffer(dated(points), KEYS).select(*got.columns))
        assert got.count() == 15
    state = spark.read.format("statestore").load(str(tmp_path / "buffers/checkpoint"))
    assert state.count() == 15


def test_closed_days_leave_the_state(spark, tmp_path):
    """Quotes of days beyond the lateness are dropped, and so is their state."""
    source, price = tmp_path / "quotes", Decimal("5.00")
    first_quotes = lambda s: series.stream_first_quotes(s, ORDER, "2 days")
    for day, place in ((19700, 5), (19710, 1), (19700, 1), (19709, 1)):
        spark.createDataFrame([(day, 1, 1, price, price, price, place)], SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        got = run(spark, source, first_quotes, fact.FACT_KEYS, tmp_path / "first")
    assert sorted(r.date_id for r in got.collect()) == [19700, 19709, 19710]
    state = spark.read.format("statestore").load(str(tmp_path / "first/checkpoint"))
    assert sorted(r.key.date_id for r in state.collect()) == [19709, 19710]


def test_streams_without_rows(spark, tmp_path):
    source = tmp_path / "quotes"
    spark.createDataFrame([(None,) * 7], SCHEMA).coalesce(1).write.parquet(str(source))
    dated = lambda s: s.withColumn("arrival_date", F.date_from_unix_date("date_id"))
    buffers = lambda s: series.stream_latest_buffer(dated(s), KEYS, ORDER)
    assert run(spark, source, buffers, KEYS, tmp_path / "buffers").count() == 0
