"""The fact and the forecast buffers kept up to date by a stream of quotes, whatever the order in which quotes arrive."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from harvestlens.constants import BUFFER_ROWS, PRICE_COLUMNS
from harvestlens.operators.fact import FACT_KEYS


def stream_first_quotes(stream: DataFrame, order: list[str], lateness: str) -> DataFrame:
    """The first quote by `order` per (date, market, commodity), as a stream of updates.

    stream: FACT_KEYS, prices and the columns of `order`; as in `build_fact`, rows with NULL among keys and prices drop out. A minimum over structs: tasks send one row per key and batch, so a hot key costs
    no more than others. A day's state goes when the newest day is `lateness` beyond it; quotes that come later still are dropped.
    """
    complete = stream.dropna(subset=[*FACT_KEYS, *PRICE_COLUMNS])
    timed = complete.withColumn("at", F.date_from_unix_date("date_id").cast("timestamp")).withWatermark("at", lateness)
    ranked = F.struct(*order, *[c for c in PRICE_COLUMNS if c not in order])
    first = timed.groupBy("at", *FACT_KEYS).agg(F.min(ranked).alias("first"))
    return first.select(*FACT_KEYS, *[F.col(f"first.{c}").alias(c) for c in PRICE_COLUMNS])


def newest_points(points: pd.DataFrame, keys: list[str], order: list[str], rows: int) -> pd.DataFrame:
    """The first point by `order`, then price, of each of the newest `rows` days per key, oldest first."""
    ranked = points.sort_values([*keys, "day", *order, "cents"], kind="stable")
    first = ranked.drop_duplicates([*keys, "day"])
    return first.groupby(keys, sort=False).tail(rows) if keys else first.tail(rows)


def stream_latest_buffer(stream: DataFrame, keys: list[str], order: list[str], rows: int = BUFFER_ROWS) -> DataFrame:
    """The newest days of each series with their first quotes, as updates of the series that a batch touches.

    stream: `keys`, arrival_date, modal_price in whole cents or coarser, and `order`; rows with NULL in these drop out. Returns what
    `forecast.latest_buffer` does. A series' state is its newest `rows` days with the quote that is first so far: a day that fell out never
    comes back, so this is exact for quotes and days in any order, without a watermark. Within a batch, tasks first keep
    that much of every series that they hold, so a hot series sends few rows to the task that keeps its state.
    """
    own = {f.name: f.dataType for f in stream.schema.fields}
    quotes = stream.dropna(subset=[*keys, "arrival_date", "modal_price", *order]).select(
        *keys, F.unix_date("arrival_date").alias("day"), (F.col("modal_price") * 100).cast("long").alias("cents"), *order
    )
    held = ["day", "cents", *order]

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield newest_points(batch, keys, order, rows)

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        points = pd.DataFrame(dict(zip(held, map(list, state.get), strict=True))) if state.exists else None
        for batch in batches:
            known = batch[held] if points is None else pd.concat([points, batch[held]])
            points = newest_points(known, [], order, rows)
        state.update(tuple(points[c].tolist() for c in held))
        days, cents = points["day"].tolist(), points["cents"].tolist()
        yield pd.DataFrame({
            **{name: [value] for name, value in zip(keys, key, strict=True)},
            "n_rows": [len(days)], "last_day": [days[-1]], "cents": [cents],
        })

    kept = T.StructType([T.StructField(c, T.ArrayType(quotes.schema[c].dataType)) for c in held])
    result = T.StructType([
        *[T.StructField(c, own[c]) for c in keys], T.StructField("n_rows", T.IntegerType()),
        T.StructField("last_day", T.IntegerType()), T.StructField("cents", T.ArrayType(T.LongType())),
    ])
    buffers = quotes.mapInPandas(combine, quotes.schema).groupBy(*keys).applyInPandasWithState(
        update, result, kept, "update", GroupStateTimeout.NoTimeout
    )
    prices = F.transform("cents", lambda c: c.cast("double") / 100)
    return buffers.select(
        *keys, "n_rows", F.date_from_unix_date("last_day").alias("last_date"),
        F.element_at(prices, -1).alias("last_price"), prices.alias("prices"),
    )
