"""The usage summary: the fact summed per month, market and commodity.

A stored star keeps it next to the fact (`StarStore`), so counts, sums, lowest and highest prices over all days, and the
months that hold the newest rows of a selection, come without the fact. A star without one (`usage` is None) answers
the same questions from its fact.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.sources.star_store import Star
from harvestlens.sources.summary import dated, month_number, of_facts, of_summaries


def ids_in_use(star: Star) -> DataFrame:
    """Rows whose market_id and commodity_id are those with facts, repeated as it comes: the summary, or the fact."""
    return star.fact if star.usage is None else star.usage


def figures(star: Star, *by: str) -> DataFrame:
    """n, total, low and high over all days per `by`: any of year, month, market_id and commodity_id."""
    if star.usage is None:
        return dated(star.fact).groupBy(*by).agg(*of_facts())
    return star.usage.groupBy(*by).agg(*of_summaries())


def distinct_ids(star: Star, places: DataFrame, by: str) -> DataFrame:
    """Per `by` of `places` (market_id, by): facts, and exact numbers of distinct commodities and markets with facts.

    Ids are dense, so each set is a bitmap per 32,768 ids. Tasks merge their bitmaps before the shuffle, which moves at most
    one of 4 KB per task, `by` and 32,768 ids, and no (market, commodity) pairs. Without a summary the pairs are counted first,
    since the bitmaps sort what they read.
    """
    rows = figures(star, "market_id", "commodity_id") if star.usage is None else star.usage
    of = lambda kind, c, n: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("id"), n.alias("n"))
    entries = F.array(of("commodity", "commodity_id", F.col("n")), of("market", "market_id", F.lit(0).cast("long")))
    ids = rows.join(places.select("market_id", by), "market_id").select(by, F.explode(entries).alias("entry")).select(by, "entry.*")
    maps = ids.groupBy(by, "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids"), F.sum("n").alias("n")
    )
    size = lambda kind: F.sum(F.when(F.col("kind") == kind, F.bitmap_count("ids")).otherwise(0))
    return maps.groupBy(by).agg(
        F.sum("n").alias("total_records"), size("commodity").alias("total_commodities"), size("market").alias("total_markets")
    )


def since_newest(star: Star, selected: DataFrame | None, rows: int, keys: list[str]) -> DataFrame:
    """The fact from the month on that holds the newest `rows` rows of every key among `selected` rows of the summary.

    Without keys the selection counts as one. The window orders at most one row per key and calendar month. The limit is a
    scalar subquery over the month folders, so folders of earlier months are not opened. Without a summary to select from (None): the whole fact.
    """
    if selected is None:
        return star.fact
    number = month_number(F.col("year"), F.col("month")).alias("number")
    per_month = selected.groupBy(*keys, number).agg(F.sum("n").alias("n"))
    newest = W.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("number"))
    later = F.sum("n").over(newest) - F.col("n")
    needed = per_month.withColumn("later", later).filter(F.col("later") < rows)
    first = needed.agg(F.min("number").alias("number"))
    return star.fact.filter(month_number(F.col("year"), F.col("month")) >= first.scalar())
