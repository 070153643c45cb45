"""Quote cleaning, in the order the daily load applies it.

Each step is DataFrame -> DataFrame. A batch is one arrival day, so the outlier fences
are taken per day unless other group columns are given.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlens.constants import PRICE_COLUMNS, QUOTE_COLUMNS
from harvestlens.functions import dates, text
from harvestlens.functions.quantiles import group_quartiles, iqr_fences
from harvestlens.schemas import RAW_PRICE
from harvestlens.sources.lookups import state_aliases
from harvestlens.sources.star_store import between_days

BATCH = ["arrival_date"]


def rename_quotes(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(QUOTE_COLUMNS)


def parse_arrival_date(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("arrival_date", dates.parse_day_first(F.col("arrival_date")))


def type_prices(quotes: DataFrame) -> DataFrame:
    """Price text as decimals; text that is no number becomes NULL."""
    return quotes.withColumns({c: F.col(c).try_cast(RAW_PRICE) for c in PRICE_COLUMNS})


def type_quotes(quotes: DataFrame) -> DataFrame:
    """Date and prices of renamed quotes, with every text parsed once.

    Spark moves later filters on the date or the prices below a projection and would parse
    the texts again for each of them. It does not move them below a generator, so the
    typed row comes out of an array of one.
    """
    typed = {"arrival_date": dates.parse_day_first(F.col("arrival_date"))}
    typed |= {c: F.col(c).try_cast(RAW_PRICE) for c in PRICE_COLUMNS}
    return below_filters(quotes.select(*[typed.get(c, F.col(c)).alias(c) for c in quotes.columns]))


def below_filters(quotes: DataFrame) -> DataFrame:
    """The rows out of an array of one, a generator, below which Spark moves no later filter."""
    row = F.struct(*[F.col(c).alias(c) for c in quotes.columns])
    return quotes.select(F.explode(F.array(row)).alias("quote")).select("quote.*")


def drop_bad_dates(quotes: DataFrame) -> DataFrame:
    return quotes.dropna(subset=["arrival_date"])


def dedup_rows(quotes: DataFrame, keep_first: str | None = None) -> DataFrame:
    """Drop full-row duplicates; with `keep_first`, the smallest value of that column stays."""
    if keep_first is None:
        return quotes.dropDuplicates()
    columns = [c for c in quotes.columns if c != keep_first]
    return quotes.groupBy(*columns).agg(F.min(keep_first).alias(keep_first))


def dropna_any(quotes: DataFrame) -> DataFrame:
    return quotes.dropna("any")


def nonneg_prices(quotes: DataFrame) -> DataFrame:
    return quotes.filter(" AND ".join(f"{c} >= 0" for c in PRICE_COLUMNS))


def price_quartiles(quotes: DataFrame, group: list[str] = BATCH) -> DataFrame:
    """Exact q1 and q3 of the modal price per batch, all commodities together. Days are few: a group per calendar day."""
    return group_quartiles(quotes, group, "modal_price", few_groups=group == BATCH)


def fences_of(quotes: DataFrame, group: list[str]) -> DataFrame:
    """The modal price's fences per batch. Those of days, a row per calendar day, are sent to the quotes, which stay where they are."""
    fences = iqr_fences(price_quartiles(quotes, group), group)
    return F.broadcast(fences) if group == BATCH else fences


def iqr_outlier_filter(quotes: DataFrame, group: list[str] = BATCH) -> DataFrame:
    """Keep rows whose three prices all lie within the modal price's fences, inclusive."""
    prices = [F.col(c) for c in PRICE_COLUMNS]
    inside = (F.least(*prices) >= F.col("lower_fence")) & (F.greatest(*prices) <= F.col("upper_fence"))
    kept = quotes.join(fences_of(quotes, group), group).dropna(subset=PRICE_COLUMNS).filter(inside)
    return kept.select(*quotes.columns)


def base_commodity(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("commodity", text.base_name(F.col("commodity")))


def translate_commodity(quotes: DataFrame, name_map: DataFrame) -> DataFrame:
    """English name by one lookup (targets may be keys again); unmapped names stay.

    A name with several targets goes to the first by name, so no quote is multiplied. The map's
    side is broadcast only if Spark finds it small.
    """
    one = name_map.groupBy(F.col("raw_name").alias("commodity")).agg(F.min("english_name").alias("english_name"))
    mapped = quotes.join(one, "commodity", "left")
    return mapped.withColumn("commodity", F.coalesce("english_name", "commodity")).select(*quotes.columns)


def clean_text(quotes: DataFrame) -> DataFrame:
    columns = ["state", "district", "market", "variety", "grade"]
    return quotes.withColumns({c: text.clean_text(F.col(c)) for c in columns})


def canonical_state(quotes: DataFrame) -> DataFrame:
    aliases = F.broadcast(state_aliases(quotes.sparkSession))  # 16 rows
    matched = quotes.join(aliases, "state", "left")
    return matched.withColumn("state", F.coalesce("canonical", "state")).select(*quotes.columns)


def date_parts(quotes: DataFrame) -> DataFrame:
    day = F.col("arrival_date")
    return quotes.withColumns({
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "weekday": dates.weekday_name(day),
    })


def price_order_check(quotes: DataFrame) -> DataFrame:
    return quotes.filter("min_price <= modal_price AND modal_price <= max_price")


def skip_loaded_days(quotes: DataFrame, fact: DataFrame) -> DataFrame:
    """Drop rows of days that already have a fact, tested row by row.

    Only fact rows within the batch's date range are looked at, and only their dates. Give it
    the batch's days, not its texts: it reads them three times.
    """
    days = quotes.select("arrival_date").dropna()
    first, last = days.orderBy("arrival_date").limit(1), days.orderBy(F.desc("arrival_date")).limit(1)
    near = between_days(fact, first, last)
    loaded = near.select("date_id").distinct().select(
        F.date_from_unix_date("date_id").alias("arrival_date")
    )
    return quotes.join(loaded, "arrival_date", "left_anti")


def clean_values(
    quotes: DataFrame, keep_first: str | None = None, keep: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Duplicates, NULLs, signs and outliers: the steps on typed, dated quotes.

    Quotes and their fences come from the same deduplicated rows: `keep` writes these once and reads them. Without
    it, later filters stay above, so that both come from the same shuffle of the quotes.
    """
    signed = nonneg_prices(dropna_any(dedup_rows(quotes, keep_first)))
    return iqr_outlier_filter(keep(signed)) if keep else below_filters(iqr_outlier_filter(signed))


def fault_of_values() -> Column:
    """Why the value steps drop a quote by itself: a bad line, a NULL, a negative price; else NULL."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in QUOTE_COLUMNS.values()])
    negative = reduce(Column.__or__, [F.col(c) < 0 for c in PRICE_COLUMNS])
    return (
        F.when(F.col("corrupt").isNotNull(), "corrupt line").when(missing, "missing value").when(negative, "negative price")
    )


def judge_quotes(quotes: DataFrame, name_map: DataFrame, states: DataFrame, group: list[str] = BATCH) -> DataFrame:
    """clean_quotes on deduplicated quotes with `fault`, keeping all rows: `fault` says which step drops a row.

    Fences come from the rows without a fault, as in `clean_values`. Quotes of states outside `states` are at fault too; the others get their
    state_id.
    """
    fences = fences_of(quotes.filter("fault IS NULL"), group)
    inside = reduce(Column.__and__, [F.col(c).between(F.col("lower_fence"), F.col("upper_fence")) for c in PRICE_COLUMNS])
    fenced = quotes.join(fences, group, "left").withColumn("fault", F.coalesce("fault", F.when(~inside, "outlier")))
    named = canonical_state(clean_text(translate_commodity(base_commodity(fenced.select(*quotes.columns)), name_map)))
    ordered = F.expr("min_price <= modal_price AND modal_price <= max_price")
    known = named.join(states.select("state", "state_id"), "state", "left")
    return known.withColumn("fault", F.coalesce(
        "fault", F.when(~ordered, "price order"), F.when(F.col("state_id").isNull(), "unknown state")
    ))


def clean_names(quotes: DataFrame, name_map: DataFrame) -> DataFrame:
    """Commodity, place and grade names, then the price order check."""
    named = translate_commodity(base_commodity(quotes), name_map)
    return price_order_check(canonical_state(clean_text(named)))


def clean_quotes(raw: DataFrame, name_map: DataFrame) -> DataFrame:
    """All cleaning steps on raw text quotes that share one header."""
    return clean_names(clean_values(drop_bad_dates(type_quotes(rename_quotes(raw)))), name_map)
