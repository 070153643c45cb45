"""The star schema over the supplied trade tables.

lineitem plays the daily quotes: its ship date is the arrival date, the supplier's
nation the market, the region the state, the part's type, brand and size class the
commodity, variety and grade.
"""

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlens.functions import dates
from harvestlens.operators.dimensions import date_dimension, number_keys
from harvestlens.operators.evaluation import persistence_eval
from harvestlens.operators.fact import first_per_key
from harvestlens.operators.features import fact_series
from harvestlens.operators.overview import previous_day
from harvestlens.sources.lookups import name_pairs

# Decides which of several quotes of one day, market and commodity comes first. Rows
# that tie on all of these hold the same prices, so the choice cannot matter.
QUOTE_ORDER = ["l_orderkey", "l_linenumber", "modal_price", "min_price", "max_price"]


# How the five regions are spelled as states in the raw quotes.
RAW_STATES = ["Orissa", "NCT of Delhi", "Jammu & Kashmir", " karnataka", "Keralam"]


# Column types as stored; reading with them saves a look into the files per query.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


class TradeTables:
    """The frames of a star, each built when first asked for.

    With `since`, a date, the fact holds the days from it on; the limit reaches the scan. `lines` are lineitem rows to take
    quotes from in place of the table's, such as a stream of its files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, since: Column | None = None, lines: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.since = since
        self.lines = lines

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions ---------------------------------------------------------------

    @cached_property
    def state_dim(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("int").alias("state_id"), F.col("r_name").alias("state")
        )

    @cached_property
    def market_dim(self) -> DataFrame:
        district = F.concat("r_name", F.lit("-"), (F.col("n_nationkey") % 3).cast("string"))
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("market_id"),
            F.col("n_name").alias("market"),
            district.alias("district"),
            F.col("n_regionkey").cast("int").alias("state_id"),
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        grade = F.when(size <= 16, "Faq").when(size <= 33, "Medium").otherwise("Premium")
        return self.table("part").select(
            "p_partkey",
            F.col("p_type").alias("commodity"),
            F.col("p_brand").alias("variety"),
            grade.alias("grade"),
        )

    @cached_property
    def commodity_dim(self) -> DataFrame:
        triple = ["commodity", "variety", "grade"]
        return number_keys(self.products().select(*triple).distinct(), triple, "commodity_id")

    @cached_property
    def date_dim(self) -> DataFrame:
        days = self.table("lineitem").select(F.to_date("l_shipdate").alias("arrival_date")).distinct()
        return date_dimension(days)

    # -- raw quotes ---------------------------------------------------------------

    def raw_quotes(self) -> DataFrame:
        """lineitem as daily quotes in text form with the usual defects, plus `day`.

        Every quote is kept; a quote's number decides its defect: unknown state, stray
        blanks, missing variety, impossible date, mixed date layouts, negative price,
        price order, outlier, or a second copy.
        """
        nation, region = self.table("nation"), self.table("region")
        place = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("int").alias("market_id"), "n_nationkey", "n_name", "r_regionkey", "r_name"
        )
        parts = self.table("part").select("p_partkey", "p_type", "p_brand", "p_size")
        quotes = self.keyed(parts).join(place, "market_id")
        number = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(40))
        quotes = quotes.withColumn("number", number)
        case = F.col("number")
        states = F.array(*[F.lit(name) for name in RAW_STATES])
        district = F.concat("r_name", F.lit("-"), (F.col("n_nationkey") % 3).cast("string"))
        size = F.col("p_size")
        grade = F.when(size <= 16, "FAQ").when(size <= 33, "Medium").otherwise("premium")
        layout = (
            F.when(case == 14, F.date_format("arrival_date", "yyyy-MM-dd"))
            .when(case % 3 == 0, F.date_format("arrival_date", "dd-MM-yyyy"))
            .otherwise(F.date_format("arrival_date", "dd/MM/yyyy"))
        )
        minimum = F.when(case == 7, -F.col("min_price")).when(case == 8, F.col("max_price") + 1)
        copies = F.when(case == 10, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return quotes.select(
            F.when(case == 1, "Atlantis").otherwise(F.get(states, F.col("r_regionkey"))).alias("State"),
            F.when(case == 11, F.concat(F.lit("  "), F.lower(district), F.lit(" "))).otherwise(district).alias("District"),
            F.lower("n_name").alias("Market"),
            F.when(case % 2 == 0, F.concat(F.lower("p_type"), F.lit(" ("), "p_brand", F.lit(")(x)")))
            .otherwise(F.concat("p_type", F.lit("("), "p_brand", F.lit(")"))).alias("Commodity"),
            F.when(case != 5, F.col("p_brand")).alias("Variety"),
            grade.alias("Grade"),
            F.when(case == 6, "31/02/2025").otherwise(layout).alias("Arrival_Date"),
            F.coalesce(minimum, "min_price").cast("decimal(16,4)").cast("string").alias("Min_Price"),
            F.col("max_price").cast("string").alias("Max_Price"),
            F.when(case == 9, F.col("modal_price") * 50).otherwise(F.col("modal_price"))
            .cast("decimal(16,2)").cast("string").alias("Modal_Price"),
            F.col("arrival_date").alias("day"),
            F.explode(copies).alias("copy"),
        ).drop("copy")

    def name_map_json(self) -> DataFrame:
        """JSON objects {name: English name} for the product types up to M."""
        pair = F.create_map(F.initcap("p_type"), F.concat(F.lower("p_type"), F.lit(" goods")))
        return self.table("part").filter(F.col("p_type") < "N").select(F.to_json(pair).alias("value"))

    def name_map(self) -> DataFrame:
        return self.name_map_json().distinct().select(name_pairs(F.col("value"))).distinct()

    # -- quotes and fact ----------------------------------------------------------

    def lineitem(self) -> DataFrame:
        rows = self.table("lineitem") if self.lines is None else self.lines
        return rows if self.since is None else rows.filter(F.col("l_shipdate") >= self.since)

    def priced(self) -> DataFrame:
        """lineitem with date and exact prices, and its keys."""
        modal = F.col("l_extendedprice").cast("decimal(12,2)")
        day = F.to_date("l_shipdate")
        return self.lineitem().select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            day.alias("arrival_date"),
            dates.date_id(day).alias("date_id"),
            (modal * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(16,4)").alias("min_price"),
            (modal * (1 + F.col("l_tax").cast("decimal(4,2)"))).cast("decimal(16,4)").alias("max_price"),
            modal.alias("modal_price"),
        )

    def keyed(self, commodity: DataFrame) -> DataFrame:
        """Priced quotes with market_id and the columns of `commodity` (keyed by p_partkey)."""
        supplier = self.table("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("int").alias("market_id")
        )
        parts = commodity.withColumnRenamed("p_partkey", "l_partkey")
        return self.priced().join(supplier, "l_suppkey").join(parts, "l_partkey")

    @cached_property
    def fact(self) -> DataFrame:
        """One row per (date, market, commodity): the first quote."""
        triple = ["commodity", "variety", "grade"]
        numbered = self.products().join(self.commodity_dim, triple).select("p_partkey", "commodity_id")
        return first_per_key(
            self.keyed(numbered),
            ["date_id", "market_id", "commodity_id"],
            QUOTE_ORDER,
            ["min_price", "max_price", "modal_price"],
        )

    @cached_property
    def model_evaluation(self) -> DataFrame:
        """Metrics of the previous row's price as prediction, per (market, commodity id)."""
        return persistence_eval(fact_series(self))

    feature_importance = None
    usage = None

    def last_days(self, days: int) -> "TradeTables":
        """The same star with the fact from `days` before the latest date on.

        The first day is a top-1, not an aggregate, for the reason given at previous_day.
        """
        first = F.date_sub(F.to_date("l_shipdate"), days).cast("timestamp_ntz").alias("first")
        top = self.table("lineitem").select(first).orderBy(F.desc("first")).limit(1)
        return TradeTables(self.spark, self.sf_dir, top.scalar())

    def since_previous_day(self) -> "TradeTables":
        """The same star with the fact from the previous reported day on."""
        first = previous_day(self).select(F.col("arrival_date").cast("timestamp_ntz"))
        return TradeTables(self.spark, self.sf_dir, first.scalar())

    def series(self) -> DataFrame:
        """Daily price series by (market_id, commodity name): the first quote of each day."""
        by_name = self.products().select("p_partkey", "commodity")
        return self._series(self.keyed(by_name), ["market_id", "commodity"])

    def state_series(self) -> DataFrame:
        """The same by (state_id, commodity name): fewer, denser series to train on."""
        by_name = self.products().select("p_partkey", "commodity")
        states = self.market_dim.select("market_id", "state_id")
        return self._series(self.keyed(by_name).join(states, "market_id"), ["state_id", "commodity"])

    def _series(self, quotes: DataFrame, keys: list[str]) -> DataFrame:
        first = first_per_key(quotes, [*keys, "arrival_date"], QUOTE_ORDER, ["modal_price"])
        return first.withColumn("month", F.month("arrival_date"))
