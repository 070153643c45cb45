"""Schemas of the raw quotes, the star tables and the model tables."""

from pyspark.sql import types as T

from harvestlens.constants import QUOTE_COLUMNS

PRICE = T.DecimalType(12, 2)
# Prices as read: wide enough that rounding to PRICE happens only at the fact.
RAW_PRICE = T.DecimalType(18, 6)

RAW_QUOTE = T.StructType([T.StructField(c, T.StringType()) for c in QUOTE_COLUMNS])

# A fetched page; day, query and page are NULL where a fetch does not record them.
RECORD_PAGE = T.StructType([
    T.StructField("day", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("page", T.LongType()),
    T.StructField("records", T.ArrayType(RAW_QUOTE)),
])

STATE_DIM = T.StructType([
    T.StructField("state_id", T.IntegerType(), False),
    T.StructField("state", T.StringType(), False),
])
COMMODITY_DIM = T.StructType([
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("commodity", T.StringType(), False),
    T.StructField("variety", T.StringType(), False),
    T.StructField("grade", T.StringType(), False),
])
MARKET_DIM = T.StructType([
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("market", T.StringType(), False),
    T.StructField("district", T.StringType(), False),
    T.StructField("state_id", T.IntegerType(), False),
])
DATE_DIM = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("arrival_date", T.DateType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("weekday", T.StringType(), False),
])
FACT = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("min_price", PRICE, False),
    T.StructField("max_price", PRICE, False),
    T.StructField("modal_price", PRICE, False),
])
# The stored fact carries two derived columns to partition its files by.
STORED_FACT = T.StructType(FACT.fields + [
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
])
# The fact summed per month, market and commodity: number of rows, sum of the modal price, lowest and highest price.
USAGE_SUMMARY = T.StructType([
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("n", T.LongType(), False),
    T.StructField("total", T.DecimalType(28, 2), False),
    T.StructField("low", PRICE, False),
    T.StructField("high", PRICE, False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
])
# Where a row stands in the files it came from; NULL where the source has no files.
SEQUENCE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])
_QUOTE = [
    T.StructField("arrival_date", T.DateType()),
    *[T.StructField(c, T.StringType()) for c in ("state", "district", "market", "commodity", "variety", "grade")],
    *[T.StructField(c, RAW_PRICE) for c in ("min_price", "max_price", "modal_price")],
    T.StructField("sequence", SEQUENCE),
]
# Every row a load was given, parsed; rows without a readable date have year and month NULL. `corrupt` is
# the line of a row that has more or fewer fields than its file's header.
LANDED_QUOTES = T.StructType([
    *_QUOTE,
    T.StructField("corrupt", T.StringType()),
    T.StructField("load", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])
# Cleaned quotes whose state is not among the seeds.
REJECTS = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    *_QUOTE[1:-1],
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
])
# What became of a load's rows, per day (NULL: no readable date) and reason; `read` is their number.
LOAD_LOG = T.StructType([
    T.StructField("load", T.StringType()),
    T.StructField("arrival_date", T.DateType()),
    T.StructField("reason", T.StringType()),
    T.StructField("rows", T.LongType()),
])
MODEL_EVALUATION = T.StructType([
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("mape", T.DecimalType(5, 2)),
    T.StructField("rmse", T.DecimalType(10, 2)),
    T.StructField("r2_score", T.DecimalType(5, 2)),
])
FEATURE_IMPORTANCE = T.StructType([
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("feature_name", T.StringType(), False),
    T.StructField("importance_score", T.DecimalType(10, 5)),
])
SERIES_MODELS = T.StructType([
    T.StructField("market_id", T.IntegerType(), False),
    T.StructField("commodity_id", T.IntegerType(), False),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("importances", T.ArrayType(T.DoubleType())),
])

STAR_TABLES = {
    "state_dim": STATE_DIM,
    "commodity_dim": COMMODITY_DIM,
    "market_dim": MARKET_DIM,
    "date_dim": DATE_DIM,
    "fact_market_prices": STORED_FACT,
    "usage_summary": USAGE_SUMMARY,
    "landed_quotes": LANDED_QUOTES,
    "rejects": REJECTS,
    "load_log": LOAD_LOG,
    "model_evaluation": MODEL_EVALUATION,
    "feature_importance": FEATURE_IMPORTANCE,
    "series_models": SERIES_MODELS,
}
