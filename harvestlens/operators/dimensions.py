"""Dimension building: new natural keys get ids, known ones keep theirs."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harvestlens.functions import dates, text

_BUCKET_DIGITS = 3  # hex digits: 4096 buckets


def number_keys(rows: DataFrame, keys: list[str], id_column: str, after: DataFrame | None = None) -> DataFrame:
    """Consecutive integer ids for distinct rows, ordered by (key hash bucket, key).

    Numbering by one sorted window would put all rows in one task. Here each hash bucket
    is numbered on its own and shifted by the sizes of the buckets before it; only the
    bucket sizes (4096 rows at most) meet in one task. `after` is a one-row frame whose
    column is the highest id in use.
    """
    spelled = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    bucketed = rows.withColumn("bucket", F.substring(F.md5(spelled.cast("binary")), 1, _BUCKET_DIGITS))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).select(
        "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    within = W.partitionBy("bucket").orderBy(*keys)
    number = F.row_number().over(within) + F.col("start")
    if after is not None:
        number = number + F.coalesce(after.scalar(), F.lit(0))
    numbered = bucketed.join(F.broadcast(starts), "bucket").withColumn(id_column, number.cast("int"))
    return numbered.select(id_column, *rows.columns)


def new_dim_rows(main: DataFrame, dim: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Rows to add to a dimension: trimmed natural keys it lacks, numbered after its last id."""
    kinds = dict(main.select(*keys).dtypes)
    natural = main.select(
        *[text.strip(F.col(k)).alias(k) if kinds[k] == "string" else F.col(k) for k in keys]
    )
    new = natural.dropna().distinct().join(dim, keys, "left_anti")
    last = dim.select(F.max(id_column))
    return number_keys(new, keys, id_column, after=last)


def upsert_dim(main: DataFrame, dim: DataFrame, keys: list[str], id_column: str) -> tuple[DataFrame, DataFrame]:
    """(dimension with new rows, main with the id). Main's rows are all kept."""
    updated = dim.unionByName(new_dim_rows(main, dim, keys, id_column).select(*dim.columns))
    return updated, attach_id(main, updated, keys, id_column)


def attach_id(main: DataFrame, dim: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    return main.join(dim.select(*keys, id_column), keys, "left")


def build_state_dim(main: DataFrame, state_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quotes of known states with state_id, rejected quotes).

    States are fixed ids, so an unknown name cannot be given one; its quotes are rejects.
    """
    matched = attach_id(main, state_dim, ["state"], "state_id")
    known = F.col("state_id").isNotNull()
    return matched.filter(known), matched.filter(~known).drop("state_id")


COMMODITY_KEYS = ["commodity", "variety", "grade"]
MARKET_KEYS = ["market", "district", "state_id"]


def build_commodity_dim(main: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    return upsert_dim(main, dim, COMMODITY_KEYS, "commodity_id")


def build_market_dim(main: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    return upsert_dim(main, dim, MARKET_KEYS, "market_id")


def date_dimension(days: DataFrame) -> DataFrame:
    """date_dim rows of distinct dates; the id is the day number, so it never changes."""
    day = F.col("arrival_date")
    return days.select(
        dates.date_id(day).alias("date_id"),
        "arrival_date",
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        dates.weekday_name(day).alias("weekday"),
    )


def build_date_dim(main: DataFrame, dim: DataFrame) -> DataFrame:
    new = main.select("arrival_date").distinct().join(dim, "arrival_date", "left_anti")
    return dim.unionByName(date_dimension(new))
