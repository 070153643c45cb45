"""Daily windows over a stream of values."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_daily_price(stream: DataFrame, ts: str, key: str, value: Column, lateness: str = "2 days") -> DataFrame:
    """Count, sum, minimum and maximum per day and key; older rows than `lateness` are late.

    The value should be a decimal, so that sums do not depend on arrival order.
    """
    timed = stream.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", lateness)
    return timed.groupBy(F.window("at", "1 day").alias("day"), key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
    ).select(F.to_date("day.start").alias("day"), key, "n", "total", "lowest", "highest")


def write_updates(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed windows to a folder of its own.

    A replayed batch overwrites its folder, so the output is exact however often a batch
    runs. State stays in the state store; nothing passes through the driver.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_updates(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The newest state of each window from the written batches."""
    values = [c for c in schema.fieldNames() if c not in keys]
    stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(stored).parquet(path)
    newest = rows.groupBy(*keys).agg(F.max(F.struct("batch", *values)).alias("newest"))
    return newest.select(*keys, *[F.col(f"newest.{c}").alias(c) for c in values])
