"""One quote per key within the watermark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedup(stream: DataFrame, ts: str, keys: list[str], lateness: str = "2 days") -> DataFrame:
    """The first arrival of each key; repeats within `lateness` are dropped."""
    timed = stream.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", lateness)
    return timed.dropDuplicatesWithinWatermark(keys)
