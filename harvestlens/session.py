"""Session defaults and the shared scratch folder."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "harvestlens", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC; `conf` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Only a local session without that setting gets a folder of its own: on a cluster
    a machine-local folder would be lost with the machine, so that is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="harvestlens-")
    return f"{root}/harvestlens/{name}-{uuid.uuid4().hex}"


def write_and_read(df, name: str):
    """Cut lineage through a Parquet table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside the block leave no shuffle files behind (Spark 4.1; others keep them until the driver collects their frames).

    It is for frames that are written once: one that runs again shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def passing_tables(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A write_and_read whose tables are deleted when the block ends: what leaves it must not read them."""
    root = scratch_path(spark, name)

    def keep(df: DataFrame, table: str) -> DataFrame:
        path = f"{root}/{table}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
