"""Session settings and the shared work folder."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name="ledgerloom", master=None, **conf):
    """A session with the settings the operators expect; extra `conf` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # Exact sums rely on overflow raising instead of wrapping.
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        # Streaming state on local disk instead of the heap: seen hashes are many.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: days are UTC, and an overflow raises."""
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.ansi.enabled", "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Where that is unset, a folder in the warehouse of a local session; a cluster has to name
    one, since a folder of the driver's own would not do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/ledgerloom/{app}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; call it when their results are written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark)}/ledgerloom/{spark.sparkContext.applicationId}"
    )
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Writes begun inside remove their shuffle files when they end.

    Otherwise these stay until the driver's heap is collected. Older than Spark 4.1, no effect.
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


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write `df` once to the shared folder and scan it from there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
