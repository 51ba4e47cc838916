"""Session settings and the shared folder that survives executor loss."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "grantlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job expects; cluster defaults stay untouched otherwise."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The plans of a load have more stages than the 100 whose compiled code is kept by default.
        "spark.sql.codegen.cache.maxEntries": "1000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC; text without an offset must not pick up a local zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Of equal fields in one object the last counts; the event must not be lost for them.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


#: Tasks that list the files of a feed, at most.
LISTING_TASKS = 64


def list_by_share(spark: SparkSession) -> SparkSession:
    """A listing task takes its share of the folders; by default each folder and each file of a load has a task of its own.

    Each load lists its files twice, so there are no more tasks than keep the cores busy.
    """
    tasks = min(LISTING_TASKS, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from the session.

    Where the session names none, it is a folder in the warehouse, which executors share as well.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder.

    For rows that are costly to compute and read by several branches of a plan: they
    are computed once, each branch reads only its columns, and a lost executor costs
    a read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more, on whatever file system it is."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
