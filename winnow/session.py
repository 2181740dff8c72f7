"""Session defaults.  A cluster's own settings always win: only unset keys are filled in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "winnow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_parts(spark: SparkSession) -> int:
    """How many ways the session spreads a shuffle; range cuts follow it so they grow with the cluster."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which all executors share.

    A local session without that setting (tests) gets a folder of its own; a cluster without it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for tables that several branches of a plan read.

    It is computed once, on a cluster as in a local session, and a lost executor takes nothing with it. Tables lie
    below ``<shared>/<application id>``; ``drop_written`` removes them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Remove this application's tables from the shared folder; results that still read them must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


SMALL_ROWS = 10_000


def small_or_same(df: DataFrame, name: str = "helper", max_rows: int = SMALL_ROWS) -> DataFrame:
    """A helper table, written once and then counted; marked for broadcast if it has at most ``max_rows`` rows.

    Larger ones are joined by shuffle as usual, from the same table.
    """
    table = written(df, name)
    return F.broadcast(table) if table.count() <= max_rows else table
