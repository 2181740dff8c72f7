"""Tables that several steps read: written once to the shared folder of the cluster, as Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.session import shared_folder

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FILTER_WORDS = 1 << 17  # rows of the broadcast bitmap at most, with 64 bits each

_open: ContextVar[list[str] | None] = ContextVar("_open", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end. What is to outlast them is written after the block's own steps,
    by ``written(..., lasting=True)``."""
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded_batches(spark: SparkSession, rows: int) -> None:
    """From now on an Arrow batch has at most ``rows`` rows in this session, for rows that hold long values and are not
    written here. A smaller number that the session has already stays."""
    before = int(spark.conf.get(ARROW_ROWS))
    if not 0 < before <= rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def written(df: DataFrame, name: str, by: str | None = None, batch_rows: int | None = None, lasting: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, read by any executor, safe if one is lost.

    ``by`` gives each value of that column a folder of its own; ``batch_rows`` bounds the rows of an Arrow batch while
    the table is computed, for rows that hold long values. Tables lie below ``<shared>/<application id>``; that folder
    can go once the application's results are written (``winnow.session.drop_written``).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if not lasting and _open.get() is not None:
        _open.get().append(path)
    before = spark.conf.get(ARROW_ROWS)
    if batch_rows:
        spark.conf.set(ARROW_ROWS, str(min(batch_rows, int(before) if int(before) > 0 else batch_rows)))
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def without(docs: DataFrame, gone: DataFrame, on: dict[str, object], hashed: str) -> DataFrame:
    """``docs`` less the rows that match ``gone``; only rows that may match are shuffled, not all texts.

    ``on`` gives an expression over ``docs`` per column of ``gone``; ``hashed`` names the one of which a bitmap is made,
    of bounded size however many rows go: a row whose bit is not set matches nothing and stays where it lies. With very
    many rows to go the bitmap is full and every row is shuffled, with the same result. Null keys match nothing.
    """
    bits = FILTER_WORDS * 64
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    bit = place(F.col(hashed))
    words = gone.where(F.col(hashed).isNotNull()).groupBy((bit / 64).cast("int").alias("__word"))
    words = written(words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))).alias("__bits")), "bitmap", lasting=True)
    own = place(on[hashed])
    marked = docs.withColumn("__at", own).withColumn("__at_word", (F.col("__at") / 64).cast("int"))
    marked = marked.join(F.broadcast(words), F.col("__at_word") == F.col("__word"), "left")
    suspect = F.coalesce(F.call_function("getbit", "__bits", (F.col("__at") % 64).cast("int")) == 1, F.lit(False)) & on[hashed].isNotNull()
    clean = marked.where(~suspect).select(*[docs[c] for c in docs.columns])
    open_still = marked.where(suspect).select(*[docs[c] for c in docs.columns])
    same = [on[c] == gone[c] for c in on]
    return clean.unionByName(open_still.join(gone, same, "left_anti"))
