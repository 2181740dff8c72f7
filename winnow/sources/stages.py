"""The stage table: one Parquet dataset partitioned by run, stage and outcome (S10, S11), and its manifest.

A stage counts only once its manifest row is there. The row is written last, as one file, and taken away before anything
of the stage is overwritten, so an interrupted write leaves a stage that is not seen by any reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

PARTITIONS = ("run_id", "stage", "outcome")
MANIFEST = "run_id string, stage string, stage_rank int, digest string, files long, rows long, failed_rows long"


def write_stage(df: DataFrame, path: str, run_id: str, stage: str, rank: int, outcome: str) -> None:
    """Overwrite one partition directory.  An empty result still leaves a file with the schema."""
    drop_commit(df.sparkSession, path, run_id, stage)
    target = f"{path}/run_id={run_id}/stage={stage}/outcome={outcome}"
    df.withColumn("stage_rank", F.lit(rank)).write.mode("overwrite").parquet(target)


def read_stage(spark: SparkSession, path: str, run_id: str, stage: str, outcome: str = "survivor") -> DataFrame:
    """One partition directory as it is, committed or not."""
    target = f"{path}/run_id={run_id}/stage={stage}/outcome={outcome}"
    return spark.read.parquet(target).drop("stage_rank")


def _place(spark: SparkSession, path: str):
    """A path and its file system, whichever it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _place(spark, path)
    return fs.exists(where)


def drop_commit(spark: SparkSession, path: str, run_id: str, stage: str) -> None:
    fs, where = _place(spark, f"{path}-manifest/{run_id}/{stage}")
    fs.delete(where, True)


def commit_stage(spark: SparkSession, path: str, run_id: str, stage: str, rank: int, digest: str) -> None:
    """Make a stage visible: one row with what was written, counted from the files themselves.

    ``digest`` says how the stage was made; a resumed run goes on only after stages made in the same way.
    """

    def measured(outcome: str) -> tuple[int, int]:
        target = f"{path}/run_id={run_id}/stage={stage}/outcome={outcome}"
        if not _exists(spark, target):
            return 0, 0
        files = spark.read.parquet(target).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("rows"))
        found = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
        return found["files"], found["rows"]

    (files, rows), (more, failed) = measured("survivor"), measured("failed")
    row = [F.lit(run_id), F.lit(stage), F.lit(rank), F.lit(digest), F.lit(files + more), F.lit(rows), F.lit(failed)]
    columns = [v.cast(c.split()[1]).alias(c.split()[0]) for v, c in zip(row, MANIFEST.split(", "), strict=True)]
    one = spark.range(1).coalesce(1).select(*columns)
    one.write.mode("overwrite").parquet(f"{path}-manifest/{run_id}/{stage}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per committed stage: run_id, stage, stage_rank, digest, files (with rows), rows, failed_rows."""
    if not _exists(spark, f"{path}-manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{path}-manifest")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All committed stages of all runs; filters on run_id, stage and outcome prune directories."""
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    done = manifest(spark, path).select(F.col("run_id").alias("__run"), F.col("stage").alias("__stage"))
    same = (rows["run_id"].cast("string") == done["__run"]) & (rows["stage"].cast("string") == done["__stage"])
    return rows.join(done, same, "left_semi")


def latest_stage(
    table: DataFrame, rank: str = "stage_rank", stage: str = "stage", skip: Sequence[str] = (), run: str = "run_id"
) -> DataFrame:
    """Rows of the highest-ranked stage that has any, per run where the table has a ``run`` column; stages in ``skip``
    are ignored.

    ``existing`` is the variant that stops at a stage written without rows.
    """
    rows = table.filter(~F.col(stage).isin(*skip)) if skip else table
    if run not in table.columns:
        name = rows.agg(F.max_by(stage, rank)).first()[0]
        return rows.filter(F.col(stage) == F.lit(name)) if name is not None else rows.limit(0)
    last = rows.groupBy(F.col(run).alias("__run")).agg(F.max_by(stage, rank).alias("__last"))
    return rows.join(last, rows[run].eqNullSafe(last["__run"]) & (rows[stage] == last["__last"]), "left_semi")


def existing(spark: SparkSession, path: str, run_id: str, order: Sequence[str], fallback: bool = False, skip: Sequence[str] = ()) -> DataFrame | None:
    """Survivors of the newest committed stage of ``order`` (newest last); optionally the newest that is not empty."""
    done = {r["stage"]: r["rows"] for r in manifest(spark, path).filter(F.col("run_id") == run_id).select("stage", "rows").collect()}
    for name in reversed([s for s in order if s in done and s not in skip]):
        if not fallback or done[name]:
            return read_stage(spark, path, run_id, name)
    return None
