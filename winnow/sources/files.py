"""Candidate files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from winnow.functions.text import file_stem
from winnow.operators.combine import union_all
from winnow.operators.identity import resolve_columns

# Canonical column names and the spellings accepted for them.
ALIASES = {"smiles": ("smiles",), "model_name": ("model_name", "name"), "mol_idx": ("mol_idx",)}


def _by_header(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """The files of the paths and globs, grouped by their first line; one job over the first block of each file."""
    lines = spark.read.text(list(paths)).filter(F.col("_metadata.file_block_start") == 0)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    return [r[0] for r in heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").select("files").collect()]


def read_candidates(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | None = None,
    headerless: bool = False,
    group: str = "model_name",
    text: str = "smiles",
) -> DataFrame:
    """CSV files or globs as one table; without a group column the file's stem names the group.

    Files are read by their own headers and joined by column name, whatever the order of their columns; columns that
    a file lacks are NULL.  A file with a header but without the ``text`` column ends with an error that names it:
    headerless files need ``headerless=True`` and get the columns smiles, col_1, col_2, ...  Values are read as text;
    ``schema`` casts the columns it names.
    """
    many = [paths] if isinstance(paths, str) else list(paths)
    tables = []
    for files in [many] if headerless else _by_header(spark, many):
        df = spark.read.option("header", not headerless).csv(files).withColumn("__file", F.col("_metadata.file_path"))
        if headerless:
            names = [text, *[f"col_{i}" for i in range(1, len(df.columns) - 1)]]
            df = df.toDF(*names, "__file")
        df = resolve_columns(df, ALIASES)
        if text not in df.columns:
            raise ValueError(f"no column {text} in the header of {files[0]}; headerless files need headerless=True")
        if group not in df.columns:
            df = df.withColumn(group, file_stem(F.col("__file")))
        tables.append(df.drop("__file"))
    out = union_all(*tables)
    wanted = {f.name: f.dataType for f in T._parse_datatype_string(schema)} if schema else {}
    return out.withColumns({c: F.col(c).try_cast(kind) for c, kind in wanted.items() if c in out.columns}) if wanted else out


def count_records(spark: SparkSession, path: str, kind: str) -> int:
    """Records of a file: CSV lines less the header, non-blank SMI lines, SDF terminators."""
    lines = spark.read.text(path)
    if kind == "csv":
        return max(lines.count() - 1, 0)
    if kind == "smi":
        return lines.filter(F.trim("value") != "").count()
    if kind == "sdf":
        ends = lines.filter(F.trim("value") == "$$$$").count()
        return ends if ends else int(not lines.filter(F.trim("value") != "").isEmpty())
    raise ValueError(f"unknown record format: {kind}")


def read_lines(spark: SparkSession, path: str, out: str = "smiles") -> DataFrame:
    """First field of every non-blank line."""
    return spark.read.text(path).filter(F.trim("value") != "").select(
        F.split(F.trim("value"), r"\s+")[0].alias(out)
    )


def write_group_map(groups: DataFrame, path: str) -> None:
    groups.write.mode("overwrite").parquet(path)
