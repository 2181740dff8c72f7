"""Planner results and tool logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from winnow.functions.text import any_of

RESULT = (
    "data array<struct<index:bigint,target:string,is_solved:boolean,search_time:double,"
    "top_score:double,number_of_steps:bigint,number_of_precursors:bigint>>"
)

# Phrases a docking log uses for poses outside the box.
BOX_WARNINGS = ("outside box", "not within box")


def result_rows(data: DataFrame, column: str = "data") -> DataFrame:
    rows = data.select(F.explode(column).alias("r")).select("r.*")
    return rows.select(
        F.coalesce("index", F.lit(-1)).alias("index"),
        F.coalesce("target", F.lit("")).alias("target"),
        F.coalesce("is_solved", F.lit(False)).alias("is_solved"),
        F.coalesce("search_time", F.lit(0.0)).alias("search_time"),
        "top_score",
        "number_of_steps",
        "number_of_precursors",
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One row per target with defaults; a file without results gives an empty table of the same schema."""
    return result_rows(spark.read.schema(RESULT).option("multiLine", True).json(path))


def log_id(line: Column) -> Column:
    """Text before the first bar."""
    return F.trim(F.regexp_extract(line, r"^([^|]*)\|", 1))


def scan_log(lines: DataFrame, column: str = "value", phrases: Sequence[str] = BOX_WARNINGS, by: str | None = None) -> DataFrame:
    """Warning lines and the distinct ids they name (overall or per ``by``)."""
    hits = lines.filter(any_of(F.col(column), phrases))
    ident = log_id(F.col(column))
    keys = [by] if by else []
    return hits.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("warnings"), F.countDistinct(F.when(ident != "", ident)).alias("ids")
    )


def read_log(spark: SparkSession, path: str, phrases: Sequence[str] = BOX_WARNINGS) -> DataFrame:
    return scan_log(spark.read.text(path), "value", phrases)
