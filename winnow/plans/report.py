"""Report tables over a cascade.

Input is one row per candidate with its group and ``failed_stage`` (NULL for survivors), as
``Cascade.annotate`` produces.  One grouped count of that table is all the report reads; every
table below is derived from that small result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from winnow.functions.numbers import half_even, ratio
from winnow.operators.ranks import ALL

INITIAL = "Initial"


def _failed_at(stages: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col("failed_stage") == s).alias(f"__lost_{i}") for i, s in enumerate(stages)]


def stage_counts(df: DataFrame, stages: Sequence[str], group: str | None = None) -> DataFrame:
    """Per group (and "(all)"): rows in, and rows lost at each stage."""
    aggs = [F.count(F.lit(1)).alias("initial"), *_failed_at(stages)]
    if not group:
        return df.agg(*aggs)
    own = df.groupBy(F.col(group).cast("string").alias(group)).agg(*aggs)
    sums = [F.sum(c).cast("long").alias(c) for c in own.columns if c != group]
    name = F.when(F.grouping(group) == 1, F.lit(ALL)).otherwise(F.col(group))
    both = own.groupingSets([[F.col(group)], []], group).agg(name.alias("__name"), *sums)
    return both.drop(group).withColumnRenamed("__name", group)


def _after(stages: Sequence[str], i: int) -> Column:
    left = F.col("initial")
    for k in range(i + 1):
        left = left - F.col(f"__lost_{k}")
    return left


def funnel(df: DataFrame, stages: Sequence[str], group: str | None = None) -> DataFrame:
    """Rows left after every stage, starting with the input: (group, position, stage, count)."""
    counts = stage_counts(df, stages, group)
    rows = [F.struct(F.lit(0).alias("position"), F.lit(INITIAL).alias("stage"), F.col("initial").alias("count"))]
    rows += [
        F.struct(F.lit(i + 1).alias("position"), F.lit(s).alias("stage"), _after(stages, i).alias("count"))
        for i, s in enumerate(stages)
    ]
    keep = [group] if group else []
    return counts.select(*keep, F.explode(F.array(*rows)).alias("f")).select(*keep, "f.*")


def flow_links(funnel_df: DataFrame, group: str | None = None) -> DataFrame:
    """Links of the flow picture: survivors stage to stage, and losses where there are any."""
    keep = [group] if group else []
    win = W.partitionBy(*keep).orderBy("position")
    steps = funnel_df.select(
        *keep,
        "position",
        F.lag("stage").over(win).alias("source"),
        F.col("stage"),
        F.col("count"),
        (F.lag("count").over(win) - F.col("count")).alias("lost"),
        F.first("count").over(win).alias("initial"),
    ).filter(F.col("source").isNotNull())
    on = F.struct(F.col("stage").alias("target"), F.col("count").alias("value"))
    off = F.struct(F.concat(F.lit("Lost ("), F.col("stage"), F.lit(")")).alias("target"), F.col("lost").alias("value"))
    links = steps.select(*keep, "position", "source", "initial", F.explode(F.array(on, off)).alias("l"))
    out = links.select(*keep, "position", "source", "l.target", "l.value", "initial")
    out = out.filter(~F.col("target").startswith("Lost (") | (F.col("value") > 0))
    return out.withColumn("pct_of_initial", ratio(F.col("value"), F.col("initial"), scale=100)).drop("initial")


def stage_stats(df: DataFrame, stages: Sequence[str]) -> DataFrame:
    """Passed, failed and total per stage; stages nobody reached are left out."""
    counts = stage_counts(df, stages)
    rows = [
        F.struct(
            F.lit(s).alias("stage"),
            _after(stages, i).alias("passed"),
            F.col(f"__lost_{i}").alias("failed"),
            (_after(stages, i) + F.col(f"__lost_{i}")).alias("total"),
        )
        for i, s in enumerate(stages)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*").filter("total > 0")


def retention(df: DataFrame) -> DataFrame:
    out = df.agg(F.count(F.lit(1)).alias("initial"), F.count_if(F.col("failed_stage").isNull()).alias("final"))
    rate = ratio(F.col("final"), F.col("initial"))
    text = F.concat(F.format_string("%.1f", half_even(rate * 100, 1)), F.lit("%"))
    return out.withColumns({"rate": rate, "rate_text": text})


def scorecard(df: DataFrame, stages: Sequence[str], group: str) -> DataFrame:
    """Per group: initial, final, retention in percent, losses per stage."""
    counts = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("initial"),
        F.count_if(F.col("failed_stage").isNull()).alias("final"),
        *[F.count_if(F.col("failed_stage") == s).alias(f"lost_{s}") for s in stages],
    )
    return counts.withColumn("retention_pct", ratio(F.col("final"), F.col("initial"), scale=100))
