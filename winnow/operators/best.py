"""Best alternative per entity and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from winnow.operators.identity import head_per_group, keep_first
from winnow.operators.ranks import row_numbers


def best_per(
    df: DataFrame, key: str, score: str, order: str, renumber: str | None = None
) -> DataFrame:
    """Lowest score per entity, ties by ``order``; a blank entity falls back to ``order``.

    An unreadable or missing score sorts last.  ``renumber`` names a column that gets 0..k-1 in
    the order of the entities.
    """
    text = F.trim(F.col(key).cast("string"))
    entity = F.when(F.coalesce(text, F.lit("")) != "", text).otherwise(F.col(order).cast("string"))
    number = F.col(score).cast("string").try_cast("double")
    sort = F.coalesce(F.when(~F.isnan(number), number), F.lit(float("inf")))
    ready = df.withColumns({key: entity, "__sort": sort})
    best = keep_first(ready, [key], ["__sort", order]).drop("__sort")
    if not renumber:
        return best
    # every entity has exactly one best row, so the numbers need the entity names only
    names = row_numbers(df.select(entity.alias("__entity")).distinct(), [], ["__entity"], "__pos")
    numbered = best.join(names, best[key] == names["__entity"]).drop("__entity")
    return numbered.withColumn(renumber, F.col("__pos") - 1).drop("__pos")


def best_scored(df: DataFrame, key: str, score: str, order: str, values: Sequence[str]) -> DataFrame:
    """Columns of the first row with the lowest score per entity; rows without a score do not compete."""
    scored = df.filter(F.col(score).isNotNull() & F.col(key).isNotNull())
    agg = F.min_by(F.struct(*values), F.struct(score, order)).alias("__best")
    return scored.groupBy(key).agg(agg).select(key, *[F.col("__best")[v].alias(v) for v in values])


def best_by_tool(
    df: DataFrame, key: str, tool: str, tools: Sequence[str], score: str, order: str, values: Sequence[str] = ()
) -> DataFrame:
    """Best score of every tool per entity: one row per entity that any tool has scored.

    One aggregation gives the outer join over the tools; every column exists even if a tool is absent.
    """
    cols = [score, *[v for v in values if v != score]]
    aggs = []
    for t in tools:
        rank = F.when(F.col(tool) == t, F.struct(score, order))
        aggs.append(F.min_by(F.struct(*cols), rank).alias(f"__{t}"))
    usable = df.filter(F.col(score).isNotNull() & F.col(key).isNotNull() & F.col(tool).isin(*tools))
    best = usable.groupBy(key).agg(*aggs)
    return best.select(key, *[F.col(f"__{t}")[c].alias(f"{t}_{c}") for t in tools for c in cols])


def with_tool_scores(final: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Left join of the tool scores on the key read as text; the score columns always exist."""
    side = scores.withColumn("__key", F.col(key).cast("string")).drop(key)
    return final.withColumn("__key", F.col(key).cast("string")).join(side, "__key", "left").drop("__key")


def top_k(df: DataFrame, by: Sequence[str], k: int, group: str | None = None) -> DataFrame:
    """First k rows in the order of ``by``, overall or per group; the last column should break ties."""
    return head_per_group(df, [group] if group else [], by, k)


def top_counts(counts: DataFrame, name: str, count: str, k: int) -> DataFrame:
    return counts.orderBy(F.col(count).desc(), F.col(name)).limit(k)


def extremes(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k lowest and the k highest rows, marked with ``end``."""
    low = df.orderBy(F.col(by).asc(), F.col(tie)).limit(k).withColumn("end", F.lit("low"))
    high = df.orderBy(F.col(by).desc(), F.col(tie)).limit(k).withColumn("end", F.lit("high"))
    return low.union(high)
