"""Column statistics and the data behind distribution plots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.numbers import as_bound, ratio
from winnow.operators.combine import join_on
from winnow.operators.ranks import ALL, IN_TASK_ROWS, grouped, melt, number, quantiles
from winnow.session import small_or_same

FIVE = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}


def _group_name(df: DataFrame, group: str) -> Column:
    return F.when(F.grouping(group) == 1, F.lit(ALL)).otherwise(F.col(group).cast("string"))


def describe(df: DataFrame, cols: Sequence[str], group: str, single_std: float | None = None) -> DataFrame:
    """n, mean, sample std, min, max, exact median per metric, overall and per group.

    ``single_std`` is the std shown for one value (None or 0, both readings exist).
    """
    def moments(c: str) -> dict[str, Column]:
        x = number(c)
        std = F.coalesce(F.stddev_samp(x), F.lit(single_std).cast("double"))
        return {"n": F.count(x), "mean": F.avg(x), "std": std, "min": F.min(x), "max": F.max(x)}

    table = grouped(df, {c: moments(c) for c in cols}, group, overall=True).filter("n > 0")
    middle = quantiles(df, cols, {"median": 0.5}, group, overall=True)
    return join_on(table, middle, [group, "metric"], "left")


def five_numbers(df: DataFrame, cols: Sequence[str], group: str, in_task: int = IN_TASK_ROWS) -> DataFrame:
    """Exact minimum, quartiles and maximum per group and metric."""
    return quantiles(df, cols, FIVE, group, in_task=in_task)


def group_means(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(number(c)).alias(f"mean_{c}") for c in cols])


def drift(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean before and after for the metrics that exist in both snapshots."""
    both = [c for c in cols if c in before.columns and c in after.columns]

    def means(df: DataFrame, name: str) -> DataFrame:
        wide = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(c) for c in both])
        return melt(wide, [], both).withColumnRenamed("value", name)

    joined = means(before, "mean_initial").join(means(after, "mean_final"), "metric")
    return joined.withColumn("change", F.col("mean_final") - F.col("mean_initial"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] with their mean; empty bins are listed with 0."""
    x = number(col)
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    schema = "bin int, lower double, count bigint, sum double"
    if ends.lo is None:
        return df.sparkSession.createDataFrame([], schema)
    width = (ends.hi - ends.lo) / bins
    where = F.floor((x - F.lit(ends.lo)) / F.lit(width)) if width > 0 else F.lit(0)
    counts = (
        df.filter(x.isNotNull())
        .groupBy(F.least(where, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum(x).alias("sum"))
    )
    domain = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return domain.join(counts, "bin", "left").select(
        "bin",
        (F.lit(ends.lo) + F.col("bin") * F.lit(width)).alias("lower"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("sum", F.lit(0.0)).alias("sum"),
    )


def discrete_histogram(df: DataFrame, col: str, beyond: int = 5) -> DataFrame:
    """Counts of the whole numbers that occur; from 0 to max + ``beyond`` the others are listed with 0.

    Fractions, NaN and missing values are left out; below 0 only values that occur are listed. The values are made in
    parallel, as many as the largest one says.
    """
    x = number(col)
    whole = df.filter((x == F.floor(x)) & (F.abs(x) < 2.0**62)).groupBy(x.cast("long").alias("value"))
    counts = whole.agg(F.count(F.lit(1)).alias("count"))
    top = counts.agg(F.max("value")).first()[0]
    domain = df.sparkSession.range(0 if top is None else max(0, top + beyond + 1)).withColumnRenamed("id", "value")
    return domain.join(counts, "value", "full_outer").select("value", F.coalesce("count", F.lit(0)).alias("count"))


def symbol_histogram(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Occurrences of every allowed symbol of a list column, in the given order, zeros included."""
    def times(symbol: str) -> Column:
        return F.sum(F.size(F.filter(F.col(col), lambda s: s == symbol)))

    counts = df.agg(*[times(a).alias(f"n{i}") for i, a in enumerate(allowed)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(a).alias("symbol"), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("count"))
        for i, a in enumerate(allowed)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def density(
    df: DataFrame, col: str, group: str, points: int = 50, clip: tuple = (0.0, None), cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density per group, bandwidth std * n^(-1/5).

    The even grid runs from ``cut`` bandwidths below the minimum to as many above the maximum,
    inside ``clip``.

    The kernel sums of all grid points are aggregate columns of one grouped aggregation: rows are
    neither multiplied by the grid nor brought together before they are summed.
    """
    x = F.col(col).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).select(F.col(group).alias("__g"), x.alias("__x"))
    lo, hi = clip
    spread = rows.groupBy("__g").agg(
        F.count(F.lit(1)).alias("__n"),
        (F.stddev_samp("__x") * F.pow(F.count(F.lit(1)).cast("double"), F.lit(-0.2))).alias("__h"),
        F.min("__x").alias("__min"),
        F.max("__x").alias("__max"),
    ).filter("__h > 0")
    low, high = F.col("__min") - cut * F.col("__h"), F.col("__max") + cut * F.col("__h")
    frame = spread.select(
        "__g",
        "__n",
        "__h",
        (F.greatest(low, F.lit(lo)) if lo is not None else low).alias("__lo"),
        (F.least(high, F.lit(hi)) if hi is not None else high).alias("__hi"),
    )
    at = [F.col("__lo") + F.lit(k) * (F.col("__hi") - F.col("__lo")) / F.lit(points - 1) for k in range(points)]
    frame = small_or_same(frame, "density-frames")
    kernel = [
        F.sum(F.exp(-0.5 * F.pow((p - F.col("__x")) / F.col("__h"), F.lit(2)))).alias(f"k{i}") for i, p in enumerate(at)
    ]
    sums = rows.join(frame, "__g").groupBy("__g", "__n", "__h", "__lo", "__hi").agg(*kernel)
    norm = F.col("__n") * F.col("__h") * F.sqrt(F.lit(2.0) * F.pi())
    cells = [
        F.struct(F.lit(i).alias("point"), at[i].alias("x"), (F.col(f"k{i}") / norm).alias("density")) for i in range(points)
    ]
    return sums.select(F.col("__g").alias(group), F.explode(F.array(*cells)).alias("c")).select(group, "c.*")


def in_bounds(df: DataFrame, bounds: Mapping[str, tuple], group: str) -> DataFrame:
    """Percentage inside the bounds per metric and group; missing values are left out."""
    aggs = []
    for c, (lo, hi) in bounds.items():
        value = number(c)
        tests = [t for t in (value >= as_bound(lo) if as_bound(lo) is not None else None,
                             value <= as_bound(hi) if as_bound(hi) is not None else None) if t is not None]
        inside = reduce(lambda a, b: a & b, tests) if tests else F.lit(True)
        aggs.append((100 * F.avg(F.when(value.isNotNull(), inside.cast("double")))).alias(c))
    return melt(df.groupBy(group).agg(*aggs), [group], list(bounds)).withColumnRenamed("value", "pct_in_bounds")


def score_summary(df: DataFrame, scores: Sequence[str], group: str, solved: str | None = None, time: str | None = None) -> DataFrame:
    """Means of the non-null scores, solved and unsolved counts, overall and per group."""
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(number(s)).alias(f"avg_{s}") for s in scores]]
    if solved:
        ok = F.count_if(F.col(solved).cast("boolean"))
        aggs += [ok.alias("solved"), (F.count(F.lit(1)) - ok).alias("unsolved"),
                 (100.0 * ok / F.count(F.lit(1))).alias("pct_solved")]
    if time:
        aggs.append(F.avg(number(time)).alias("avg_search_time"))
    out = df.groupingSets([[F.col(group)], []], group).agg(_group_name(df, group).alias("__group"), *aggs)
    return out.drop(group).withColumnRenamed("__group", group)


def route_summary(df: DataFrame, solved: str, score: str, steps: str, precursors: str) -> DataFrame:
    """Share solved over all rows; mean score, steps and precursors over solved rows."""
    ok = F.coalesce(F.col(solved).cast("boolean"), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("solved"),
        ratio(F.count_if(ok), F.count(F.lit(1)), None, 100).alias("solve_rate"),
        *[F.avg(F.when(ok, number(c))).alias(f"avg_{c}") for c in (score, steps, precursors)],
    )


def pose_summary(df: DataFrame, score: str, group: str, unknown: str = "Unknown") -> DataFrame:
    """Mean, best (lowest) and count, overall and per group; the unknown group only counts overall."""
    rows = df.filter(number(score).isNotNull()).select(
        F.coalesce(F.col(group).cast("string"), F.lit(unknown)).alias(group), score
    )
    out = rows.groupingSets([[F.col(group)], []], group).agg(
        _group_name(rows, group).alias("__group"),
        F.avg(score).alias("avg_score"),
        F.min(score).alias("best_score"),
        F.count(score).alias("count"),
    )
    return out.drop(group).withColumnRenamed("__group", group).filter(F.col(group) != unknown)

