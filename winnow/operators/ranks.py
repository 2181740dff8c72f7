"""Exact ranks and order statistics that never put a whole group into one task.

A plain ``row_number() over (partition by group)`` sorts each group in a single task, so one
group with a third of the rows becomes the job.  Here a group is cut into ranges of its order
column; only per-range counts are brought together.  The cuts are literals in the plan, so every
branch of the query, and every re-run of a lost task, puts a row into the same range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from winnow.session import shuffle_parts, small_or_same, written

ALL = "(all)"

# A group of at most this many rows is sorted or counted inside one task; larger ones are cut.
IN_TASK_ROWS = 1_000_000

# Ranges are only numbers in an aggregation, so there can be more of them than tasks.
MIN_RANGES = 128
RANGES_PER_TASK = 4
SAMPLE_PER_RANGE = 1000


def _splits(cuts: Sequence[float] | None) -> list[float]:
    inner = sorted({float(c) for c in (cuts or []) if c is not None and c == c and abs(c) != float("inf")})
    # the bucketizer wants at least three split points
    return [float("-inf"), *(inner or [0.0]), float("inf")]


def _probs(parts: int) -> list[float]:
    return [i / parts for i in range(1, parts)]


def with_ranges(df: DataFrame, keys: dict[str, Column], names: dict[str, str]) -> DataFrame:
    """Add ``names[c]``: the range number of numeric key ``c``; missing keys get -1.

    The cuts come from a sample of bounded size, so what is brought together does not grow with the table; they only
    shape the ranges, whose counts are exact.
    """
    parts = max(MIN_RANGES, RANGES_PER_TASK * shuffle_parts(df.sparkSession))
    tmp = {c: f"__key_{i}" for i, c in enumerate(keys)}
    keyed = df.withColumns({tmp[c]: k for c, k in keys.items()})
    share = min(1.0, SAMPLE_PER_RANGE * parts / max(1, df.count()))
    row = keyed.select(*tmp.values()).sample(share, 7).agg(
        *[F.percentile_approx(tmp[c], _probs(parts), 4 * parts).alias(tmp[c]) for c in keys]
    ).first()
    out = {c: f"__cut_{i}" for i, c in enumerate(keys)}
    cutter = Bucketizer(
        inputCols=list(tmp.values()),
        outputCols=list(out.values()),
        splitsArray=[_splits(row[tmp[c]]) for c in keys],
        handleInvalid="keep",
    )
    cut = cutter.transform(keyed)
    cut = cut.withColumns(
        {names[c]: F.when(F.col(tmp[c]).isNull(), -1).otherwise(F.col(out[c]).cast("int")) for c in keys}
    )
    return cut.drop(*tmp.values(), *out.values())


def null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group: a counting pass over the group columns only."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rank", in_task: int = IN_TASK_ROWS
) -> DataFrame:
    """Add the exact 1-based row number per group in ascending order (missing first).

    ``order`` must identify a row within its group; any types that Spark can sort will do. If the largest group,
    which is counted first, does not fit a task, the table is range-partitioned by the whole order (cuts from Spark's
    own bounded sample) and written once with its range number, so that the counts and the numbers see the same ranges.
    """
    group = list(group)
    by = [F.col(c).asc_nulls_first() for c in order]
    if largest_group(df, group) <= in_task:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*group).orderBy(*by)).cast("long"))
    parts = max(MIN_RANGES, RANGES_PER_TASK * shuffle_parts(df.sparkSession))
    cut = written(df.repartitionByRange(parts, *by).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = cut.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*group).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
        F.col("__range").alias("__r"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    offsets = small_or_same(offsets, "offsets")
    inside = W.partitionBy(*group, "__range").orderBy(*by)
    cond = cut["__range"] == offsets["__r"]
    for i, c in enumerate(group):
        cond = cond & cut[c].eqNullSafe(offsets[f"__g{i}"])
    ranked = cut.join(offsets, cond).withColumn(
        out, (F.row_number().over(inside) + F.col("__before")).cast("long")
    )
    return ranked.select(*df.columns, out)


def with_overall(df: DataFrame, group: str) -> DataFrame:
    """Each row once under its own group and once under "(all)"."""
    own = F.col(group).cast("string")
    return df.withColumn(group, F.explode(F.array(own, F.lit(ALL))))


def melt(df: DataFrame, keep: Sequence[str], cols: Sequence[str], extra: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Wide to long: (keep..., metric, value[, extra...]); missing and NaN values are left out."""
    items = []
    for c in cols:
        fields = [F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")]
        fields += [F.col(m[c]).alias(name) for name, m in (extra or {}).items()]
        items.append(F.struct(*fields))
    long = df.select(*keep, F.explode(F.array(*items)).alias("m")).select(*keep, "m.*")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def number(name: str) -> Column:
    """The column as a double, NaN as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def grouped(df: DataFrame, aggs: dict[str, dict[str, Column]], group: str | None, overall: bool) -> DataFrame:
    """Aggregates per metric, computed side by side in one pass and turned to (group, metric, ...) afterwards."""
    flat = [a.alias(f"{m}__{n}") for m, named in aggs.items() for n, a in named.items()]
    if group and overall:
        name = F.when(F.grouping(group) == 1, F.lit(ALL)).otherwise(F.col(group).cast("string"))
        wide = df.groupingSets([[F.col(group)], []], group).agg(name.alias("__name"), *flat)
        wide = wide.drop(group).withColumnRenamed("__name", group)
    else:
        wide = df.groupBy(*([group] if group else [])).agg(*flat)
    rows = [
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{m}__{n}").alias(n) for n in named]) for m, named in aggs.items()
    ]
    keep = [group] if group else []
    return wide.select(*keep, F.explode(F.array(*rows)).alias("m")).select(*keep, "m.*")


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: dict[str, float],
    group: str | None = None,
    overall: bool = False,
    in_task: int = IN_TASK_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles per (group, metric): one column per entry of ``probs``.

    If the largest group has more than ``in_task`` rows: pass 1 counts rows per value range, pass 2
    reads again but shuffles only the ranges that hold a wanted rank, and those as (value, count).
    No group is gathered or sorted as a whole.  Otherwise all (value, count) pairs of a group are
    added up in one task.
    """
    keep = [group] if group else []
    by = [*keep, "metric"]
    slim = df.select(*keep, *dict.fromkeys(cols))
    pos = {k: (F.col("total") - 1) * F.lit(float(p)) for k, p in probs.items()}
    both = bool(group) and overall

    def tally(rows: DataFrame, *more: str) -> DataFrame:
        """Rows per key; the overall group is added up from the groups' own counts."""
        own = rows.groupBy(*by, *more).agg(F.count(F.lit(1)).alias("n"))
        return with_overall(own, group).groupBy(*by, *more).agg(F.sum("n").alias("n")) if both else own

    if largest_group(slim, [] if overall else keep) <= in_task:
        values = tally(melt(slim, keep, cols), "value").withColumns(
            {"range": F.lit(0), "start": F.lit(0), "total": F.sum("n").over(W.partitionBy(*by))}
        )
    else:
        names = {c: f"__range_{i}" for i, c in enumerate(cols)}
        cut = with_ranges(slim, {c: F.col(c).cast("double") for c in cols}, names)
        long = melt(cut, keep, cols, {"range": names})
        run = W.partitionBy(*by).orderBy("range").rowsBetween(W.unboundedPreceding, 0)
        spans = tally(long, "range").select(
            *by,
            "range",
            (F.sum("n").over(run) - F.col("n")).alias("start"),
            F.sum("n").over(run).alias("stop"),
            F.sum("n").over(W.partitionBy(*by)).alias("total"),
        )
        ranks = [f(x).cast("long") for x in pos.values() for f in (F.floor, F.ceil)]
        wanted = spans.filter(
            F.exists(F.array(*ranks), lambda r: (r >= F.col("start")) & (r < F.col("stop")))
        ).select(*[F.col(c).alias(f"w_{c}") for c in [*by, "range"]], "start", "total")
        wanted = small_or_same(wanted, "wanted")
        rows = with_overall(long, group) if both else long
        cond = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(wanted[f"w_{c}"]) for c in [*by, "range"]])
        values = rows.join(wanted, cond).groupBy(*by, "range", "start", "total", "value").agg(F.count(F.lit(1)).alias("n"))
    inner = W.partitionBy(*by, "range").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    placed = values.withColumn("hi", F.col("start") + F.sum("n").over(inner)).withColumn(
        "lo", F.col("hi") - F.col("n")
    )

    def at(rank: Column) -> Column:
        r = rank.cast("long")
        return F.max(F.when((r >= F.col("lo")) & (r < F.col("hi")), F.col("value")))

    aggs = []
    for k, x in pos.items():
        aggs += [at(F.floor(x)).alias(f"{k}__lo"), at(F.ceil(x)).alias(f"{k}__hi")]
    picked = placed.groupBy(*by).agg(F.max("total").alias("total"), *aggs)
    return picked.select(
        *by,
        *[
            (F.col(f"{k}__lo") + (F.col(f"{k}__hi") - F.col(f"{k}__lo")) * (x - F.floor(x))).alias(k)
            for k, x in pos.items()
        ],
    )
