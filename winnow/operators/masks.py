"""Statistics over masks and reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from winnow.functions.numbers import half_even, ratio
from winnow.operators.best import top_counts
from winnow.operators.ranks import number


def share(flag: Column) -> Column:
    return F.avg(flag.cast("double"))


def mask_stats(
    df: DataFrame, group: str, sets: Sequence[str], valid: Column | None = None
) -> DataFrame:
    """Per group: rows, share failing all-sets, share failing any-set, share failing each set.

    Rows are counted before unreadable ones (``valid`` false) are dropped, shares after.
    """
    ok = F.lit(True) if valid is None else valid

    def banned(name: str) -> Column:
        return 1 - share(F.when(ok, F.col(name)))

    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_mol"),
        banned("pass").alias("all_banned_ratio"),
        banned("pass_any").alias("any_banned_ratio"),
        *[banned(f"pass_{s}").alias(f"{s}_banned_ratio") for s in sets],
    )


def severity_stats(df: DataFrame, group: str, levels: Sequence[int] = tuple(range(1, 12))) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_mol"),
        *[(1 - share(F.col(f"pass_{s}"))).alias(f"banned_ratio_s_{s}") for s in levels],
    )


def single_mask_stats(df: DataFrame, group: str, flag: str = "pass") -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_mol"), (1 - share(F.col(flag))).alias("banned_ratio")
    )


def severity_summary(df: DataFrame, group: str, severity: str, motifs: str, special: str, flag: Column) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_mol"),
        F.avg(number(severity)).alias("mean_severity"),
        F.max(F.when(~F.isnan(F.col(severity).cast("double")), F.col(severity))).alias("max_severity"),
        F.avg(number(motifs)).alias("mean_n_covalent_motif"),
        share(F.coalesce(F.col(special) > 0, F.lit(False))).alias("mean_nonzero_special_mol"),
        (1 - share(flag)).alias("banned_ratio"),
    )


def demerit_summary(df: DataFrame, group: str, demerit: str, flag: Column) -> DataFrame:
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("num_mol"),
        F.avg(number(demerit)).alias("mean_noNA_demerit_score"),
        (1 - share(flag)).alias("banned_ratio"),
    )


def _stack(df: DataFrame, keep: Sequence[str], sets: Sequence[str], fields: dict[str, str]) -> DataFrame:
    rows = [
        F.struct(F.lit(s).alias("rule_set"), *[F.col(f.format(s)).alias(n) for n, f in fields.items()]) for s in sets
    ]
    return df.select(*keep, F.explode(F.array(*rows)).alias("r")).select(*keep, "r.*")


def failure_counts(df: DataFrame, sets: Sequence[str]) -> DataFrame:
    """Per rule set: failed rows, total rows, percentage.  Counted wide, then turned: no row is multiplied."""
    wide = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(~F.col(f"pass_{s}")).alias(f"n_{s}") for s in sets],
    )
    out = _stack(wide, ["total"], sets, {"failures": "n_{}"})
    return out.select("rule_set", "failures", "total", ratio(F.col("failures"), F.col("total"), scale=100).alias("percentage"))


def reason_counts(df: DataFrame, sets: Sequence[str]) -> DataFrame:
    """Reasons of the failed rows of every rule set; a row may count for several reasons."""
    none = F.array().cast("array<struct<rule_set:string,reason:string>>")

    def named(s: str) -> Column:
        parts = F.split(F.coalesce(F.col(f"reasons_{s}"), F.lit("")), ";")
        pairs = F.transform(parts, lambda r: F.struct(F.lit(s).alias("rule_set"), F.trim(r).alias("reason")))
        return F.when(~F.col(f"pass_{s}"), pairs).otherwise(none)

    pairs = [named(s) for s in sets]
    exploded = df.select(F.explode(F.concat(*pairs)).alias("r")).select("r.*").filter("reason <> ''")
    return exploded.groupBy("rule_set", "reason").agg(F.count(F.lit(1)).alias("count"))


def reason_shares(reasons: DataFrame, failures: DataFrame) -> DataFrame:
    """Every reason with its share of the rule set's failures."""
    joined = reasons.join(failures.select("rule_set", "failures"), "rule_set")
    return joined.withColumn("share", ratio(F.col("count"), F.col("failures"), scale=100))


def reason_totals(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.sum("count").alias("total_count"))


def top_reasons(reasons: DataFrame, k: int = 30) -> DataFrame:
    return top_counts(reason_totals(reasons), "reason", "total_count", k)


def rule_summary(reasons: DataFrame, failures: DataFrame, top: int = 5) -> DataFrame:
    """Per rule set: failures, percentage, number of reasons, its top reasons side by side."""
    win = W.partitionBy("rule_set").orderBy(F.col("count").desc(), "reason")
    best = reasons.withColumn("rank", F.row_number().over(win)).filter(F.col("rank") <= top)
    wide = best.groupBy("rule_set").agg(
        *[
            F.max(F.when(F.col("rank") == i, F.col(src))).alias(name)
            for i in range(1, top + 1)
            for src, name in (("reason", f"top_reason_{i}"), ("count", f"top_reason_{i}_count"))
        ]
    )
    unique = reasons.groupBy("rule_set").agg(F.count(F.lit(1)).alias("unique_reasons"))
    joined = failures.join(unique, "rule_set", "left").join(wide, "rule_set", "left")
    out = joined.withColumn("unique_reasons", F.coalesce("unique_reasons", F.lit(0)))
    shares = {
        f"top_reason_{i}_percentage": F.when(
            F.col(f"top_reason_{i}_count").isNotNull(),
            ratio(F.col(f"top_reason_{i}_count"), F.col("failures"), scale=100),
        )
        for i in range(1, top + 1)
    }
    return out.withColumns(shares)


def survivor_counts(df: DataFrame, group: str, sets: Sequence[str]) -> DataFrame:
    """Survivors per (filter, group), with a zero row for every pair that has none."""
    wide = df.groupBy(group).agg(*[F.count_if(F.col(f"pass_{s}")).alias(f"n_{s}") for s in sets])
    return _stack(wide, [group], sets, {"survivors": "n_{}"})


def counts_from_ratios(stats: DataFrame, ratios: Sequence[str], main: str, total: str = "num_mol") -> DataFrame:
    """Ratios back to failed counts, passed = total - failed, pass rate in percent with one decimal.

    Rounding is half-even; a missing ratio means nothing failed.
    """
    n = F.col(total)
    failed = {f"{r}_failed": F.coalesce(F.rint(n * F.col(r)), F.lit(0.0)).cast("long") for r in ratios}
    passed = n - F.coalesce(F.rint(n * F.col(main)), F.lit(0.0)).cast("long")
    rate = F.coalesce(half_even((1 - F.col(main)) * 100, 1), F.lit(100.0))
    return stats.withColumns({**failed, "passed": passed, "pass_rate": rate})


def banned_ratio(df: DataFrame, group: str) -> DataFrame:
    """Mean of the ratios per group, or failed / total when only counts are there."""
    if "banned_ratio" in df.columns:
        return df.groupBy(group).agg(F.avg("banned_ratio").alias("banned_ratio"))
    sums = df.groupBy(group).agg(F.sum("failed_count").alias("f"), F.sum("total_count").alias("t"))
    return sums.filter("t > 0").select(group, (F.col("f") / F.col("t")).alias("banned_ratio"))


def matrix(df: DataFrame, rows: str, cols: str, values: Sequence[str], cell: Column, prefix: str = "") -> DataFrame:
    """One row per ``rows``, one column per entry of ``values``, absent cells are 0."""
    wide = df.groupBy(rows).pivot(cols, list(values)).agg(cell)
    return wide.select(rows, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(prefix + str(v)) for v in values])


def pose_mask_summary(df: DataFrame, flags: Sequence[str], flag: str = "pass") -> DataFrame:
    """Long table (filter, passed, total, pass_rate): "all" first counts rows, then each mask its non-null rows."""
    wide = df.agg(
        F.count(F.lit(1)).alias("t_all"),
        F.count_if(F.col(flag)).alias("p_all"),
        *[F.count(f).alias(f"t_{f}") for f in flags],
        *[F.count_if(F.col(f)).alias(f"p_{f}") for f in flags],
    )
    rows = [
        F.struct(F.lit(f.removeprefix("pass_")).alias("filter"), F.col(f"p_{f}").alias("passed"), F.col(f"t_{f}").alias("total"))
        for f in ["all", *flags]
    ]
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("pass_rate", half_even(ratio(F.col("passed"), F.col("total"), scale=100), 1))


def pose_group_summary(df: DataFrame, group: str, entity: str, flag: str = "pass") -> DataFrame:
    out = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag)).alias("passed"),
        F.countDistinct(F.when(F.col(flag), F.col(entity))).alias("unique_passed"),
    )
    return out.withColumn("pass_rate", half_even(ratio(F.col("passed"), F.col("total"), scale=100), 1))


def zero_share(df: DataFrame, score: str) -> DataFrame:
    return df.agg(F.count_if(F.col(score) == 0).alias("zero"), F.count(F.lit(1)).alias("total"))
