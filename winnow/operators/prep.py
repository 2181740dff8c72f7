"""Ordered row checks with the first failing reason, and the metrics of a preparation step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from winnow.operators.flags import no

# Reason and step of the strict checks, in order.
STRICT_CHECKS = (
    ("disallowed_atoms", "filters"),
    ("radicals", "filters"),
    ("isotopes", "filters"),
    ("charged", "filters"),
    ("multifragment", "filters"),
)


def first_failure(df: DataFrame, rules: Sequence[tuple[Column, str, str]]) -> DataFrame:
    """Add ``reason`` and ``step`` of the first rule whose condition holds, NULL for clean rows."""
    reason = step = None
    for cond, why, where in rules:
        hit = no(cond)
        reason = F.when(hit, why) if reason is None else reason.when(hit, why)
        step = F.when(hit, where) if step is None else step.when(hit, where)
    return df.withColumns({"reason": reason, "step": step})


def strict_rules(symbols: Column, allowed: Sequence[str], radical: Column, isotope: Column, charged: Column, fragments: Column):
    bad = F.exists(symbols, lambda s: ~s.isin(*allowed))
    conds = (bad, radical, isotope, charged, fragments > 1)
    return [(c, reason, step) for c, (reason, step) in zip(conds, STRICT_CHECKS)]


def prep_metrics(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in, passed, failed, duplicates removed, failures by reason as JSON with sorted keys.

    ``checked`` is the output of ``first_failure``; duplicates are counted among passing rows.
    """
    ok = F.col("reason").isNull()
    # counting (reason) first leaves only one row per reason for the single summary row
    by_reason = checked.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    distinct = checked.filter(ok).select(*keys).distinct().select(F.lit(1).alias("one"))
    counted = by_reason.select("reason", "n", F.lit(0).cast("long").alias("d")).union(
        distinct.agg(F.lit(None).cast("string"), F.lit(0).cast("long"), F.count("one"))
    )
    entry = F.when(~ok, F.struct(F.col("reason").alias("key"), F.col("n").alias("value")))
    rows = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("passed"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("failed"),
        F.sum("d").alias("__distinct"),
        F.sort_array(F.collect_list(entry)).alias("__entries"),
    )
    return rows.select(
        "rows_in",
        "passed",
        "failed",
        (F.col("passed") - F.col("__distinct")).alias("dedup_removed"),
        F.to_json(F.map_from_entries("__entries")).alias("failures_by_reason"),
    )
