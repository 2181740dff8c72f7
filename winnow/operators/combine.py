"""Combining masks and tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from winnow.operators.flags import all_flags, no


def key_value(df: DataFrame, name: str) -> Column:
    """A key for comparing: NaN counts as missing."""
    col = df[name]
    return F.when(~F.isnan(col), col) if df.schema[name].dataType.typeName() in ("float", "double") else col


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which missing keys (NULL, NaN) match each other; the key columns appear once."""
    side = right.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [key_value(left, k).eqNullSafe(key_value(side, f"__key_{k}")) for k in keys])
    joined = left.join(side, on, how)
    if how == "full_outer":
        joined = joined.withColumns({k: F.coalesce(k, f"__key_{k}") for k in keys})
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__key_{k}" for k in keys])


def mask_table(
    df: DataFrame, masks: Mapping[str, DataFrame | None], keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """``df`` with one ``pass_<name>`` per mask table; the last entry per key in ``order`` wins, missing is False.

    A mask table may carry only some of the keys; it then holds for all rows with those values. Mask tables with the
    same keys are stacked and folded in one aggregation, so N masks cost one shuffle and one join instead of N joins.
    A mask table without the ``order`` column must have each key once: a repeated one ends the query with an error,
    because nothing says which entry is the last.
    """
    by_keys: dict[tuple[str, ...], dict[str, DataFrame]] = {}
    for name, m in masks.items():
        flag = None if m is None else "pass" if "pass" in m.columns else "pass_filter" if "pass_filter" in m.columns else None
        own = () if m is None else tuple(k for k in keys if k in m.columns)
        if flag is None or not own:
            continue
        ranked = bool(order) and order in m.columns
        rank = F.col(order) if ranked else F.lit(None)
        values = [key_value(m, k).alias(k) for k in own]
        by_keys.setdefault(own, {})[name] = m.select(
            *values, F.lit(name).alias("__mask"), F.col(flag).alias("__pass"), rank.cast("long").alias("__ord"), F.lit(ranked).alias("__ranked")
        )
    out = df
    for own, tables in by_keys.items():
        folded = reduce(DataFrame.unionByName, tables.values()).groupBy(*own).agg(*[_last_flag(n) for n in tables])
        out = join_on(out, folded, own, "left")
    held = {n for tables in by_keys.values() for n in tables}
    return out.withColumns({f"pass_{n}": no(F.col(f"pass_{n}")) if n in held else F.lit(False) for n in masks}) if masks else out


def _last_flag(name: str) -> Column:
    """The flag of the entry with the highest order; booleans and longs keep the fold a hash aggregation."""
    own = F.col("__mask") == name
    last = F.max_by(F.when(own, F.col("__pass")), F.when(own, F.coalesce("__ord", F.lit(-(2**62)))))
    unclear = F.count_if(own & ~F.col("__ranked")) > 1
    return F.when(unclear, F.raise_error(F.lit(f"mask {name} has a key twice and no order column")).cast("boolean")).otherwise(last).alias(f"pass_{name}")


def combine_masks(
    df: DataFrame,
    masks: Mapping[str, DataFrame | None],
    keys: Sequence[str],
    order: str | None = None,
    mode: str = "all",
) -> tuple[DataFrame, DataFrame]:
    """(passed, failed); failed rows keep the mask columns.  Without any mask nobody passes."""
    table = mask_table(df, masks, keys, order)
    flags = [f"pass_{n}" for n in masks]
    ok = all_flags(flags, mode, empty=False)
    return table.filter(ok).select(*df.columns), table.filter(~ok)


def intersect_survivors(df: DataFrame, survivors: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows whose key survives in every table."""
    stacked = reduce(
        DataFrame.union,
        [s.select(*keys, F.lit(i).alias("__i")) for i, s in enumerate(survivors)],
    )
    full = stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__i") == i, 1)).alias(f"__s{i}") for i in range(len(survivors))]
    )
    everywhere = full.filter(reduce(lambda a, b: a & b, [F.col(f"__s{i}") == 1 for i in range(len(survivors))]))
    return join_on(df, everywhere.select(*keys), keys, "left_semi")


def split_failed(df: DataFrame, passed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Input rows whose key is not among the survivors; repeated rows all stay."""
    return join_on(df, passed.select(*keys), keys, "left_anti")


def backfill(df: DataFrame, flags: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "left") -> DataFrame:
    """Take flag columns from ``flags``, else the row's own, else False."""
    other = flags.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols])
    joined = join_on(df, other, keys, "full_outer" if how in ("full", "outer", "fullouter") else how)
    filled = {}
    for c in cols:
        own = [F.col(c)] if c in df.columns else []
        filled[c] = F.coalesce(F.col(f"__{c}"), *own, F.lit(False))
    return joined.withColumns(filled).drop(*[f"__{c}" for c in cols])


def lookup(
    df: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    values: Mapping[str, object],
    order: str | None = None,
) -> DataFrame:
    """First match per key with a default for every value column; input rows and duplicates stay.

    ``order`` says which match is first; it may be left out when the key is unique on the right.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(values)
    if order:
        firsts = right.groupBy(*keys).agg(
            F.min_by(F.struct(*cols), order).alias("__v")
        ).select(*keys, *[F.col("__v")[c].alias(f"__{c}") for c in cols])
    else:
        firsts = right.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols])
    joined = df.drop(*cols).join(firsts, keys, "left")
    out = {c: F.coalesce(F.col(f"__{c}"), F.lit(d) if d is not None else F.lit(None)) for c, d in values.items()}
    return joined.withColumns(out).drop(*[f"__{c}" for c in cols])


def lookup_or(df: DataFrame, right: DataFrame, key: str, value: str, fallback: Column, order: str | None = None) -> DataFrame:
    """Looked-up value, or an expression of the row when the key is unknown."""
    return lookup(df, right, key, {value: None}, order).withColumn(value, F.coalesce(F.col(value), fallback))


def recover_identity(df: DataFrame, identity: DataFrame, keys: Sequence[str], idx: str, order: str) -> DataFrame:
    """Attach the index a (text, group) pair got first."""
    return lookup(df, identity, keys, {idx: None}, order)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack tables with different columns; absent ones become NULL, nothing is deduplicated."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def short_circuit(
    df: DataFrame,
    keys: Sequence[str],
    gate: Column,
    expensive: Callable[[DataFrame], DataFrame],
    flag: str,
) -> DataFrame:
    """Evaluate ``expensive`` only on rows that pass ``gate``; for all others its flag is False.

    Catalyst does not promise to skip a Python function inside a conditional, so the rows are really filtered before
    it. The rows come back by a union: nothing is joined, and repeated rows stay as often as they were given.
    ``expensive`` must keep the columns of its input and add ``flag`` (missing counts as False); ``keys`` are kept for
    callers that name them and are not compared.
    """
    scored = expensive(df.filter(no(gate)))
    scored = scored.select(*[c for c in df.columns if c != flag], no(F.col(flag)).alias(flag))
    rest = df.filter(~no(gate)).select(*[c for c in df.columns if c != flag], F.lit(False).alias(flag))
    return scored.unionByName(rest)


def fail_policy(flag: Column, evaluated: Column, on_error: bool = True, on_absent: bool = False) -> Column:
    """An evaluator that failed on a row leaves NULL and the row passes; a row never evaluated fails."""
    return F.coalesce(flag, F.when(no(evaluated), F.lit(on_error)).otherwise(F.lit(on_absent)))
