"""Range, list, gate and score predicates.

Missing values follow one policy per operator: a missing number fails a range, a missing list
passes a list test, a missing score passes a score filter, a missing mask counts as False.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.numbers import as_bound

Bounds = Mapping[str, tuple]


def no(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


def _between(value: Column, lo, hi) -> Column | None:
    lo, hi = as_bound(lo), as_bound(hi)
    tests = []
    if lo is not None:
        tests.append(value >= F.lit(lo))
    if hi is not None:
        tests.append(value <= F.lit(hi))
    return reduce(lambda a, b: a & b, tests) if tests else None


def _number(value: Column) -> Column:
    d = value.cast("double")
    return F.when(~F.isnan(d), d)


def range_predicate(value: Column, lo=None, hi=None) -> Column:
    """The bounds as plain comparisons, which a filter hands down to the file scan.

    NULL compares to NULL and so fails a filter.  Spark orders NaN above every number: an upper
    bound rejects it, without one it is excluded by name.
    """
    if lo is None and hi is None:
        return F.lit(True)
    test = _between(value, lo, hi)
    if as_bound(hi) is not None:
        return test
    number = ~F.isnan(value.cast("double"))
    return test & number if test is not None else value.isNotNull() & number


def range_test(value: Column, lo=None, hi=None) -> Column:
    """The range as a flag: a missing value fails, with no bounds at all everything passes."""
    return no(range_predicate(value, lo, hi))


def range_filter(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows inside all bounds, without flags."""
    return df.filter(reduce(lambda a, b: a & b, [range_predicate(F.col(c), *b) for c, b in bounds.items()]))


def allowed_test(values: Column, allowed: Sequence) -> Column:
    arr = F.coalesce(values, F.array().cast("array<string>"))
    return no(F.forall(arr, lambda x: F.trim(x).isin(*allowed)))


def elements_test(values: Column, lo=None, hi=None) -> Column:
    arr = F.coalesce(values.cast("array<double>"), F.array().cast("array<double>"))
    if _between(F.lit(0.0), lo, hi) is None:
        return F.lit(True)
    return no(F.forall(arr, lambda x: no(range_predicate(x, lo, hi))))


def gate_test(flag: Column, allowed: bool) -> Column:
    return F.lit(True) if allowed else no(flag.cast("boolean"))


def range_flags(
    df: DataFrame,
    bounds: Bounds,
    allowed: Mapping[str, Sequence] | None = None,
    elements: Bounds | None = None,
    gates: Mapping[str, bool] | None = None,
) -> DataFrame:
    """``<col>_pass`` for every bounded column, list column and gate."""
    flags = {f"{c}_pass": range_test(F.col(c), *b) for c, b in bounds.items()}
    flags |= {f"{c}_pass": allowed_test(F.col(c), a) for c, a in (allowed or {}).items()}
    flags |= {f"{c}_pass": elements_test(F.col(c), *b) for c, b in (elements or {}).items()}
    flags |= {f"{c}_pass": gate_test(F.col(c), ok) for c, ok in (gates or {}).items()}
    return df.withColumns(flags)


def all_flags(flags: Sequence[str | Column], mode: str = "all", missing: bool = False, empty: bool = True) -> Column:
    """AND ("all") or OR ("any") of the flags."""
    cols = [F.coalesce(F.col(f) if isinstance(f, str) else f, F.lit(missing)) for f in flags]
    if not cols:
        return F.lit(empty)
    if mode not in ("all", "any"):
        raise ValueError(f"unknown mode: {mode}")
    return reduce((lambda a, b: a & b) if mode == "all" else (lambda a, b: a | b), cols)


def drop_failing(df: DataFrame, exempt: Sequence[str] = (), suffix: str = "_pass") -> DataFrame:
    """Rows for which every flag column holds; ``exempt`` flags are not looked at."""
    flags = [c for c in df.columns if c.endswith(suffix) and c not in exempt]
    return df.filter(all_flags(flags))


def score_test(bounds: Bounds) -> Column:
    """AND over scores of "missing or inside"; the bounds default to 0 and open.

    A score missing in every row passes everywhere, which is the same as skipping the criterion.
    """
    tests = []
    for c, b in bounds.items():
        lo = b[0] if len(b) > 0 and b[0] is not None else 0.0
        hi = b[1] if len(b) > 1 else None
        value = _number(F.col(c))
        inside = _between(value, lo, hi)
        tests.append(value.isNull() | inside if inside is not None else F.lit(True))
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)


def score_filter(df: DataFrame, bounds: Bounds) -> DataFrame:
    present = {c: b for c, b in bounds.items() if c in df.columns}
    return df.filter(score_test(present))


def severity_flags(df: DataFrame, severity: str, levels: Sequence[int] = tuple(range(1, 12))) -> DataFrame:
    """``pass_s`` for each severity level (row severity below it) and their AND as ``pass``."""
    flags = {f"pass_{s}": no(F.col(severity) < s) for s in levels}
    return df.withColumns({**flags, "pass": all_flags(list(flags.values()))})


def zero_gate(df: DataFrame, column: str, out: str = "pass") -> DataFrame:
    """Pass iff severity or demerit is zero, unless the table already says who passes."""
    if out in df.columns:
        return df
    if "pass_filter" in df.columns:
        return df.withColumn(out, F.col("pass_filter"))
    return df.withColumn(out, no(F.col(column) == 0))


def count_gate(limits: Mapping[str, int]) -> Column:
    """Pass iff every count column stays at or below its limit."""
    return all_flags([F.col(c) <= n for c, n in limits.items()])


# Default limits of the count gates.
HALOGEN_LIMITS = {"n_F": 6, "n_Br": 3, "n_Cl": 3}
STEREO_LIMITS = {"n_stereo": 4, "n_stereo_undefined": 2}
