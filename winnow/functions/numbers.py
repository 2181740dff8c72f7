"""Numeric helpers: NaN policy, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

INF_WORDS = ("inf", "+inf", "infinity")


def nan_to_null(df: DataFrame, *cols: str) -> DataFrame:
    """NaN means "not computed"; Spark orders NaN above every number, so it has to become NULL first."""
    wanted = set(cols)
    floats = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (not wanted or f.name in wanted)
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def as_bound(value) -> float | None:
    """None stays open; the words for infinity and float infinities count as open too."""
    if value is None or (isinstance(value, str) and value.strip().lower() in INF_WORDS):
        return None
    number = float(value)
    return None if number in (float("inf"), float("-inf")) else number


def safe_double(*texts: Column) -> Column:
    """First text of the list that parses as a number."""
    return F.coalesce(*[t.try_cast("double") for t in texts])


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(num: Column, den: Column, empty: float | None = 0.0, scale: float = 1.0) -> Column:
    """scale * num / den with a guard for an empty denominator."""
    return F.when(den > 0, F.lit(float(scale)) * num.cast("double") / den).otherwise(F.lit(empty).cast("double"))
