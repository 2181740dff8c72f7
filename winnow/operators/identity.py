"""Column naming, identity, dedup, sampling and first-n."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from winnow.operators.ranks import IN_TASK_ROWS, row_numbers
from winnow.session import small_or_same, written

# The index format and the group name used when none is given.
INDEX_PREFIX = "LP"
GROUP_WIDTH = 4
COUNTER_WIDTH = 5
DEFAULT_GROUP = "single"

# Of sampling: standard deviations by which the first and the second cut lie above the expected one.
MARGINS = (3.0, 12.0)

# Up to this many rows per group Spark trims each input partition before the shuffle.
SMALL_N = 1000


def resolve_columns(df: DataFrame, aliases: dict[str, Sequence[str]]) -> DataFrame:
    """Rename columns to canonical names, matching any alias without regard to case.

    A column that already has the canonical spelling wins over its aliases.
    """
    lower: dict[str, str] = {}
    for c in df.columns:
        lower.setdefault(c.lower(), c)
    renames = {}
    for target, names in aliases.items():
        if target in df.columns:
            continue
        found = next((lower[n.lower()] for n in (target, *names) if n.lower() in lower), None)
        if found is not None:
            renames[found] = target
    return df.withColumnsRenamed(renames)


def order_columns(df: DataFrame, identity: Sequence[str], suffix: str = "_pass") -> DataFrame:
    """Identity first, then the other columns sorted, each followed by its own flag."""
    rest = [c for c in df.columns if c not in identity]
    plain = sorted(c for c in rest if not c.endswith(suffix))
    flags = {c for c in rest if c.endswith(suffix)}
    ordered = [c for c in identity if c in df.columns]
    for c in plain:
        ordered.append(c)
        if c + suffix in flags:
            ordered.append(c + suffix)
    ordered += sorted(flags.difference(ordered))
    return df.select(*ordered)


def groups(*dfs: DataFrame, group: str) -> DataFrame:
    """Sorted distinct union of the group names of several tables."""
    out = None
    for df in dfs:
        part = df.select(F.col(group).alias(group)).filter(F.col(group).isNotNull()).distinct()
        out = part if out is None else out.union(part)
    return out.distinct().orderBy(group)


def has_many_groups(df: DataFrame, group: str) -> bool:
    return len(df.select(group).filter(F.col(group).isNotNull()).distinct().limit(2).collect()) > 1


def assign_index(
    df: DataFrame,
    group: str | None,
    order: str,
    prefix: str = INDEX_PREFIX,
    out: str = "candidate_idx",
    in_task: int = IN_TASK_ROWS,
) -> DataFrame:
    """``prefix-0001-00001``: group number by first appearance, then a counter inside the group."""
    name = F.coalesce(F.col(group).cast("string"), F.lit(DEFAULT_GROUP)) if group else F.lit(DEFAULT_GROUP)
    base = df.withColumn("__group", name)
    firsts = base.groupBy("__group").agg(F.min(order).alias("__first"))
    numbers = row_numbers(firsts, [], ["__first", "__group"], "__number", in_task).select("__group", "__number")
    numbers = small_or_same(numbers, "group-numbers")
    counted = row_numbers(base, ["__group"], [order], "__counter", in_task)
    text = F.format_string(
        f"{prefix}-%0{GROUP_WIDTH}d-%0{COUNTER_WIDTH}d", F.col("__number"), F.col("__counter")
    )
    return counted.join(numbers, "__group").withColumn(out, text).select(*df.columns, out)


def group_map(df: DataFrame, group: str, idx: str, order: str) -> DataFrame:
    """First index of each group and the group number inside it."""
    first = df.groupBy(group).agg(F.min_by(idx, order).alias("first_idx"))
    return first.withColumn("group_number", F.split("first_idx", "-")[1].try_cast("int"))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``; every map task keeps at most one row per key."""
    cols = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    win = W.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("__rn", F.row_number().over(win)).filter("__rn = 1").drop("__rn")


def dedup(
    df: DataFrame, keys: Sequence[str], row_id: str, keep: str = "first", digest: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) by key; ``row_id`` identifies and orders the rows.

    ``digest`` names a long text key that is replaced by its SHA-256 while grouping, so the text
    itself is not shuffled.  Kept and removed rows are found through the unique row id, hence a key
    with a huge number of copies stays spread out.
    """
    cols = [F.sha2(F.col(k), 256).alias(k) if k == digest else F.col(k) for k in keys]
    pick = F.min if keep == "first" else F.max
    slim = df.select(F.col(row_id).alias("__id"), *cols)
    ids = slim.groupBy(*keys).agg(pick("__id").alias("__id")).select("__id")
    on = df[row_id] == ids["__id"]
    return df.join(ids, on, "left_semi"), df.join(ids, on, "left_anti")


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    return keep_first(df, keys, [F.col(order).desc()])


def head_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int | None) -> DataFrame:
    """First n rows of every group (of the table when ``group`` is empty); n <= 0 or None keeps all."""
    if n is None or n <= 0:
        return df
    if not group and n <= SMALL_N:
        return df.orderBy(*order).limit(n)
    if group and n <= SMALL_N:
        win = W.partitionBy(*group).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(win)).filter(F.col("__rn") <= n).drop("__rn")
    return row_numbers(df, group, order, "__rn").filter(F.col("__rn") <= n).drop("__rn")


def sample_per_group(
    df: DataFrame, group: Sequence[str], row_id: str, n: int | None, seed: int = 42, margins: Sequence[float] = MARGINS
) -> tuple[DataFrame, DataFrame]:
    """Exactly n rows per group, the same ones for the same seed, and the groups that have fewer.

    The n rows of a group are those with the smallest tags, a hash of the row id. The groups are counted first; as tags
    are spread evenly, the n smallest of N lie below n / N of the range plus a margin of so many standard deviations, so
    only rows below that are shuffled, and the exact n are cut from these. A group that comes out short is taken again
    with the next margin, and as a whole after the last. The shortage table is (group..., requested, available); n None
    keeps everything. Missing group keys are a group.
    """
    keys = [F.col(c) for c in group]
    wanted = F.lit(n).cast("long")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("available"))
    short = counts.filter(F.col("available") < wanted).withColumn("requested", wanted)
    short = short.select(*group, "requested", "available")
    if n is None:
        return df, short
    tag = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")))
    tagged = df.withColumn("__tag", tag)
    # a structure is never null itself, so missing keys match each other
    tagged = df.withColumns({"__tag": tag, "__group": F.struct(*keys) if group else F.struct(F.lit(0))})
    left = small_or_same(tagged.groupBy(F.col("__group").alias("__key")).agg(F.count(F.lit(1)).alias("__available")), "group-counts")
    parts = []
    for margin in (*margins, None):
        share = F.lit(1.0) if margin is None else (n + margin * n**0.5 + margin) / F.col("__available")
        # the first eight of a tag's digits, as a number
        below = F.conv(F.substring("__tag", 1, 8), 16, 10).cast("long") < share * 2.0**32
        near = tagged.join(left, F.col("__group") == F.col("__key")).filter(below).select(*df.columns, "__tag", "__group")
        near = written(near, "sample")
        got = near.groupBy("__group").agg(F.count(F.lit(1)).alias("got"))
        lacking = left.join(got, F.col("__group") == F.col("__key"), "left").filter(F.coalesce("got", F.lit(0)) < F.least(wanted, "__available"))
        lacking = written(lacking.select("__key", "__available"), "lacking")
        if lacking.isEmpty():
            parts.append(near)
            break
        parts.append(near.join(lacking, F.col("__group") == F.col("__key"), "left_anti"))
        left = small_or_same(lacking, "lacking-groups")
    found = reduce(DataFrame.unionByName, parts).drop("__group")
    return row_numbers(found, group, ["__tag", row_id], "__rn").filter(F.col("__rn") <= n).drop("__rn", "__tag"), short
