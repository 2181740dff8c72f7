"""Mixing sources to target weights by hierarchical budgeting.

Sources are the leaves of a tree (domain, language, source). A token budget goes down from the root: at each node it is
shared among the children by weight, no child gets more than its subtree can give in ``max_epochs`` passes, and what a
child cannot use goes to its siblings before the node's own shortage goes to the node's siblings. Each leaf then takes
whole passes and the token-prefix of one more pass, in an order that the seed and the pass number fix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.llm.storage import written

BUCKET_DIGITS = 3  # hex digits: the order of a pass is cut into 4,096 buckets per leaf


@dataclass(frozen=True)
class Mix:
    """Levels from the root down, each a name and an expression; relative integer weights per level and value (others: 1)."""

    levels: tuple[tuple[str, str], ...] = (("domain", "source"), ("language", "lang"), ("origin", "source"))
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget_num: int = 1  # budget: this share of all tokens
    budget_den: int = 2
    max_epochs: int = 1
    seed: int = 1
    tokens: str = "(octet_length(text) + 3) div 4"

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.levels]

    def weight(self, name: str) -> Column:
        chosen = F.lit(1)
        for value, weight in self.weights.get(name, {}).items():
            chosen = F.when(F.col(name) == value, F.lit(weight)).otherwise(chosen)
        return chosen.cast("long")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (level columns, tokens) with the tokens each one has to give, as column budget.

    At a node, children are taken by capacity per weight, smallest first; a child whose share of what is left reaches
    its capacity gets just that, the others share the rest by weight. Parts of a token are not given out.
    """
    names = mix.names
    free = F.lit(True)
    for name in names:
        free = free & (mix.weight(name) > 0)
    leaves = leaves.withColumn("capacity", F.when(free, F.col("tokens") * mix.max_epochs).otherwise(0).cast("long"))
    total = leaves.agg(F.least(F.expr(f"sum(tokens) * {mix.budget_num} div {mix.budget_den}"), F.sum("capacity")).cast("long").alias("budget"))
    given = None
    for depth, name in enumerate(names, 1):
        parent, node = names[: depth - 1], names[:depth]
        children = leaves.groupBy(*node).agg(F.sum("capacity").alias("capacity")).withColumn("weight", F.greatest(mix.weight(name), F.lit(1)))
        children = children.join(given, parent) if given is not None else children.join(F.broadcast(total), how="cross")  # one row
        order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
        before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        children = children.withColumn("full", F.col("capacity") * rest <= F.col("weight") * (F.col("budget") - before))
        whole = Window.partitionBy(*parent)
        used = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
        sharing = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
        children = children.withColumn("used", used).withColumn("sharing", sharing)
        share = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr("weight * (budget - used) div sharing"))
        given = children.select(*node, share.cast("long").alias("budget"))
    return leaves.select(*names, "tokens").join(given, names)


def _levels(mix: Mix) -> list[Column]:
    return [F.coalesce(F.expr(e).cast("string"), F.lit("")) for _, e in mix.levels]


def _order(mix: Mix, passes: str, id_: Column, tie: Column | None) -> Column:
    order = F.md5(F.concat(F.lit(f"{mix.seed}:"), passes, F.lit(":"), F.coalesce(id_.cast("string"), F.lit(""))))
    return order if tie is None else F.concat(order, F.coalesce(tie, F.lit("")))


def _placed(docs: DataFrame, mix: Mix, id_col: str, tie: str | None) -> DataFrame:
    """One row per input row: id, the level columns, tokens, budget and passes of its leaf, order, extra (1: in the prefix)."""
    names = mix.names
    levels = [e.alias(n) for n, e in zip(names, _levels(mix), strict=True)]
    ties = [F.expr(tie).cast("string").alias("tie")] if tie else []
    rows = written(docs.select(F.col(id_col).alias("id"), F.coalesce(F.expr(mix.tokens), F.lit(0)).cast("long").alias("tokens"), *levels, *ties), "sized")
    leaves = budgets(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), mix)
    passes = F.when(F.col("leaf_tokens") > 0, F.expr("budget div leaf_tokens")).otherwise(0)
    plan = leaves.withColumnRenamed("tokens", "leaf_tokens").withColumn("passes", passes.cast("long"))
    plan = plan.withColumn("left", F.col("budget") - F.col("passes") * F.col("leaf_tokens"))
    rows = rows.join(plan, names)
    rows = rows.withColumn("order", _order(mix, "passes", F.col("id"), F.col("tie") if tie else None))
    rows = rows.withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    # first where each bucket of a leaf's pass begins, then the order within the one bucket the prefix ends in
    held = rows.groupBy(*names, "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    earlier = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0)))
    rows = rows.join(held, [*names, "bucket"])
    cut = (F.col("before") <= F.col("left")) & (F.col("before") + F.col("bucket_tokens") > F.col("left"))
    upto = Window.partitionBy(*names, "bucket").orderBy("order").rangeBetween(Window.unboundedPreceding, 0)
    inside = rows.where(cut).withColumn("extra", (F.col("before") + F.sum("tokens").over(upto) <= F.col("left")).cast("long"))
    whole = rows.where(~cut).withColumn("extra", (F.col("before") + F.col("bucket_tokens") <= F.col("left")).cast("long"))
    return inside.unionByName(whole)


def copies(docs: DataFrame, mix: Mix, id_col: str = "doc_id", tie: str | None = None) -> DataFrame:
    """One row per input row: id, the level columns, tokens, budget (of its leaf) and copies, the times it is taken.

    A null text has no tokens; a null level value counts as an empty string. Rows without an id are ordered like the
    empty id; ties (repeated ids, within which ``tie``, an expression, may give an order) enter a pass together, last
    ones out together. Rows without tokens go with the pass their place is in. An empty table gives an empty result.
    """
    taken = F.when(F.col("budget") > 0, F.col("passes") + F.col("extra")).otherwise(0).cast("long")
    return _placed(docs, mix, id_col, tie).select(F.col("id").alias(id_col), *mix.names, "tokens", "budget", taken.alias("copies"))


def mixed(docs: DataFrame, mix: Mix, id_col: str = "doc_id", tie: str | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as ``copies`` says, at most ``max_epochs`` times.

    Ids may repeat or be null: no row is looked up by its id. Per leaf, the order of the last row that is taken once
    more decides about each row where it lies.
    """
    names = mix.names
    leaf = [F.col(n).alias(f"_mix_{i}") for i, n in enumerate(names)]
    cuts = _placed(docs, mix, id_col, tie).where("budget > 0").groupBy(*names).agg(F.max("passes").alias("_mix_passes"), F.max(F.when(F.col("extra") == 1, F.col("order"))).alias("_mix_last"))
    cuts = written(cuts.where("_mix_passes > 0 or _mix_last is not null").select(*leaf, "_mix_passes", "_mix_last"), "cuts")
    at = [e.alias(f"_mix_{i}") for i, e in enumerate(_levels(mix))]
    ties = [F.expr(tie).cast("string").alias("_mix_tie")] if tie else []
    rows = docs.select("*", *at, *ties).join(cuts, [f"_mix_{i}" for i in range(len(names))])
    order = _order(mix, "_mix_passes", F.col(id_col), F.col("_mix_tie") if tie else None)
    taken = F.col("_mix_passes") + F.coalesce((order <= F.col("_mix_last")).cast("long"), F.lit(0))
    rows = rows.withColumn("_mix_copies", F.least(taken, F.lit(mix.max_epochs)).cast("int")).where("_mix_copies > 0")
    if mix.max_epochs > 1:
        rows = rows.withColumn("_mix_copies", F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies"))))
    return rows.select(*docs.columns)


def copies_sql(mix: Mix, table: str = "documents", id_col: str = "doc_id", levels: tuple[str, ...] = (), tokens: str = "") -> str:
    """DuckDB SQL for ``copies``; level and token expressions in DuckDB's dialect."""
    names = mix.names

    def weight(name: str) -> str:
        cases = " ".join(f"when {name} = '{v}' then {w}" for v, w in mix.weights.get(name, {}).items())
        return f"(case {cases} else 1 end)" if cases else "1"

    free = " and ".join(f"{weight(n)} > 0" for n in names)
    parts = [
        "r as (select " + f"{id_col} as id, coalesce({tokens}, 0)::bigint as tokens, " + ", ".join(f"coalesce(({e})::varchar, '') as {n}" for n, e in zip(names, levels, strict=True)) + f" from {table})",
        f"leaf as (select *, case when {free} then tokens * {mix.max_epochs} else 0 end as capacity from (select {', '.join(names)}, sum(tokens)::bigint as tokens from r group by all))",
        f"b0 as (select least(sum(tokens) * {mix.budget_num} // {mix.budget_den}, sum(capacity))::bigint as budget from leaf)",
    ]
    for depth, name in enumerate(names, 1):
        parent, node = ", ".join(names[: depth - 1]), ", ".join(names[:depth])
        by = f"partition by {parent} " if parent else ""
        join = f"join b{depth - 1} using ({parent})" if parent else "cross join b0"
        parts += [
            f"c{depth} as (select {node}, sum(capacity)::bigint as capacity, greatest({weight(name)}, 1)::bigint as weight from leaf group by all)",
            f"d{depth} as (select *, capacity * sum(weight) over (o rows between current row and unbounded following) <= weight * (budget - coalesce(sum(capacity) over (o rows between unbounded preceding and 1 preceding), 0)) as is_full from c{depth} {join} window o as ({by}order by capacity / weight, {name}))",
            f"b{depth} as (select {node}, (case when is_full then capacity else weight * (budget - coalesce(sum(case when is_full then capacity end) over ({by}), 0)) // sum(case when not is_full then weight end) over ({by}) end)::bigint as budget from d{depth})",
        ]
    every = ", ".join(names)
    parts += [
        f"p as (select {every}, tokens as leaf_tokens, budget, (case when tokens > 0 then budget // tokens else 0 end) as passes from leaf join b{len(names)} using ({every}))",
        f"o as (select *, md5('{mix.seed}:' || passes || ':' || coalesce(id::varchar, '')) as ord, budget - passes * leaf_tokens as remains from r join p using ({every}))",
        f"f as (select *, sum(tokens) over (partition by {every} order by ord range between unbounded preceding and current row) as upto from o)",
    ]
    return "with " + ",\n".join(parts) + f"\nselect id as {id_col}, {every}, tokens, budget, (case when budget > 0 then passes + (upto <= remains)::int else 0 end)::bigint as copies from f"
