"""Fragment scores: training, prediction, positions, folding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from winnow.operators.best import extremes
from winnow.session import written

# Fragments of a model that are sent to every task: some 10 MB. Fewer would leave more of a growing vocabulary to a shuffle.
SENT_FRAGMENTS = 100_000


def fit_fragments(df: DataFrame, fragments: str, label: str) -> DataFrame:
    """Score table (fragment, n_pos, n_neg, present, absent, prior).

    The table is written once, as every use of a model reads it more than once.  ``label`` is 1 for the positive class and 0 for the negative one; other rows do not train.
    A fragment counts once per row.  present = ln((p+1)/(n+1)), absent = ln((P-p+1)/(N-n+1)),
    prior = ln((N+2)/(P+2)).
    """
    known = df.filter(F.col(label).isin(0, 1))
    totals = known.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    rows = known.select(F.col(label).alias("__y"), F.explode(F.array_distinct(fragments)).alias("fragment"))
    counts = rows.groupBy("fragment").agg(
        F.count_if(F.col("__y") == 1).alias("n_pos"), F.count_if(F.col("__y") == 0).alias("n_neg")
    )
    return written(score_table(counts, totals.p, totals.n), "fragment-model")


def score_table(counts: DataFrame, total_pos: int, total_neg: int) -> DataFrame:
    pos, neg, p, n = F.lit(total_pos), F.lit(total_neg), F.col("n_pos"), F.col("n_neg")
    return counts.select(
        "fragment",
        "n_pos",
        "n_neg",
        F.log((p + 1) / (n + 1)).alias("present"),
        F.log((pos - p + 1) / (neg - n + 1)).alias("absent"),
        F.log((neg + 2) / (pos + 2)).alias("prior"),
    )


def _frequent_and_rare(model: DataFrame, sent: int) -> tuple[DataFrame, DataFrame]:
    """The ``sent`` fragments of a model that most rows hold, small enough for every task, and the others.

    Nearly all occurrences are of the former, so they are looked up where the rows lie; only the others are shuffled.
    """
    most = model.orderBy((F.col("n_pos") + F.col("n_neg")).desc(), "fragment").limit(sent)
    frequent = F.broadcast(written(most, "frequent-fragments"))
    return frequent, model.join(frequent.select("fragment"), "fragment", "left_anti")


def score_fragments(df: DataFrame, row_id: str, fragments: str, model: DataFrame, only_present: bool = False, sent: int = SENT_FRAGMENTS) -> DataFrame:
    """(row_id, score, n_known) for every row.

    Full score: sum over the vocabulary of prior + absent, plus present - absent for each distinct
    fragment of the row; unknown fragments do not count.  ``only_present``: sum of prior + present.
    """
    gain = F.col("prior") + F.col("present") if only_present else F.col("present") - F.col("absent")
    tokens = df.select(row_id, F.explode(F.array_distinct(fragments)).alias("fragment"))
    frequent, rare = (m.select("fragment", gain.alias("__gain")) for m in _frequent_and_rare(model, sent))
    others = tokens.join(frequent.select("fragment"), "fragment", "left_anti").join(rare, "fragment")
    sums = tokens.join(frequent, "fragment").unionByName(others).groupBy(row_id).agg(
        F.sum("__gain").alias("__sum"), F.count(F.lit(1)).alias("n_known")
    )
    base = 0.0 if only_present else model.agg(F.sum(F.col("prior") + F.col("absent"))).first()[0] or 0.0
    return df.select(row_id).join(sums, row_id, "left").select(
        row_id,
        (F.lit(base) + F.coalesce("__sum", F.lit(0.0))).alias("score"),
        F.coalesce("n_known", F.lit(0)).alias("n_known"),
    )


def count_term(count: Column, scores: Mapping[int, tuple[float, float]], with_absent: bool = True) -> Column:
    """Lookup of a small count, clamped to the largest known one: present score of the own count
    plus the absent scores of all others."""
    top = max(scores)
    own = F.least(count, F.lit(top))
    total_absent = sum(a for _, a in scores.values())
    out = None
    for k, (present, absent) in sorted(scores.items()):
        value = F.lit(present + (total_absent - absent if with_absent else 0.0))
        out = F.when(own == k, value) if out is None else out.when(own == k, value)
    return out


def position_scores(df: DataFrame, row_id: str, position: str, fragment: str, model: DataFrame, sent: int = SENT_FRAGMENTS) -> DataFrame:
    """Sum of present scores of the fragments covering each position; positions without known ones get 0.

    An entry counts as often as it occurs. Frequent fragments are added up where the rows lie, so that a position is
    shuffled once; of the rest only entries are.
    """
    rows = df.select(row_id, position, F.col(fragment).alias("__fragment"))
    frequent, rare = (m.select(F.col("fragment").alias("__fragment"), "present") for m in _frequent_and_rare(model, sent))
    others = rows.join(frequent.select("__fragment"), "__fragment", "left_anti").join(rare, "__fragment")
    scored = rows.join(frequent, "__fragment", "left").unionByName(others)
    return scored.groupBy(row_id, position).agg(F.coalesce(F.sum("present"), F.lit(0.0)).alias("contribution"))


def extreme_fragments(model: DataFrame, k: int) -> DataFrame:
    """The k fragments with the lowest and the k with the highest class-count difference."""
    return extremes(model.withColumn("difference", F.col("n_pos") - F.col("n_neg")), "difference", "fragment", k)


def fold_counts(df: DataFrame, keys: Sequence[str], fragment_id: str, count: str | None, size: int) -> DataFrame:
    """Fold fragment ids modulo ``size`` and add up their counts: (keys..., bucket, n)."""
    n = F.sum(count) if count else F.count(F.lit(1))
    return df.groupBy(*keys, F.pmod(F.col(fragment_id), F.lit(size)).cast("int").alias("bucket")).agg(n.alias("n"))


def dense_counts(folded: DataFrame, key: str, size: int) -> DataFrame:
    """Folded counts as one array of ``size`` numbers per key."""
    cells = folded.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("__m"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.col("__m")[i], F.lit(0)))
    return cells.select(key, vector.alias("counts"))
