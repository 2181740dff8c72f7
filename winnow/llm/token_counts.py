"""Token counts as an exact length histogram.

Documents are encoded once and counted by their length in tokens; the histogram has one row per length that occurs,
however many documents there are. Sums over its suffixes answer totals, quantiles and truncated totals for any limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from winnow.llm.vocabulary import encoding_of

BLOCK = 1024


def lengths(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """n_tokens per row; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding_of(ranks_path, pattern).encode_ordinary
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(encode(x.as_py() or "")) for x in batch.column(0)], pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "n_tokens long")


def histogram(lengths_: DataFrame) -> DataFrame:
    """n_tokens, n_docs; lengths that are null are left out."""
    return lengths_.where(F.col("n_tokens").isNotNull()).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length that occurs, taken as the context limit L:

    n_docs (of this length), docs_at_least and tokens_at_least (documents of L tokens or more), docs_cut (longer than
    L), truncated_tokens (total when every document is cut to L), quantile (share of documents of at most L tokens).
    Sums run over blocks of lengths first and then within each block, so no task has the whole histogram. An empty
    table gives an empty result.
    """
    hist = hist.withColumn("block", (F.col("n_tokens") / BLOCK).cast("long")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    above = blocks.select("block", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_above"))
    total = blocks.agg(F.sum("d").alias("all_docs"), F.sum("t").alias("all_tokens"))
    within = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    rows = hist.join(above, "block").join(F.broadcast(total), how="cross")  # one row
    rows = rows.withColumn("docs_at_least", F.col("d_above") + F.sum("n_docs").over(within)).withColumn("tokens_at_least", F.col("t_above") + F.sum("tokens").over(within))
    cut = F.col("docs_at_least") - F.col("n_docs")
    return rows.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least", cut.alias("docs_cut"),
        (F.col("all_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("all_docs") - cut) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: DataFrame, limit_col: str = "context") -> DataFrame:
    """docs_cut and truncated_tokens for any limits, whether a document has that length or not: each limit takes the
    next length that occurs. ``limits`` is a stated list; a null or negative limit is left out."""
    wanted = limits.where(F.col(limit_col) >= 0).select(F.col(limit_col).cast("long").alias("at")).distinct()
    marks = sums.select(F.col("n_tokens").alias("at"), F.struct("docs_at_least", "tokens_at_least").alias("s")).unionByName(wanted.withColumn("s", F.lit(None)).withColumn("s", F.col("s").cast("struct<docs_at_least: bigint, tokens_at_least: bigint>")))
    # a limit counts documents longer than it: the sums of the next larger length
    larger = Window.orderBy("at").rangeBetween(1, Window.unboundedFollowing)
    found = marks.withColumn("next", F.first("s", ignorenulls=True).over(larger)).join(wanted, "at", "left_semi")
    all_tokens = sums.agg(F.max("tokens_at_least").alias("all_tokens"))
    beyond = F.coalesce(F.col("next.docs_at_least"), F.lit(0))
    total = F.col("all_tokens") - F.coalesce(F.col("next.tokens_at_least"), F.lit(0)) + F.col("at") * beyond
    return found.join(F.broadcast(all_tokens), how="cross").select(F.col("at").alias(limit_col), beyond.alias("docs_cut"), total.alias("truncated_tokens")).distinct()
