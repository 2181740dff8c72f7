"""Exact dedup by a heavy-hitter split.

A Misra-Gries pass finds the digests that may be frequent (at most 1 / support of them, whatever the table's size).
Their exact winners are counted and sent to all tasks, so the copies of a frequent text are marked where they lie
and never meet in one task. All other digests go through an ordinary shuffle, where no group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.storage import without, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUPPORT = 0.002


def normalised(text: Column | str) -> Column:
    """Null as empty, A-Z in lower case, all else as it is."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)


def frequent_digests(digests: DataFrame, support: float = SUPPORT) -> list[str]:
    """A superset of the digests of more than ``support`` of all rows; at most about 1 / support of them."""
    found = digests.freqItems(["text_sha256"], support).first()
    return sorted(x for x in (found[0] or []) if x is not None)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same bytes after lower-casing A-Z, compared by their SHA-256; null counts as
    empty. The largest id of a group stays; a repeated id stays once per group as often as it occurs. Rows without an
    id form groups with their equals and stay only if no row of the group has an id. Other columns are not looked at.
    An empty table gives an empty result.
    """
    digests = written(
        docs.select(F.col(id_col).alias("id"), F.sha2(normalised(text_col), 256).alias("text_sha256")), "digests"
    )
    summary = (F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    heavy = frequent_digests(digests, support)
    is_heavy = F.col("text_sha256").isin(heavy) if heavy else F.lit(False)
    # every digest of the list becomes one row of this table, so its size has the bound of the Misra-Gries pass
    winners = digests.where(is_heavy).groupBy("text_sha256").agg(*summary)
    marked = digests.where(is_heavy).join(F.broadcast(winners), "text_sha256")
    rest = digests.where(~is_heavy)
    dealt = rest.join(rest.groupBy("text_sha256").agg(*summary), "text_sha256")
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return marked.unionByName(dealt).select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows without an id all stay.

    Rows are told apart by id and text: an id with two texts loses only the one that is a copy. Of several rows with
    the id and text that stay, one does, by the order of the digests of all their columns.
    """
    groups = exact_groups(docs, id_col, text_col, support).where(F.col(id_col).isNotNull())
    marks = groups.groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest")).agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n"))
    marks = written(marks.where(~F.col("_kept") | (F.col("_n") > 1)), "marks")
    same = (docs[id_col] == marks["_id"]) & (F.sha2(normalised(docs[text_col]), 256) == marks["_digest"])
    stay = without(docs, marks.select("_id", "_digest"), {"_id": docs[id_col], "_digest": F.sha2(normalised(docs[text_col]), 256)}, "_id")
    if marks.where("_kept").isEmpty():
        return stay
    repeats = docs.join(marks.where("_kept"), same)
    row = F.struct(*[docs[c] for c in docs.columns])
    one = repeats.groupBy("_id", "_digest").agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("_row"))
    return stay.unionByName(one.select("_row.*"))
