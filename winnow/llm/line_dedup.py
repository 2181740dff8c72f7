"""Line dedup on content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines chooses where chunks end, so an insertion moves no boundary but
those next to it and the same passage is cut alike wherever it stands. A chunk of several lines that occurs again
anywhere in the table goes; its first occurrence, by document id and place, stays. What is removed has been compared
byte by byte: occurrences are counted by the chunk itself, and its 128-bit key only leads back to the documents.
Only DataFrame functions are used.

Chunks of about three lines miss most passages that are only a few lines long (``without_repeats``, the rule of the
query's SQL). ``without_passages`` takes every two adjacent lines as a piece instead, so it misses none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.storage import written

WINDOW = 2  # lines that decide about a boundary
MEAN_LINES = 3
LEAST_LINES = 2
PRIME = 1_000_003
PLACES = 1 << 31


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often (or in how many inner lambdas) it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def chunks_of(text: Column, mean_lines: int = MEAN_LINES) -> Column:
    """An array of (place, n_lines, chunk); a null text is one chunk of an empty line."""

    def with_lines(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))
        return bound(hashes, lambda found: bound(ends(found), lambda stops: F.transform(stops, chunk(lines, stops))))

    def ends(hashes: Column) -> Column:
        def is_end(i: Column) -> Column:
            rolled = F.get(hashes, i)
            for back in range(1, WINDOW):
                rolled = rolled + F.coalesce(F.get(hashes, i - back), F.lit(0)) * 31**back
            return (i == F.size(hashes) - 1) | (F.pmod(F.pmod(rolled, F.lit(PRIME)), F.lit(mean_lines)) == 0)

        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), is_end)

    def chunk(lines: Column, stops: Column) -> Callable[[Column, Column], Column]:
        def make(end: Column, place: Column) -> Column:
            start = F.when(place == 0, F.lit(0)).otherwise(F.get(stops, place - 1) + 1)
            size = end - start + 1
            return F.struct(place.alias("place"), size.alias("n_lines"), F.array_join(F.slice(lines, start + 1, size), "\n").alias("chunk"))

        return make

    return bound(lines_of(text), with_lines)


def pairs_of(text: Column) -> Column:
    """An array of (place, n_lines, chunk): every two adjacent lines."""

    def pairs(lines: Column) -> Column:
        def pair(line: Column, i: Column) -> Column:
            return F.struct(i.alias("place"), F.lit(2).alias("n_lines"), F.concat(line, F.lit("\n"), F.get(lines, i + 1)).alias("chunk"))

        return F.filter(F.transform(lines, pair), lambda x: x["chunk"].isNotNull())

    return bound(lines_of(text), pairs)


def digest_of(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def repeated_places(docs: DataFrame, id_col: str, text_col: str, chunks: Column, least_lines: int) -> DataFrame:
    """id, digest, places: of each id and text, the chunks that occur at an earlier place of the table."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), digest_of(F.col(text_col)).alias("digest"), chunks.alias("chunks"))
    parts = rows.select("id", "digest", F.explode("chunks").alias("c")).select("id", "digest", "c.*").where(F.col("n_lines") >= least_lines)
    key = (F.xxhash64("chunk").alias("k1"), F.xxhash64(F.lit(1), "chunk").alias("k2"))
    place = F.col("id").cast("decimal(20,0)") * PLACES + F.col("place")
    # counted map-side by the bytes, so a chunk that a third of the documents have is one row of each task
    by_bytes = parts.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min(place.cast("decimal(32,0)")).alias("first"))
    seen = by_bytes.where(F.col("n") > 1).select(*key, "first").groupBy("k1", "k2").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("texts"))
    seen = written(seen.where(F.col("texts") == 1).drop("texts"), "repeated-chunks")
    occurrences = parts.select("id", "digest", F.col("place"), place.cast("decimal(32,0)").alias("at"), *key)
    gone = occurrences.join(seen, ["k1", "k2"]).where(F.col("at") != F.col("first"))
    return gone.groupBy("id", "digest").agg(F.collect_set("place").alias("places"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean_lines: int = MEAN_LINES, least_lines: int = LEAST_LINES) -> DataFrame:
    """One row per input row: id, text without the repeated chunks, n_lines, n_removed (lines).

    Lines end at a line feed; null and empty texts are one empty line. Equal rows are at the same place, so none of them
    loses what is first there; of several texts of one id each loses its own repeats. Rows without an id are neither counted nor changed. Ties of place cannot occur otherwise. Other columns are left
    out; an empty table gives an empty result.
    """
    places = repeated_places(docs, id_col, text_col, chunks_of(F.col(text_col), mean_lines), least_lines)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), digest_of(F.col(text_col)).alias("digest")).join(places, ["id", "digest"], "left")

    def kept(chunks: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(chunks) - 1), F.coalesce("places", F.array().cast("array<int>")))
        stays = F.when(F.col("places").isNull(), chunks).otherwise(F.transform(left, lambda place: F.get(chunks, place)))
        return F.struct(chunks.alias("chunks"), stays.alias("kept"))

    rows = rows.select("id", bound(chunks_of(F.col("text"), mean_lines), kept).alias("both")).select("id", "both.*")
    total = [F.aggregate(c, F.lit(0), lambda n, x: n + x["n_lines"]).cast("long") for c in ("chunks", "kept")]
    return rows.select(
        F.col("id").alias(id_col), F.array_join(F.transform("kept", lambda c: c["chunk"]), "\n").alias("text"),
        total[0].alias("n_lines"), (total[0] - total[1]).alias("n_removed"),
    )


def without_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text without the repeated passages, n_lines, n_removed (lines).

    A passage is any run of two or more adjacent lines. A line goes if it and a neighbour stand in this order at an
    earlier place of the table, by document id and line; whatever the lines around it, no run that occurred before is
    missed, and of every line that goes an equal one stays. Otherwise like ``without_repeats``.
    """
    places = repeated_places(docs, id_col, text_col, pairs_of(F.col(text_col)), 2)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), lines_of(F.col(text_col)).alias("lines"), digest_of(F.col(text_col)).alias("digest")).join(places, ["id", "digest"], "left")
    gone = F.coalesce(F.array_union("places", F.transform("places", lambda i: i + 1)), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone)
    rows = rows.select("id", "lines", left.alias("left"))
    return rows.select(
        F.col("id").alias(id_col), F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("left")).cast("long").alias("n_removed"),
    )
