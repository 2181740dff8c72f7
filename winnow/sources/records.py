"""Pose records and site structures from text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from winnow.functions.numbers import safe_double
from winnow.functions.text import file_stem, property_key
from winnow.operators.geometry import ATOMS

# a data field: its name and the lines up to the next blank line or field
FIELD = r"(?m)^> *[^<\n]*<([^>\n]+)>[^\n]*\n((?:(?!> *[^<\n]*<)[^\n]+(?:\n|$))*)"


def properties(record: Column) -> Column:
    """Data fields of a record as a map; backslashes in names are dropped, the first of equal names counts."""
    keys = F.transform(F.regexp_extract_all(record, F.lit(FIELD), 1), property_key)
    values = F.regexp_extract_all(record, F.lit(FIELD), 2)
    pairs = F.arrays_zip(keys.alias("key"), values.alias("value"))
    entries = F.transform(pairs, lambda e, i: F.struct(e["key"].alias("key"), F.btrim(e["value"], F.lit(" \t\n")).alias("value"), i.alias("i")))
    first = F.filter(entries, lambda e: F.array_position(keys, e["key"]) == e["i"] + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"], e["value"])))


def atom_block(lines: Column) -> Column:
    """Atoms of a V2000 record: fixed columns after the counts line."""
    n = F.coalesce(F.trim(F.substring(F.get(lines, F.lit(3)), 1, 3)).try_cast("int"), F.lit(0))

    def atom(line: Column) -> Column:
        xyz = [F.trim(F.substring(line, start, 10)).try_cast("double") for start in (1, 11, 21)]
        return F.struct(
            F.trim(F.substring(line, 32, 3)).alias("element"), xyz[0].alias("x"), xyz[1].alias("y"), xyz[2].alias("z")
        )

    return F.transform(F.slice(lines, F.lit(5), F.greatest(n, F.lit(0))), atom).cast(ATOMS)


def record_columns(rows: DataFrame, record: str) -> DataFrame:
    """Replace the text of a record, as cut out between terminators, by its name, props and atoms.

    Line ends may be LF or CRLF.  Three lines stand before the counts line of a record; what is left of the line break
    after the previous terminator goes.
    """
    lines = F.split(F.regexp_replace(record, "\r", ""), "\n")
    rows = rows.withColumn("__lines", lines)
    counts = F.array_position(F.transform("__lines", lambda line: line.rlike("V[23]000\\s*$")), True)
    extra = F.when(counts > 4, counts - 4).when((counts == 0) & (F.get("__lines", F.lit(0)) == ""), 1).otherwise(0)
    rows = rows.withColumn("__lines", F.slice("__lines", extra.cast("int") + 1, F.size("__lines")))
    rows = rows.withColumns(
        {"name": F.trim(F.get("__lines", F.lit(0))), "props": properties(F.array_join("__lines", "\n")), "atoms": atom_block(F.col("__lines"))}
    )
    return rows.drop("__lines", record)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, name, props, atoms) per record.  Records split at their terminator, so large files are read in parallel."""
    raw = spark.read.option("lineSep", "$$$$").text(path)
    rows = raw.select(file_stem(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("record"))
    return record_columns(rows.filter(F.col("record").rlike(r"\S")), "record")


def first_number(props: Column, aliases: Sequence[str]) -> Column:
    return safe_double(*[props[a] for a in aliases])


def scored_records(records: DataFrame, aliases: Sequence[str], score: str = "affinity") -> DataFrame:
    """Named records with the first parseable score among the aliases."""
    return records.filter(F.col("name") != "").withColumn(score, first_number(F.col("props"), aliases))


def site_columns(lines: DataFrame, line: str) -> DataFrame:
    """Replace fixed-width atom lines by element, x, y, z; other and unreadable lines go."""
    lines = lines.filter(F.col(line).rlike("^(ATOM|HETATM)"))
    xyz = {k: F.trim(F.substring(line, start, 8)).try_cast("double") for k, start in (("x", 31), ("y", 39), ("z", 47))}
    symbol = F.trim(F.substring(line, 77, 2))
    by_name = F.regexp_extract(F.substring(line, 13, 4), "([A-Za-z])", 1)
    element = F.initcap(F.when(symbol != "", symbol).otherwise(by_name))
    return lines.withColumns({"element": element, **xyz}).drop(line).dropna(subset=["x", "y", "z"])


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Atom table (site_id, element, x, y, z) from fixed-width coordinate files; unreadable lines are skipped."""
    lines = spark.read.text(path).select(file_stem(F.col("_metadata.file_path")).alias("site_id"), "value")
    return site_columns(lines, "value")
