"""Structural complexity from atom and ring tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def quadratic_index(n_atoms: Column, sum_squared_degree: Column) -> Column:
    """max(3 - 2N + sum(degree^2)/2, 0); 1 for fewer than two atoms."""
    value = 3 - 2 * n_atoms + sum_squared_degree / 2.0
    return F.when(n_atoms < 2, F.lit(1.0)).otherwise(F.greatest(value, F.lit(0.0)))


def q1_index(atoms: DataFrame, candidate: str, degree: str) -> DataFrame:
    d = F.col(degree).cast("long")
    sums = atoms.groupBy(candidate).agg(F.count(F.lit(1)).alias("n_atoms"), F.sum(d * d).alias("__sq"))
    return sums.select(candidate, "n_atoms", quadratic_index(F.col("n_atoms"), F.col("__sq")).alias("q1"))


def _names(atoms: str, test) -> Column:
    """Atoms of the list that pass the test."""
    return F.transform(F.filter(atoms, test), lambda a: a["atom"])


def _spiro(atom: Column) -> Column:
    """Whether the atom's first two rings share nothing but that atom."""
    own = F.array_sort(F.filter("rings", lambda r: F.array_contains(r["atoms"], atom)))
    shared = F.array_intersect(F.get(own, F.lit(0))["atoms"], F.get(own, F.lit(1))["atoms"])
    return F.coalesce((F.size(own) > 1) & (F.size(shared) == 1), F.lit(False))


def topological_index(atoms: DataFrame, rings: DataFrame) -> DataFrame:
    """Complexity index per candidate.

    ``atoms``: candidate, atom, degree, element, sp3, aromatic, chiral.  ``rings``: candidate, ring, atom.
    (AR + NAR + CHIRAL + SPIRO + (SP3 + cyclic - acyclic) / (1 + SP3)) * Q1 with four decimals.

    A candidate's atoms and rings are few, so both are gathered once per candidate and everything else is a matter of
    its row.
    """
    fields = ("atom", "degree", "element", "sp3", "aromatic", "chiral")
    per = atoms.groupBy("candidate").agg(F.collect_list(F.struct(*fields)).alias("atoms"))
    # both groupings use the one exchange by candidate
    ringed = rings.repartition("candidate").groupBy("candidate", "ring").agg(F.collect_set("atom").alias("atoms"))
    ringed = ringed.groupBy("candidate").agg(F.collect_list(F.struct("ring", "atoms")).alias("rings"))
    empty = F.array().cast("array<struct<ring:string,atoms:array<string>>>")
    rows = per.join(ringed, "candidate", "left").withColumn("rings", F.coalesce("rings", empty))
    rows = rows.withColumns(
        {
            "aromatic": _names("atoms", lambda a: a["aromatic"]),
            "other": _names("atoms", lambda a: ~a["aromatic"]),
            "in_ring": F.array_distinct(F.flatten(F.transform("rings", lambda r: r["atoms"]))),
            "four": _names("atoms", lambda a: a["degree"] == 4),
        }
    )

    def count(test) -> Column:
        return F.size(F.filter("atoms", test))

    def sp3(a: Column) -> Column:
        return (a["element"] == "C") & a["sp3"]

    def cyclic(a: Column) -> Column:
        return F.array_contains("in_ring", a["atom"])

    has_aromatic = lambda r: F.arrays_overlap(r["atoms"], F.col("aromatic"))
    has_other = lambda r: F.arrays_overlap(r["atoms"], F.col("other"))
    rows = rows.withColumns(
        {
            "n_atoms": F.size("atoms").cast("long"),
            "sq": F.aggregate("atoms", F.lit(0).cast("long"), lambda s, a: s + a["degree"].cast("long") * a["degree"]),
            "carbons": count(lambda a: a["element"] == "C"),
            "n_sp3": count(sp3),
            "n_cyclic": count(lambda a: sp3(a) & cyclic(a) & ~a["aromatic"]),
            "n_acyclic": count(lambda a: sp3(a) & ~cyclic(a)),
            "ar": F.exists("rings", lambda r: has_aromatic(r) & ~has_other(r)),
            "nar": F.exists("rings", lambda r: has_other(r) & ~has_aromatic(r)),
            "chiral": F.exists("atoms", lambda a: a["chiral"]),
            "spiro": F.exists("four", _spiro),
        }
    )

    def frac(c: str) -> Column:
        return F.when(F.col("carbons") > 0, F.col(c) / F.col("carbons")).otherwise(0.0)

    flags = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in ("ar", "nar", "chiral", "spiro")), F.lit(0))
    q1 = quadratic_index(F.col("n_atoms"), F.col("sq"))
    index = (flags + (frac("n_sp3") + frac("n_cyclic") - frac("n_acyclic")) / (1 + frac("n_sp3"))) * q1
    return rows.select("candidate", "n_atoms", q1.alias("q1"), F.round(index, 4).alias("complexity"))
