"""Boxes, distances, shapes and deviations of poses.

A pose is a row with its atoms as ``array<struct<element, x, y, z>>``; sites are atom tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from winnow.session import small_or_same

ATOMS = "array<struct<element:string,x:double,y:double,z:double>>"

# Van der Waals radii in angstrom (Bondi) and the radius used for other elements.
VDW_RADII = {
    "H": 1.2, "C": 1.7, "N": 1.55, "O": 1.52, "F": 1.47, "P": 1.8, "S": 1.8, "Cl": 1.75, "Br": 1.85, "I": 1.98,
}
OTHER_RADIUS = 2.0

# Defaults of the pose checks.
CLASH_CUTOFF = 0.75
MAX_DISTANCE = 5.0
SHAPE_ALPHA = 0.81
SHAPE_MIN = 0.5


@dataclass(frozen=True)
class Box:
    center: tuple[float, float, float]
    size: tuple[float, float, float]


def box_from_points(points: DataFrame, margin: float = 0.0) -> Box | None:
    """Bounding box of the points (columns x, y, z), widened by ``margin`` on every side."""
    row = points.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in "xyz" for f in (F.min, F.max)]).first()
    if row.min_x is None:
        return None
    lo = [row[f"min_{c}"] - margin for c in "xyz"]
    hi = [row[f"max_{c}"] + margin for c in "xyz"]
    return Box(
        tuple((a + b) / 2 for a, b in zip(lo, hi)), tuple(b - a for a, b in zip(lo, hi))  # type: ignore[arg-type]
    )


def box_filter(poses: DataFrame, atoms: str, box: Box | None, max_outside: float = 0.0) -> DataFrame:
    """Add ``frac_outside`` and ``pass_search_box``.  No points: all outside.  No box: everything passes."""
    if box is None:
        return poses.withColumns({"frac_outside": F.lit(0.0), "pass_search_box": F.lit(True)})

    def outside(a: Column) -> Column:
        tests = []
        for axis, c, s in zip("xyz", box.center, box.size):
            tests += [a[axis] < c - s / 2.0, a[axis] > c + s / 2.0]
        return reduce(lambda p, q: p | q, tests)

    n = F.size(F.coalesce(F.col(atoms), F.array().cast(ATOMS)))
    frac = F.when(n > 0, F.size(F.filter(atoms, outside)) / n).otherwise(F.lit(1.0))
    marked = poses.withColumn("frac_outside", frac)
    return marked.withColumn("pass_search_box", F.col("frac_outside") <= F.lit(float(max_outside)))


def radius(element: Column, radii: Mapping[str, float] = VDW_RADII) -> Column:
    table = F.create_map(*[F.lit(v) for kv in radii.items() for v in kv])
    return F.coalesce(table[element], F.lit(OTHER_RADIUS))


def _cell(axis: str, width: float) -> Column:
    return F.floor(F.col(axis) / F.lit(width)).cast("long")


def site_contacts(
    poses: DataFrame,
    sites: DataFrame,
    pose_id: str,
    atoms: str,
    site: str,
    max_distance: float = MAX_DISTANCE,
    cutoff: float = CLASH_CUTOFF,
    radii: Mapping[str, float] = VDW_RADII,
) -> DataFrame:
    """Per pose: ``min_distance`` to its site (NULL beyond ``max_distance``), ``clashes``, ``pass_near``, ``pass_clash``.

    Both sides fall into grid cells as wide as the largest distance asked for. The site becomes one row per cell with
    the atoms of the cell and its neighbours (how many fit there is a matter of density, not of table size); small
    tables of cells, and sites are small, are counted and sent to every task. A pose atom meets one row and is folded
    there; the atoms of a pose lie together, so they are added up before anything is shuffled.
    A clash is a pair closer than cutoff * (radius + radius).
    """
    width = max(max_distance, 2 * cutoff * max([*radii.values(), OTHER_RADIUS]))
    a = poses.select(pose_id, F.col(site).alias("__site"), F.explode(atoms).alias("a")).select(
        pose_id, "__site", F.col("a.x").alias("x"), F.col("a.y").alias("y"), F.col("a.z").alias("z"),
        radius(F.col("a.element"), radii).alias("r"),
    )
    a = a.withColumns({f"c{k}": _cell(k, width) for k in "xyz"})
    near = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    b = sites.select(
        F.col(site).alias("__site"), *[F.col(k) for k in "xyz"], radius(F.col("element"), radii).alias("r"),
        *[_cell(k, width).alias(f"o{k}") for k in "xyz"],
    )
    for k in "xyz":
        b = b.withColumn(f"d{k}", F.explode(near)).withColumn(f"c{k}", F.col(f"o{k}") + F.col(f"d{k}"))
    cell = ["__site", "cx", "cy", "cz"]
    b = small_or_same(b.groupBy(*cell).agg(F.collect_list(F.struct("x", "y", "z", "r")).alias("__near")), "site-cells")

    def distance(q: Column) -> Column:
        return F.sqrt(sum((F.pow(F.col(k) - q[k], F.lit(2)) for k in "xyz"), F.lit(0.0)))

    met = a.join(b, cell).select(
        pose_id, F.transform("__near", lambda q: F.struct(distance(q).alias("d"), (cutoff * (F.col("r") + q["r"])).alias("least"))).alias("p")
    )
    met = met.groupBy(pose_id).agg(
        F.min(F.array_min(F.transform(F.filter("p", lambda q: q["d"] <= max_distance), lambda q: q["d"]))).alias("min_distance"),
        F.sum(F.size(F.filter("p", lambda q: q["d"] < q["least"])).cast("long")).alias("clashes"),
    )
    out = poses.join(met, pose_id, "left").withColumn("clashes", F.coalesce("clashes", F.lit(0)))
    return out.withColumns({"pass_near": F.col("min_distance").isNotNull(), "pass_clash": F.col("clashes") == 0})


def gaussian_overlap(a: Column, b: Column, alpha: float = SHAPE_ALPHA) -> Column:
    """First-order Gaussian overlap: sum over atom pairs of exp(-alpha/2 * squared distance)."""
    zero = F.lit(0.0)

    def pair(p: Column, q: Column) -> Column:
        sq = sum(((p[k] - q[k]) * (p[k] - q[k]) for k in "xyz"), zero)
        return F.exp(-F.lit(alpha / 2) * sq)

    return F.aggregate(a, zero, lambda acc, p: acc + F.aggregate(b, zero, lambda s, q: s + pair(p, q)))


def shape_similarity(df: DataFrame, atoms: str, reference: str, alpha: float = SHAPE_ALPHA, min_score: float = SHAPE_MIN) -> DataFrame:
    """Shape Tanimoto of a pose with its reference (both atom lists of the row).

    Without a reference there is no score and the row passes.
    """
    ab = gaussian_overlap(F.col(atoms), F.col(reference), alpha)
    aa, bb = (gaussian_overlap(F.col(c), F.col(c), alpha) for c in (atoms, reference))
    volumes = df.withColumns({"__ab": ab, "__aa": aa, "__bb": bb})
    union = F.col("__aa") + F.col("__bb") - F.col("__ab")
    scored = volumes.withColumn("shape_score", F.col("__ab") / union).drop("__ab", "__aa", "__bb")
    passed = F.col(reference).isNull() | F.coalesce(F.col("shape_score") >= min_score, F.lit(False))
    return scored.withColumn("pass_shape", passed)


def with_rmsd(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add the RMSD of two atom lists after optimal superposition; NULL if they are missing, empty or of different length.

    Only the singular values of the 3 x 3 covariance are needed: the roots of a cubic, in closed form, and the sign of
    its determinant (a reflection does not count as a superposition).
    """
    axes = "xyz"
    pairs = F.arrays_zip(F.col(a).alias("p"), F.col(b).alias("q"))

    def total(f) -> Column:
        return F.aggregate("__pairs", F.lit(0.0), lambda s, e: s + f(e["p"], e["q"]))

    usable = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    df = df.withColumn("__pairs", F.when(usable, pairs)).withColumn("__n", F.size(a).cast("double"))
    sums = {f"__p{i}": total(lambda p, q, i=i: p[i]) for i in axes} | {f"__q{i}": total(lambda p, q, i=i: q[i]) for i in axes}
    sums |= {f"__{i}{j}": total(lambda p, q, i=i, j=j: p[i] * q[j]) for i in axes for j in axes}
    sums |= {"__e": total(lambda p, q: sum((p[i] * p[i] + q[i] * q[i] for i in axes), F.lit(0.0)))}
    df = df.withColumns(sums)
    n = F.col("__n")
    h = {i + j: F.col(f"__{i}{j}") - F.col(f"__p{i}") * F.col(f"__q{j}") / n for i in axes for j in axes}
    energy = F.col("__e") - sum((F.col(f"__{s}{i}") * F.col(f"__{s}{i}") for s in "pq" for i in axes), F.lit(0.0)) / n
    df = df.withColumns({**{f"__h{k}": v for k, v in h.items()}, "__energy": energy})
    g = {i + j: sum((F.col(f"__h{k}{i}") * F.col(f"__h{k}{j}") for k in axes), F.lit(0.0)) for i in axes for j in axes if i <= j}
    df = df.withColumns({**{f"__m{k}": v for k, v in g.items()}, "__det": _determinant({k: F.col(f"__h{k}") for k in h})})
    m = {k: F.col(f"__m{min(k)}{max(k)}") for k in h}
    third = (m["xx"] + m["yy"] + m["zz"]) / 3.0
    df = df.withColumn("__third", third)
    off = m["xy"] * m["xy"] + m["xz"] * m["xz"] + m["yz"] * m["yz"]
    around = sum(((m[i + i] - F.col("__third")) * (m[i + i] - F.col("__third")) for i in axes), F.lit(0.0)) + 2.0 * off
    df = df.withColumn("__spread", F.sqrt(around / 6.0))
    unit = {k: (m[k] - F.col("__third") if k[0] == k[1] else m[k]) / F.col("__spread") for k in h}
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _determinant(unit) / 2.0))) / 3.0
    df = df.withColumn("__angle", F.when(F.col("__spread") > 0, angle).otherwise(0.0))
    high = F.col("__third") + 2.0 * F.col("__spread") * F.cos("__angle")
    low = F.col("__third") + 2.0 * F.col("__spread") * F.cos(F.col("__angle") + F.lit(2.0943951023931953))
    df = df.withColumns({"__high": high, "__low": low})
    roots = [F.sqrt(F.greatest(x, F.lit(0.0))) for x in (F.col("__high"), 3.0 * F.col("__third") - F.col("__high") - F.col("__low"), F.col("__low"))]
    overlap = roots[0] + roots[1] + F.when(F.col("__det") < 0, -roots[2]).otherwise(roots[2])
    rmsd = F.sqrt(F.greatest(F.col("__energy") - 2.0 * overlap, F.lit(0.0)) / n)
    df = df.withColumn(out, F.when(F.col("__pairs").isNotNull(), rmsd))
    return df.drop(*[c for c in df.columns if c.startswith("__") and c not in (a, b, out)])


def _determinant(h: Mapping[str, Column]) -> Column:
    return (
        h["xx"] * (h["yy"] * h["zz"] - h["yz"] * h["zy"])
        - h["xy"] * (h["yx"] * h["zz"] - h["yz"] * h["zx"])
        + h["xz"] * (h["yx"] * h["zy"] - h["yy"] * h["zx"])
    )


def min_rmsd(
    poses: DataFrame, conformers: DataFrame, pose_id: str, key: str, atoms: str, max_rmsd: float = 3.0, permutations: DataFrame | None = None
) -> DataFrame:
    """Smallest deviation of a pose from the conformers supplied for its ``key``.

    Atoms correspond by position.  ``permutations`` (key, permutation: array of 0-based positions) adds equivalent
    numberings of the conformer's atoms; the smallest deviation over all of them counts.  No usable conformer: infinite
    deviation, the pose fails.
    """
    a = poses.select(pose_id, key, F.col(atoms).alias("a"))
    b = conformers.select(key, F.col(atoms).alias("b"))
    if permutations is not None:
        other = b.join(permutations.select(key, "permutation"), key)
        b = b.unionByName(other.select(key, F.transform("permutation", lambda i: F.get("b", i)).alias("b")))
    d = with_rmsd(a.join(b, key), "a", "b", "d")
    best = d.groupBy(pose_id).agg(F.min("d").alias("min_rmsd"))
    out = poses.join(best, pose_id, "left").withColumn("min_rmsd", F.coalesce("min_rmsd", F.lit(float("inf"))))
    return out.withColumn("pass_deviation", F.col("min_rmsd") <= max_rmsd)


# Interaction kinds that count as hydrogen bonds.
BOND_KINDS = ("HBDonor", "HBAcceptor")


def contact_check(
    poses: DataFrame,
    contacts: DataFrame,
    pose_id: str,
    min_bonds: int = 0,
    required: Sequence[str] = (),
    forbidden: Sequence[str] = (),
    bond_kinds: Sequence[str] = BOND_KINDS,
) -> DataFrame:
    """Interaction check over (pose, residue, interaction, present) rows.

    Residues match as substrings.  A required residue that occurs in no contact of the whole table
    is not enforced.
    """
    seen: set[str] = set()
    if required:
        row = contacts.agg(*[F.bool_or(F.col("residue").contains(r)).alias(f"r{i}") for i, r in enumerate(required)]).first()
        seen = {r for i, r in enumerate(required) if row[i]}
    kinds = reduce(lambda x, y: x | y, [F.col("interaction").contains(k) for k in bond_kinds])
    # one row per distinct contact first: repeated contacts of one pose are folded before they meet
    distinct = contacts.groupBy(pose_id, "residue", "interaction").agg(F.bool_or("present").alias("present")).filter("present")
    label = F.concat_ws(".", "residue", "interaction")
    tests = {f"__has_{i}": F.bool_or(F.col("residue").contains(r)) for i, r in enumerate(required) if r in seen}
    bad = [F.bool_or(F.col("residue").contains(r)) for r in forbidden]
    aggs = [
        F.count_if(kinds).alias("n_hbonds"),
        F.array_join(F.array_sort(F.collect_set(label)), ",").alias("interactions"),
        (reduce(lambda x, y: x | y, bad) if bad else F.lit(False)).alias("__bad"),
        *[t.alias(n) for n, t in tests.items()],
    ]
    out = poses.join(distinct.groupBy(pose_id).agg(*aggs), pose_id, "left")
    out = out.withColumns(
        {"n_hbonds": F.coalesce("n_hbonds", F.lit(0)), "interactions": F.coalesce("interactions", F.lit(""))}
    )
    ok = (F.col("n_hbonds") >= min_bonds) & ~F.coalesce("__bad", F.lit(False))
    for n in tests:
        ok = ok & F.coalesce(n, F.lit(False))
    return out.withColumn("pass_interactions", ok).drop("__bad", *tests)
