import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from winnow.operators import complexity, fingerprint as fp, geometry as geo


def tanimoto(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def fingerprints(n, bits, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if out and rng.random() < 0.6:
            base = set(rng.choice(out)[2])
            for _ in range(rng.randint(0, 4)):
                base ^= {rng.randrange(bits)}
        else:
            base = set(rng.sample(range(bits), rng.randint(1, min(bits, 30))))
        out.append((i, f"g{i % 2}", sorted(base)))
    return out


def test_similarity_join_is_exact(spark):
    for bits, n in ((64, 120), (512, 120)):
        data = fingerprints(n, bits)
        df = spark.createDataFrame(data, "id int, g string, bits array<int>").cache()
        reps = {}
        for i, _, b in data:
            reps.setdefault(tuple(b), []).append(i)
        firsts = {ids[0]: (b, len(ids)) for b, ids in reps.items() if b}
        for t in (0.35, 0.6, 0.8, 1.0):
            want = {
                (i, j): (firsts[i][1], firsts[j][1])
                for i, j in itertools.combinations(sorted(firsts), 2)
                if tanimoto(firsts[i][0], firsts[j][0]) >= t
            }
            for method in ("index", "blocks") if t in (0.35, 0.8) else ("index",):
                got = fp.similar_pairs(df, "id", "bits", t, bits, method, block_rows=17).collect()
                assert {(r.id_a, r.id_b): (r.copies_a, r.copies_b) for r in got} == want
                assert len(got) == len(want)
                for r in got:
                    assert math.isclose(r.similarity, tanimoto(firsts[r.id_a][0], firsts[r.id_b][0]))
        members = dict(fp.fingerprint_groups(df, "id", "bits")[1].collect())
        assert members == {i: ids[0] for ids in reps.values() for i in ids}


def test_diversity_against_brute_force(spark):
    data = fingerprints(60, 64, seed=9)
    df = spark.createDataFrame(data, "id int, g string, bits array<int>")
    div = {r.g: r for r in fp.int_div(df, "g", "id", "bits", 64).collect()}
    cover = {r.g: r for r in fp.sphere_exclusion(df, "g", "id", "bits", 64, distance=0.4).collect()}
    profile = {r.id: r for r in fp.tanimoto_profile(df, "g", "id", "bits", 64).collect()}
    for g in ("g0", "g1"):
        sets = [(i, b) for i, gg, b in data if gg == g]
        sims = [tanimoto(a, b) for _, a in sets for _, b in sets]
        assert math.isclose(div[g].int_div1, 1 - np.mean(sims), abs_tol=1e-9)
        assert math.isclose(div[g].int_div2, 1 - math.sqrt(np.mean(np.square(sims))), abs_tol=1e-9)
        picks = []
        for _, b in sets:
            if all(1 - tanimoto(b, p) > 0.4 + 1e-12 for p in picks):
                picks.append(b)
        assert cover[g].picks == len(picks)
        i, b = sets[0]
        others = [tanimoto(b, o) for j, o in sets if j != i]
        assert math.isclose(profile[i].mean_similarity, np.mean(others)) and math.isclose(profile[i].max_similarity, max(others))


def test_key_diversity(spark, rows):
    df = spark.createDataFrame([("m", "a"), ("m", "a"), ("m", "b"), ("m", None)], "g string, k string")
    assert rows(fp.key_diversity(df, "g", "k")) == [("m", 3, 2, 2 / 3, 0.5)]
    assert rows(fp.uniqueness(df, "g", "k")) == [("m", 4, 0.75, 2 / 3)]
    table = fp.set_metrics({"U": fp.uniqueness(df, "g", "k").select("g", F.col("uniqueness").alias("value"))}, "g", ["U"], ["m", "x"])
    assert rows(table) == [("U", 0.6667, None)]


def atoms_schema(more=""):
    return f"pose int, site string, atoms {geo.ATOMS}{more}"


def cloud(rng, n, spread=6.0):
    return [(rng.choice(["C", "N", "Xx"]), *(rng.uniform(-spread, spread) for _ in range(3))) for _ in range(n)]


def test_contacts_against_brute_force(spark):
    rng = random.Random(4)
    poses = [(i, f"s{i % 2}", cloud(rng, rng.randint(1, 6), 14)) for i in range(40)]
    sites = [(f"s{k}", *a) for k in range(2) for a in cloud(rng, 30)]
    out = geo.site_contacts(
        spark.createDataFrame(poses, atoms_schema()),
        spark.createDataFrame(sites, "site string, element string, x double, y double, z double"),
        "pose", "atoms", "site",
    ).collect()
    def radius(e):
        return geo.VDW_RADII.get(e, geo.OTHER_RADIUS)
    for r in out:
        pairs = [
            (math.dist((a.x, a.y, a.z), s[2:]), radius(a.element) + radius(s[1])) for a in r.atoms for s in sites if s[0] == r.site
        ]
        nearest = min(d for d, _ in pairs)
        assert r.clashes == sum(d < 0.75 * v for d, v in pairs)
        assert r.pass_near == (nearest <= 5.0) and (r.min_distance is None) == (nearest > 5.0)
        assert r.min_distance is None or math.isclose(r.min_distance, nearest)
    assert any(r.clashes for r in out) and not all(r.pass_near for r in out)


def test_box(spark, rows):
    pts = spark.createDataFrame([(0.0, 0.0, 0.0), (2.0, 4.0, 6.0)], "x double, y double, z double")
    box = geo.box_from_points(pts, 1.0)
    assert box == geo.Box((1.0, 2.0, 3.0), (4.0, 6.0, 8.0)) and geo.box_from_points(pts.limit(0)) is None
    inside, outside = ("C", 3.0, 5.0, 7.0), ("C", 3.1, 0.0, 0.0)
    poses = spark.createDataFrame([(0, "s", [inside]), (1, "s", [inside, outside]), (2, "s", [])], atoms_schema())
    got = rows(geo.box_filter(poses, "atoms", box, 0.4), "pose", "frac_outside", "pass_search_box")
    assert got == [(0, 0.0, True), (1, 0.5, False), (2, 1.0, False)]
    assert rows(geo.box_filter(poses, "atoms", None), "pass_search_box") == [(True,)] * 3


def test_shape_and_deviation(spark, rows):
    rng = random.Random(8)
    a = cloud(rng, 9)
    turn = np.linalg.qr(np.random.default_rng(1).normal(size=(3, 3)))[0]
    turn *= np.sign(np.linalg.det(turn))
    moved = [(e, *(turn @ np.array(p) + 5).tolist()) for e, *p in a]
    mirrored = [(e, -x, y, z) for e, x, y, z in a]
    poses = spark.createDataFrame([(0, "s", a), (1, "t", a), (2, "none", a)], atoms_schema())
    conformers = spark.createDataFrame([("s", mirrored), ("s", moved), ("s", a[:4]), ("t", mirrored)], f"site string, atoms {geo.ATOMS}")
    out = {r.pose: r for r in geo.min_rmsd(poses, conformers, "pose", "site", "atoms", 0.01).collect()}
    assert out[0].min_rmsd < 1e-6 and out[0].pass_deviation
    assert out[1].min_rmsd > 0.1 and math.isinf(out[2].min_rmsd) and not out[2].pass_deviation
    shaped = poses.withColumn("ref", F.when(F.col("pose") < 2, F.col("atoms")))
    got = {r.pose: r for r in geo.shape_similarity(shaped, "atoms", "ref").collect()}
    assert math.isclose(got[0].shape_score, 1.0) and got[2].shape_score is None and got[2].pass_shape


def test_contact_check(spark, rows):
    contacts = spark.createDataFrame(
        [(0, "ASP25.A", "HBDonor", True), (0, "ASP25.A", "HBDonor", True), (0, "GLY1.A", "Hydrophobic", True), (1, "GLU9.A", "HBAcceptor", True), (1, "ASP25.A", "HBDonor", False)],
        "pose int, residue string, interaction string, present boolean",
    )
    poses = spark.createDataFrame([(0,), (1,), (2,)], "pose int")
    out = geo.contact_check(poses, contacts, "pose", 1, required=["ASP25", "TYR99"], forbidden=["GLU9"])
    assert rows(out) == [(0, 1, "ASP25.A.HBDonor,GLY1.A.Hydrophobic", True), (1, 1, "GLU9.A.HBAcceptor", False), (2, 0, "", False)]
    assert rows(geo.contact_check(poses, contacts, "pose"), "pass_interactions") == [(True,)] * 3


def ring(candidate, name, ids):
    return [(candidate, name, i) for i in ids]


def test_complexity(spark):
    def atom(c, i, degree, aromatic=False):
        return (c, i, degree, "C", not aromatic, aromatic, False)

    atoms = [atom("cyclohexane", i, 2) for i in range(6)] + [atom("benzene", i, 2, True) for i in range(6)]
    atoms += [atom("spiro", i, 4 if i == 0 else 2) for i in range(9)] + [atom("methane", 0, 0)]
    rings = ring("cyclohexane", 0, range(6)) + ring("benzene", 0, range(6))
    rings += ring("spiro", 0, [0, 1, 2, 3, 4]) + ring("spiro", 1, [0, 5, 6, 7, 8])
    out = complexity.topological_index(
        spark.createDataFrame(atoms, "candidate string, atom int, degree int, element string, sp3 boolean, aromatic boolean, chiral boolean"),
        spark.createDataFrame(rings, "candidate string, ring int, atom int"),
    )
    got = {r.candidate: (r.q1, r.complexity) for r in out.collect()}
    assert got["benzene"] == (3.0, 3.0) and got["cyclohexane"] == (3.0, 6.0)
    assert got["methane"] == (1.0, 0.0)
    q1 = 3 - 18 + (16 + 8 * 4) / 2
    assert got["spiro"] == (q1, (2 + 1) * q1)
