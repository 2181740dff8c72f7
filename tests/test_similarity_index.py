"""The similarity index, coverage in rounds, folded copies and the estimator, against plain loops."""

import itertools
import math
import random

import numpy as np
import pytest

from winnow.operators import fingerprint as fp


def tanimoto(a, b):
    union = len(a | b)
    return len(a & b) / union if union else 0.0


def sets_of(n, bits, seed, sizes=(1, 25)):
    """Skewed sets: common low bits, families that differ in a few bits, copies, an empty set."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        base = {min(int(rng.expovariate(6 / bits)), bits - 1) for _ in range(rng.randint(*sizes))}
        for _ in range(rng.choice([1, 1, 2, 6])):
            own = set(base)
            for _ in range(rng.choice([0, 1, 2])):
                own ^= {rng.randrange(bits)}
            out.append(own)
    return [set(), *out[: n - 1]]


@pytest.mark.parametrize("list_rows", [4096, 20, 3])
@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_index_finds_every_pair(spark, threshold, list_rows):
    data = sets_of(220, 256, seed=int(threshold * 10))
    df = spark.createDataFrame([(f"r{i:03d}", sorted(s)) for i, s in enumerate(data)], "id string, bits array<int>")
    firsts = {}
    for i, s in enumerate(data):
        firsts.setdefault(frozenset(s), []).append(f"r{i:03d}")
    want = {
        (min(x[0], y[0]), max(x[0], y[0])): tanimoto(a, b)
        for (a, x), (b, y) in itertools.combinations([(k, v) for k, v in firsts.items() if k], 2)
        if tanimoto(a, b) >= threshold
    }
    got = fp.similar_pairs(df, "id", "bits", threshold, 256, list_rows=list_rows).collect()
    assert len(got) == len(want) and {(r.id_a, r.id_b) for r in got} == set(want)
    copies = {v[0]: len(v) for v in firsts.values()}
    for r in got:
        assert math.isclose(r.similarity, want[r.id_a, r.id_b]) and (r.copies_a, r.copies_b) == (copies[r.id_a], copies[r.id_b])


def test_long_lists_are_keyed_again(spark):
    # one bit is in every set, so it is the commonest; with two bits a set the rarer one decides
    data = [sorted({0, 1 + i % 60}) for i in range(60)] + [[0]]
    df = spark.createDataFrame(list(enumerate(data)), "id int, bits array<int>")
    sets = fp._by_rarity(fp.fingerprint_groups(df, "id", "bits")[0], 64)
    lists = fp._index_lists(sets, 0.5, list_rows=10)
    counts = [r["count"] for r in lists.groupBy("key").count().collect()]
    assert max(counts) <= 30  # pairs of chunks of about ten
    got = fp.similar_pairs(df, "id", "bits", 0.5, 64, list_rows=10).count()
    assert got == 60  # the set of one bit is half of every other


def greedy(sets, distance):
    picks = []
    for s in sets:
        if all(1 - tanimoto(s, p) > distance + 1e-12 for p in picks):
            picks.append(s)
    return len(picks)


@pytest.mark.parametrize(("first_rows", "distance"), [(8192, 0.65), (5, 0.65), (5, 0.2), (1, 0.05)])
def test_coverage(spark, first_rows, distance):
    groups = {"a": sets_of(160, 64, 3), "b": sets_of(40, 64, 4), "one": [{3}], None: sets_of(50, 64, 5) + [{1, 2}] * 30}
    rows = [(g, 1000 * k + i, sorted(s)) for k, (g, own) in enumerate(groups.items()) for i, s in enumerate(own)]
    df = spark.createDataFrame(rows, "g string, id long, bits array<int>").repartition(3)
    got = {r.g: r for r in fp.sphere_exclusion(df, "g", "id", "bits", 64, distance, block_rows=16, first_rows=first_rows).collect()}
    assert {g: (r.n, r.picks) for g, r in got.items()} == {g: (len(own), greedy(own, distance)) for g, own in groups.items()}
    assert all(math.isclose(r.se_div, r.picks / r.n) for r in got.values())
    assert fp.sphere_exclusion(df.limit(0), "g", "id", "bits", 64).collect() == []


def test_a_large_group_takes_few_rounds(spark, monkeypatch):
    rng = np.random.default_rng(2)
    bits = [np.flatnonzero(r).tolist() for r in rng.random((20_000, 64)) < 0.5]
    df = spark.createDataFrame([("g", i, b) for i, b in enumerate(bits)], "g string, id long, bits array<int>")
    made = []
    plain = fp.written
    monkeypatch.setattr(fp, "written", lambda d, name: made.append(name) or plain(d, name))
    got = fp.sphere_exclusion(df, "g", "id", "bits", 64, first_rows=2048).first()
    assert (got.n, got.picks) == (20_000, greedy([set(b) for b in bits], 0.65))
    assert made.count("picks") + made.count("picked") < 10


def test_copies_cost_one_set(spark):
    data = [[1, 2, 3]] * 90 + [[1, 2]] * 5 + [[7, 9], [], []]
    df = spark.createDataFrame([("g", i, b) for i, b in enumerate(data)], "g string, id int, bits array<int>")
    sets = fp.distinct_sets(df, "g", "id", "bits", 64).collect()
    assert sorted((r.copies, r["first"]) for r in sets) == [(1, 95), (2, 96), (5, 90), (90, 0)]
    flat = [tanimoto(set(a), set(b)) for a in data for b in data]
    div = fp.int_div(df, "g", "id", "bits", 64, block_rows=2).first()
    assert div.n == 98 and math.isclose(div.int_div1, 1 - sum(flat) / len(flat)) and math.isclose(div.int_div2, 1 - math.sqrt(sum(x * x for x in flat) / len(flat)))
    for r in fp.tanimoto_profile(df, "g", "id", "bits", 64, block_rows=2).collect():
        others = [tanimoto(set(data[r.id]), set(b)) for j, b in enumerate(data) if j != r.id]
        assert math.isclose(r.mean_similarity, sum(others) / len(others)) and math.isclose(r.max_similarity, max(others))


def test_estimate_holds_the_exact_value(spark):
    groups = {"a": sets_of(600, 64, 8), "b": sets_of(300, 64, 9, (20, 40)), "one": [{5}], None: [{1, 2}] * 40}
    df = spark.createDataFrame([(g, f"{g}{i}", sorted(s)) for g, own in groups.items() for i, s in enumerate(own)], "g string, id string, bits array<int>")
    exact = {r.g: r for r in fp.int_div(df, "g", "id", "bits", 64).collect()}
    got = {r.g: r for r in fp.int_div_estimate(df, "g", "id", "bits", 64, pairs=500).collect()}
    assert {g: (r.n, r.pairs) for g, r in got.items()} == {g: (len(own), min(500, len(own))) for g, own in groups.items()}
    for g, r in got.items():
        assert abs(r.int_div1 - exact[g].int_div1) <= r.error1 + 1e-12 and abs(r.int_div2 - exact[g].int_div2) <= r.error2 + 1e-12
        assert r.error1 < 0.2


@pytest.mark.parametrize("block_rows", [65_536, 7])
@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.8, 1.0])
def test_groups_find_every_pair(spark, threshold, block_rows):
    data = sets_of(220, 256, seed=int(threshold * 10) + 50)
    df = spark.createDataFrame([(f"r{i:03d}", sorted(s)) for i, s in enumerate(data)], "id string, bits array<int>")
    firsts = {}
    for i, s in enumerate(data):
        firsts.setdefault(frozenset(s), []).append(f"r{i:03d}")
    kept = [(k, v) for k, v in firsts.items() if k]
    want = sorted(
        (x[0], y[0], round(tanimoto(a, b), 9), len(x), len(y)) for (a, x), (b, y) in itertools.combinations(kept, 2) if tanimoto(a, b) >= threshold
    )
    got = fp.similar_pairs(df, "id", "bits", threshold, 256, method="groups", size_block_rows=block_rows).collect()
    assert sorted((r.id_a, r.id_b, round(r.similarity, 9), r.copies_a, r.copies_b) for r in got) == want
    assert fp.similar_pairs(df.filter("id = 'none'"), "id", "bits", threshold, 256, method="groups").count() == 0


def test_texts_without_rare_words_are_sent_a_few_times(spark, monkeypatch):
    """Every bit is in a tenth of the sets, so that lists by bits would hold a set hundreds of times."""
    rng = random.Random(3)
    df = spark.createDataFrame([(i, sorted(rng.sample(range(1000), 100))) for i in range(2000)], "id int, bits array<int>")
    monkeypatch.setattr(fp, "LIST_ROWS", 50)
    made = []
    real = fp._size_blocks
    monkeypatch.setattr(fp, "_size_blocks", lambda *a: made.append(real(*a)) or made[-1])
    from winnow.plans import catalog_sets

    monkeypatch.setattr(catalog_sets, "document_bits", lambda t: df.withColumnRenamed("id", "doc_id"))
    assert catalog_sets.q_similar_texts(None).count() == 0
    assert made[0].count() <= 2000 * fp.LEAST_BLOCKS
