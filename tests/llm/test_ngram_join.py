import random
import re
from itertools import combinations

import pytest

from winnow.llm import ngram_join
from winnow.llm.components import components
from winnow.llm.ngram_join import Rule, keep_one, linked_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations([i for i, r in enumerate(rows) if r[0] is not None], 2):
        if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least[root(i)] if r[0] is not None else None) for i, r in enumerate(rows)), key=repr)


def variants(seed, families=6, members=14):
    random.seed(seed)
    rows = []
    for f in range(families):
        base = [f"w{random.randint(0, 400)}" for _ in range(random.choice([4, 7, 12, 40, 120, 300]))]
        for _ in range(members):
            own = list(base)
            for _ in range(random.randint(0, max(1, len(base) // 25))):
                own[random.randrange(len(own))] = random.choice(["x", "y", "Z"])
            rows.append(" ".join(own[: len(own) - random.randint(0, 2)]))
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "num", "den", "chunk", "leaf"), [(4, 85, 100, 1024, 32), (5, 4, 5, 6, 2)])
def test_families_against_brute_force(spark, monkeypatch, k, num, den, chunk, leaf):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    rows = variants(k)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in linked_components(docs, k, num, den).collect()), key=repr)
    assert got == brute(rows, k, num, den)
    # the whole family may hold a third of all rows: the parts of the method that need not go through Spark
    for size in range(1, 400):
        rule = Rule(k, num, den)
        for other in range(size, size * den // num + 1):
            low, groups, spare = rule.bands()[rule.band_of(size)]
            assert rule.band_of(size) in rule.bands_for(size) and rule.band_of(size) in rule.bands_for(other)
            assert not groups or groups - rule.most_apart(size, other) > spare


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = sorted((tuple(r) for r in linked_components(awkward, 5, 4, 5).collect()), key=repr)
    assert got == brute(rows, 5, 4, 5)
    left = keep_one(awkward)
    assert left.columns == awkward.columns and left.where("doc_id is null").count() == 2
    assert linked_components(nothing).count() == 0


def test_block_tree_finds_what_all_pairs_find():
    import numpy as np

    random.seed(2)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 9, (5, 30))
    counts = np.abs(base[rng.integers(0, 5, 300)] + rng.integers(-1, 2, (300, 30)) * (rng.random((300, 30)) < 0.15)).astype(np.int16)
    block = ngram_join.Block(Rule(5, 4, 5), np.arange(300), counts.sum(axis=1).astype(np.int64), counts, counts.astype(np.uint16), np.arange(300), np.full(300, -1))
    i, j, _ = block.survivors(np.arange(300), np.arange(300))
    want = {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b}
    got = [tuple(sorted(p)) for i, j, _ in block.pairs() for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_components_of_a_long_path(spark):
    links = spark.range(60).selectExpr("(id * 7) % 60 as a", "((id + 1) * 7) % 60 as b").where("a <> 21").unionAll(spark.createDataFrame([(100, 101), (5, 5)], "a long, b long"))
    for task_links in (10**6, 7):
        got = dict(components(links.repartition(6), task_links=task_links).collect())
        assert set(got.values()) == {0, 100} and got[101] == 100 and len(got) == 62
    assert components(links.limit(0)).count() == 0


def test_sets_without_common_shingles_share_no_block():
    import pyarrow as pa

    # sizes from the least of a band on, whose sets have more empty groups than its largest pair leaves to spare
    random.seed(4)
    texts = [" ".join(f"w{random.randrange(10**9)}" for _ in range(size)) for size in [*range(20, 600, 4), *range(20, 600, 4)]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
    met = ngram_join._meet(pa.Table.from_batches(list(ngram_join._sign(Rule(5, 4, 5), 1)(iter([batch])))))
    kinds = met["kind"].to_pylist()
    assert kinds.count(ngram_join.DOC) == len(texts) and kinds.count(ngram_join.LIVE) == kinds.count(ngram_join.EDGE) == 0


@pytest.mark.parametrize(("num", "den"), [(4, 5), (85, 100), (1, 2)])
def test_spare_groups_hold_for_every_partner_in_the_band(num, den):
    import numpy as np

    rule = Rule(5, num, den)
    for size in range(1, 700):
        band = rule.band_of(size)
        groups = rule.bands()[band][1]
        for other in range(size, size * den // num + 1) if groups else ():
            assert min(rule.spare(band, np.array([size, other]))) + 1 <= groups - rule.most_apart(size, other)
            assert rule.spare(band, np.array([size, other])).min() >= rule.bands()[band][2] >= 0


def test_pairs_at_the_limit_are_found_among_common_passages(spark):
    random.seed(11)
    passages = [" ".join(f"p{i}.{j}" for j in range(12)) for i in range(12)]
    rows = []
    for _ in range(160):
        body = [f"w{random.randrange(10**9)}" for _ in range(random.randint(8, 260))]
        body = " ".join(body).split() + " ".join(random.sample(passages, 4)).split()
        rows.append(" ".join(body))
        near = list(body)
        while True:
            nxt = list(near)
            nxt[random.randrange(len(nxt))] = f"x{random.randrange(10**9)}"
            a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (body, nxt))
            if 5 * len(a & b) < 4 * len(a | b):
                break
            near = nxt
        rows.append(" ".join(near))
    random.shuffle(rows)
    rows = list(enumerate(rows))
    got = sorted((tuple(r) for r in linked_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute(rows, 5, 4, 5) and len({c for _, _, c in got}) <= 160
