import hashlib
import random
from collections import defaultdict

from winnow.llm.mixing import Mix, budgets, copies, mixed

LEVELS = (("domain", "source"), ("language", "lang"), ("origin", "concat(source, '-', lang)"))


def share_out(budget, children):
    """children: name -> (capacity, weight); plain water filling."""
    given, left = {}, dict(children)
    while left:
        total = sum(w for _, w in left.values())
        full = [n for n, (c, w) in sorted(left.items(), key=lambda x: (x[1][0] / x[1][1], x[0])) if c * total <= w * budget][:1]
        if not full:
            return given | {n: w * budget // total for n, (_, w) in left.items()}
        given[full[0]] = left.pop(full[0])[0]
        budget -= given[full[0]]
    return given


def brute_budgets(leaves, mix):
    weight = lambda level, value: mix.weights.get(level, {}).get(value, 1)
    names = mix.names
    capacity = {p: t * mix.max_epochs * all(weight(n, v) for n, v in zip(names, p, strict=True)) for p, t in leaves.items()}
    given = {(): min(sum(leaves.values()) * mix.budget_num // mix.budget_den, sum(capacity.values()))}
    for depth in range(1, len(names) + 1):
        below = defaultdict(dict)
        for p, c in capacity.items():
            node = p[:depth]
            old = below[node[:-1]].get(node, (0, 0))[0]
            below[node[:-1]][node] = (old + c, max(1, weight(names[depth - 1], node[-1])))
        given = {n: b for parent, children in below.items() for n, b in share_out(given[parent], children).items()}
    return given


def test_budgets_against_water_filling(spark):
    random.seed(8)
    for trial in range(3):
        leaves = {(f"d{d}", f"l{x}", f"o{o}"): random.choice([0, 5, 100, 1000, 5000]) for d in range(3) for x in range(3) for o in range(4)}
        mix = Mix(weights={"domain": {"d0": 5, "d1": 0 if trial == 1 else 2}, "language": {"l2": 7}, "origin": {"o3": 3}}, budget_num=trial + 1, budget_den=3, max_epochs=2)
        table = spark.createDataFrame([(*p, t) for p, t in leaves.items()], "domain string, language string, origin string, tokens long")
        got = {(r.domain, r.language, r.origin): r.budget for r in budgets(table, mix).collect()}
        assert got == brute_budgets(leaves, mix)


def test_prefixes_against_brute_force(spark, awkward, nothing):
    mix = Mix(levels=LEVELS, weights={"language": {"en": 3}}, budget_num=9, budget_den=10, max_epochs=3, seed=5)
    rows = copies(awkward, mix).collect()
    assert len(rows) == awkward.count() and copies(nothing, mix).count() == 0
    leaves = defaultdict(list)
    for r in rows:
        leaves[r.domain, r.language, r.origin].append(r)
    for members in leaves.values():
        total, budget = sum(r.tokens for r in members), members[0].budget
        passes = budget // total if total else 0
        key = lambda r: hashlib.md5(f"5:{passes}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        for r in members:
            upto = sum(o.tokens for o in members if key(o) <= key(r))
            assert r.copies == (passes + (upto <= budget - passes * total) if budget else 0)
    assert sum(r.copies * r.tokens for r in rows) <= sum(r.tokens for r in rows) * 9 // 10


def test_rows_as_often_as_taken(spark):
    docs = spark.createDataFrame([(i, "word " * 20, "en", "big" if i else "tiny", 1) for i in range(40)], "doc_id long, text string, lang string, source string, _copies_of int")
    mix = Mix(levels=(("origin", "source"),), budget_num=1, budget_den=2, max_epochs=2)
    times = defaultdict(int)
    for r in mixed(docs, mix).collect():
        times[r.doc_id] += 1
    assert times[0] == 2 and mixed(docs, mix).columns == docs.columns and sum(times.values()) == 20
