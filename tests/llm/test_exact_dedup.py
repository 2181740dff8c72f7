import hashlib
from collections import defaultdict

from winnow.llm.exact_dedup import exact_groups, keep_one

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_awkward_rows_for_any_split(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for support in (0.9, 0.1, 0.01):
        got = sorted((tuple(r) for r in exact_groups(awkward, support=support).collect()), key=repr)
        assert got == brute(rows)


def test_hot_group(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'Hot', concat('t', id)) as text")
    got = exact_groups(docs).where("group_size > 1").selectExpr("count(*) n", "max(keep_id) k", "count_if(kept) one").first()
    assert tuple(got) == (1000, 2997, 1)


def test_keep_one_and_empty(awkward, nothing):
    assert keep_one(awkward).columns == awkward.columns
    left = [r.doc_id for r in keep_one(awkward).collect()]
    assert 8 in left and 7 not in left and left.count(None) == 2
    assert exact_groups(nothing).count() == 0 and keep_one(nothing).count() == 0
