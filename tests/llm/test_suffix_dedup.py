import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import SF

from winnow.llm import suffix_dedup
from winnow.llm.catalog import op13_suffix_dedup
from winnow.llm.suffix_dedup import common_prefixes, runs, without_repeated_strings


def brute(rows, length):
    """Spans and what is kept, from a table of the smallest id of every string."""
    texts = [(2**63 - 1 if i is None else i, i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, _, t in texts:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for i, own, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if least[t[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        spans = [k for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1])]
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((own, len(t), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=80).map(str.encode), st.integers(1, 12))
def test_common_prefixes(text, least):
    order, shared = common_prefixes(np.frombuffer(text, np.uint8), least)
    turned = [(text[i:] + text[:i]) * 16 for i in order]
    assert sorted(order.tolist()) == list(range(len(text)))
    for a, b, n in zip(turned[:-1], turned[1:], shared[1:].tolist(), strict=True):
        same = next((k for k in range(least) if a[k] != b[k]), least)
        assert n == (same if same < least else suffix_dedup.UNSET)
        assert same >= least or a[:least] < b[:least]


def test_runs_cover_every_window_once_and_follow_its_text(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STEP", 64)
    rng = random.Random(1)
    docs = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 3, 49, 50, 51, 300]))).encode() for _ in range(40)] + [b"x" * 500]
    ends = np.cumsum([len(d) for d in docs])
    text = b"".join(docs)
    at, count, key = runs(np.frombuffer(text, np.uint8), ends, 50)
    seen, keys = [], {}
    for a, c, k in zip(at.tolist(), count.tolist(), key.tolist(), strict=True):
        assert 1 <= c <= 64
        for w in range(a, a + c):
            seen.append(w)
            assert keys.setdefault(text[w : w + 50], k) == k
    wanted = [s + w for s, d in zip((ends - [len(d) for d in docs]).tolist(), docs, strict=True) for w in range(len(d) - 49)]
    assert sorted(seen) == sorted(wanted)


@pytest.mark.parametrize(("length", "block_bytes", "hot"), [(50, 1 << 23, 100_000), (50, 2000, 100_000), (50, 2000, 3), (7, 500, 5), (2, 4000, 10)])
def test_against_brute_force(spark, length, block_bytes, hot):
    rng = random.Random(length + hot)
    words = ["alpha", "beta", "gamma", "δέλτα", "omega", "漢字"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = prose(20)
    rows = [(i, prose(rng.choice([2, 15, 40]))) for i in range(40)]
    rows += [(100 + i, f"{prose(9)} {passage[rng.choice([0, 0, 3]):]} {prose(9)}") for i in range(30)]
    rows += [(200 + i, passage) for i in range(10)] + [(300, passage), (300, passage), (300, prose(30) + passage)]
    rows += [(None, passage), (None, prose(25)), (None, None), (400, None), (401, ""), (402, "a" * 700), (403, "b" + "a" * 120), (404, "é" * 40), (405, "x\x00" * 40), (406, "x\x00" * 60)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, 1, "key") for i, t in rows], "doc_id long, text string, id int, block string").repartition(3)
    got = without_repeated_strings(df, length=length, block_bytes=block_bytes, hot_docs=hot)
    assert found(got) == brute(rows, length)


def test_very_long_texts(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcd ") for _ in range(400_000))
    rows = [(1, long), (2, "ab" + long[5_000:390_000] + "yz"), (3, "q" * 300_000), (4, "q" * 49 + "r"), (5, "q" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(without_repeated_strings(df)) == brute(rows, 50)


def test_awkward_and_empty(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(without_repeated_strings(awkward)) == brute(rows, 50)
    assert without_repeated_strings(nothing).collect() == []


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = op13_suffix_dedup(spark, SF)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=repr) == brute(rows, 50)
    assert sum(r[2] for r in got) > 0
