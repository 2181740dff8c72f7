import zlib

import pytest

from winnow.llm import language, quality


BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def big(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet")


def test_language_held_out_accuracy(spark, big):
    model = language.fit(big, ~language.held_out())
    rows = language.predict(big, model).join(big.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    again = language.predict(big.repartition(5), model).select("doc_id", "lang_pred", "score").collect()
    assert {r.doc_id: (r.lang_pred, r.score) for r in again} == {r.doc_id: (r.lang_pred, r.score) for r in rows}


def test_language_awkward_rows(spark, big, awkward, nothing):
    model = language.fit(big, ~language.held_out())
    found = {r.doc_id: r for r in language.predict(awkward, model).collect() if r.doc_id is not None}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 2, 9, 14))
    assert all(found[i].lang_pred in {"en", "fr", "de", "es"} for i in (3, 7, 10, 11, 12))
    assert language.accepted(awkward, model, 0.0).columns == awkward.columns
    assert {r.doc_id for r in language.accepted(awkward, model, 0.0).collect()}.isdisjoint({0, 1, 2, 9, 14})
    assert language.predict(nothing, model).count() == 0
    none = language.fit(nothing, ~language.held_out())
    assert none is None and {r.lang_pred for r in language.predict(awkward, none).collect()} == {"und"}


def test_language_families_and_a_single_language(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("aba cab bac", "xx"), ("dede fed edef", "de"), ("ghi high hig", "en"), ("klm mlk lkm", "fr")] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, ~language.held_out())
    assert model.families.classes == ["germanic", "romance", "xx"] and model.within["germanic"].classes == ["de", "en"]
    got = language.predict(docs, model).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] for r in got)
    one = language.fit(docs.where("lang = 'en'"), ~language.held_out())
    assert {(r.lang_pred, r.score) for r in language.predict(docs, one).collect()} == {("en", 1.0)}


def test_quality_held_out(spark, big):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    machine = quality.fit(big, labels, lambda i: ~language.held_out(i))
    rows = quality.score(big, machine).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93


def test_quality_awkward_rows(spark, big, awkward, nothing):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    machine = quality.fit(big, labels, lambda i: ~language.held_out(i))
    rows = quality.score(awkward, machine).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    by_text = {}
    for r, t in zip(rows, awkward.collect(), strict=True):
        assert by_text.setdefault(t.text or "", r.score) == r.score
    odd = spark.createDataFrame([(3, None), (3, 1), (None, 1), (7, 5), (8, 0)], "doc_id long, quality int")
    assert quality.fit(awkward, odd, lambda i: ~language.held_out(i)) is not None
    assert quality.fit(awkward, odd.limit(0), lambda i: ~language.held_out(i)) is None
    assert {r.score for r in quality.score(awkward, None).collect()} == {0.5}
    assert quality.score(nothing, machine).count() == 0


def test_the_identity_equals_the_sum_over_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    machine = quality.Machine(np.zeros((1, 15)), 0.3, rng.normal(size=40), rng.normal(size=(40, 3)))
    owner, at, value = np.array([0, 0, 0, 2, 2]), np.array([1, 5, 9, 5, 39]), rng.normal(size=5)
    margin, _ = machine.margins(owner, at, value, 3)
    for text in range(3):
        i = np.flatnonzero(owner == text)
        crossed = sum(machine.factors[at[a]] @ machine.factors[at[b]] * value[a] * value[b] for a in i for b in i if a < b)
        assert abs(margin[text] - (0.3 + (machine.linear[at[i]] * value[i]).sum() + crossed)) < 1e-9
