"""Rows that share an id or have none: each is decided about by itself."""

import random
from collections import Counter

import corpus_pipeline as pipeline
from winnow.llm import exact_dedup, line_dedup, ngram_join
from winnow.llm.mixing import Mix, copies, mixed
from winnow.llm.storage import written

from llm_cases import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, text, "en", "src1", len(text)) for i, text in rows], SCHEMA)


def of(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_each_row_as_often_as_taken(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(12)]), f"{'word ' * rng.randint(1, 30)}{rng.randint(0, 40)}", "en", rng.choice("ab"), n) for n in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for epochs, tie, num in ((1, None, 1), (1, "md5(text)", 1), (3, "md5(text)", 4), (3, None, 3)):
        mix = Mix(levels=(("origin", "source"),), weights={"origin": {"a": 3}}, budget_num=num, budget_den=2, max_epochs=epochs)
        want = Counter()
        for r in copies(docs, mix, tie=tie).collect():
            want[r.doc_id, r.origin, r.tokens] += r.copies
        got = Counter((r.doc_id, r.source, (len(r.text.encode()) + 3) // 4) for r in mixed(docs, mix, tie=tie).collect())
        assert got == +want and sum(got.values()) > 0


def test_a_repeated_row_and_rows_without_an_id_are_mixed(spark):
    texts = [f"text number {n}" for n in range(20)]
    docs = table(spark, [(1, "same text")] * 7 + [(None, t) for t in texts])
    every = Mix(levels=(("origin", "source"),), budget_num=1, budget_den=1, max_epochs=1)
    assert of(mixed(docs, every)) == of(docs)
    half = Mix(levels=(("origin", "source"),), budget_num=1, budget_den=2, max_epochs=1)
    none = table(spark, [(None, t) for t in texts])
    assert sum(of(mixed(none, half, tie="md5(text)")).values()) == 10


def test_exact_copies_by_row(spark):
    rows = [(1, "Copy"), (1, "only here"), (2, "copy"), (3, "again"), (3, "again"), (3, "AGAIN"), (4, "again"), (4, "again"), (None, "copy"), (None, "copy")]
    got = of(exact_dedup.keep_one(table(spark, rows)))
    assert got == Counter([(1, "only here"), (2, "copy"), (4, "again"), (None, "copy"), (None, "copy")])


def test_near_copies_by_row(spark):
    words = [f"w{n}" for n in range(60)]
    near = " ".join([*words[:-1], "other"])
    text, alone = " ".join(words), " ".join(f"v{n}" for n in range(30))
    rows = [(1, text), (2, near), (2, alone), (3, "x y z a b c d e f"), (3, "p q r s t u v w"), (None, text)]
    assert of(ngram_join.keep_one(table(spark, rows))) == Counter([rows[0], *rows[2:]])
    both = of(ngram_join.keep_one(table(spark, [(1, text), (1, near), (5, near)])))
    assert sum(both.values()) == 1 and {i for i, _ in both} == {1}


def test_lines_of_several_texts_of_an_id(spark):
    for function in (line_dedup.without_repeats, line_dedup.without_passages):
        shared = "\n".join(f"shared {n}" for n in range(12))
        rows = [(1, shared), (2, shared), (2, "\n".join(f"own {n}" for n in range(12)))]
        got = of(function(table(spark, rows)))
        assert got[rows[2]] == 1 and got[rows[0]] == 1 and got[rows[1]] == 0


def test_pipeline_loses_and_multiplies_no_row(spark, documents):
    some = documents.where("text rlike '[a-z]{3}'").orderBy("doc_id").limit(30).select("doc_id", "text", "lang", "source", "n_chars")
    rows = [tuple(r) for r in some.collect()]
    odd = [(None, *r[1:]) for r in rows[:10]] + [rows[11]] * 6 + [(rows[12][0], rows[13][1] + " and more", *rows[12][2:])]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    for _, stage in pipeline.STAGES[1:4]:
        before, docs = of(docs), written(stage(spark, docs, SF), "stage")
        assert not of(docs) - before
    left = of(docs)
    assert any(i is None for i, _ in left) and max(n for (i, _), n in left.items() if i is not None) == 1
