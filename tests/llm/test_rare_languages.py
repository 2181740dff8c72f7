from winnow.llm import language


def test_quota():
    assert language.quota_of([5, 10], 100) == 100
    assert language.quota_of([3, 1000, 1000], 103) == 50
    assert language.quota_of([1] * 4 + [9], 6) == 2


def test_a_rare_language_is_learned(spark):
    texts = {"en": "ghi high hig", "de": "dede fed edef", "fr": "klm mlk lkm", "zz": "qrs srq rsq"}
    rows = [(i, texts["zz" if i % 997 == 1 else ("en", "de", "fr")[i % 3]], "zz" if i % 997 == 1 else ("en", "de", "fr")[i % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, ~language.held_out(), sample_rows=100)
    assert "zz" in model.families.classes
    rare = [r.lang_pred for r in language.predict(docs, model).collect() if rows[r.doc_id][2] == "zz"]
    assert rare and set(rare) == {"zz"}
