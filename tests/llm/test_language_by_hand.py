"""Predictions of op5 against trigram weights that are summed and duels that are decided one by one."""

import math

import pytest
from llm_cases import TEXTS

from winnow.llm import language


def trigrams_by_hand(text):
    letters = [b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    codes = [(a << 16) + (b << 8) + c for a, b, c in zip(letters, letters[1:], letters[2:], strict=False)]
    return [(code * 2654435761 % 2**32) >> (32 - language.BITS) for code in codes if code != 0x202020]


def duel_by_hand(duels, grams):
    k = len(duels.classes)
    if k == 1:
        return duels.classes[0], 1.0
    wins, margins, closest = [0] * k, [0.0] * k, [math.inf] * k
    for d, (a, b) in enumerate(zip(duels.first.tolist(), duels.second.tolist(), strict=True)):
        margin = sum(duels.weights[g][d] for g in grams) / max(len(grams), 1) + duels.bias[d]
        for own, value in ((a, margin), (b, -margin)):
            wins[own] += value > 0
            margins[own] += value
            closest[own] = min(closest[own], value)
    best = max(range(k), key=lambda c: (wins[c], margins[c], -c))
    return duels.classes[best], 1 / (1 + math.exp(-2 * closest[best]))


def predict_by_hand(model, text):
    if not any(c.isalpha() for c in text or ""):
        return language.UNKNOWN, 0.0
    grams = trigrams_by_hand(text)
    family, sure = duel_by_hand(model.families, grams)
    lang, inner = duel_by_hand(model.within[family], grams)
    return lang, sure * inner


def test_against_sums_by_hand(spark, documents):
    model = language.fit(documents, ~language.held_out())
    families = {language.family_of(r.lang) for r in documents.select("lang").distinct().collect() if r.lang}
    assert set(model.families.classes) == families and {c for d in model.within.values() for c in d.classes} == {"de", "en", "es", "fr"}
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect() if len(r.text or "") < 4000][:120]
    rows += [(10_000 + i, t) for i, t in enumerate(TEXTS) if "ﬃ" not in (t or "")] + [(20_000, "ab"), (20_001, "ÄÖÜ straße 12"), (20_002, "der die das " * 3000)]
    df = spark.createDataFrame([(i, t, "en", "kept") for i, t in rows], "doc_id long, text string, lang string, id string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(df, model).collect()}
    assert got.keys() == dict(rows).keys()
    for i, text in rows:
        lang, score = predict_by_hand(model, text)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-9)
