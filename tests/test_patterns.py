"""Needed texts of patterns, and rule matching by automaton and by joins against plain matching."""

import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from winnow.operators.patterns import Needed, needed
from winnow.operators.rules import INVALID, Rule, match_rule_table, match_rules, rule_needs


@pytest.mark.parametrize(
    ("pattern", "texts"),
    [
        ("abc", {"abc"}), ("colou?r", {"colo"}), (r"\d+-foo\.bar", {"-foo.bar"}), ("(api_key|token) =", {"api_key =", "token ="}),
        ("[ab]c|xyz", {"ac", "bc", "xyz"}), ("(ab)+x", {"ab"}), ("a{3}", {"aaa"}), ("[Ll]icense", {"License", "license"}), ("^the end$", {"the end"}),
        ("(?:ab|cd){2}e", {"ababe", "abcde", "cdabe", "cdcde"}), (r"\bword\b", {"word"}), ("a.b.cd", {"cd"}), ("(?=foo)bar", {"bar"}), ("x(?!foo)yz", {"xyz"}),
    ],
)
def test_needed_texts(pattern, texts):
    assert needed(pattern) == Needed(frozenset(texts))


def test_case_is_folded_for_plain_letters_only():
    assert needed("(?i)LICENse") == Needed(frozenset({"license"}), True)
    assert needed("(?i)straße") is None


@pytest.mark.parametrize(
    "pattern",
    ["", "a", "[a-z]+", "ab|", "(abc)?", ".*", r"\Qab\E", "x[a&&b]yz", "[a[bc]]de", r"\141bc", r"\x41bc", r"\vabc", "(?<n>abc)", "(?x)a b c", "ab(?i)cd", "(ab", r"\p{L}ab", r"\b{g}ab", "[]ab]cd", "(?i:ab)"],
)
def test_nothing_is_claimed(pattern):
    assert needed(pattern) is None


PIECES = st.sampled_from(["a", "b", "ab", "[ab]", "[^a]", "c?", "b+", "(a|bb)", "(ab)*", "(?:ba){2}", "(c|ab|)", ".", "^", "$", r"\b", "a{2,3}", "(?=a)", "(?!b)"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6).map("".join), st.text("abc", max_size=14))
def test_every_match_contains_a_needed_text(pattern, text):
    need = needed(pattern)
    found = re.search(pattern, text)
    if need and found:
        assert any(t in found.group() for t in need.texts)


def rules_and_texts(n):
    rng = random.Random(n)
    words = ["alpha", "beta", "gamma", "delta", "token", "secret", "Key", "x1", "42", "ß"]

    def pattern(i):
        w, v = rng.choice(words), rng.choice(words)
        return [f"{w} {v}", f"{w}[0-9]+", f"(?i){w}-{v}", f"({w}|{v}) =", rf"\b{w}s?\b", "[xyz]{3}", f"{w}.*{v}"][i % 7]

    rules = [Rule(f"set{i % 3}", f"rule {i}", pattern(i), literal=i % 7 == 0) for i in range(n)]
    rules += [Rule("set0", "anchored", "tok.n [0-9]", anchor="tok"), Rule("set1", "one letter", "q", literal=True), Rule("set1", "all", "", literal=True)]
    texts = [" ".join(rng.choice([*words, "alpha-BETA", "token =", "xyz", "zzz", "q", "İK"]) + rng.choice(["", "s", "7"]) for _ in range(rng.randint(0, 12))) for _ in range(120)]
    return rules, [*enumerate(texts), (900, None), (901, "")]


def plain(rules, text):
    if text is None:
        return list(dict.fromkeys((r.rule_set, INVALID) for r in rules))
    return list(dict.fromkeys((r.rule_set, r.description) for r in rules if (r.pattern in text if r.literal else re.search(r.pattern, text))))


@pytest.mark.parametrize("inline", [0, 1000])
def test_match_rules(spark, inline):
    rules, rows = rules_and_texts(60)
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r.id: [tuple(h) for h in r.hits] for r in match_rules(df, "text", rules, inline=inline).collect()}
    assert got == {i: plain(rules, t) for i, t in rows}


def test_thousands_of_rules(spark):
    rules = [Rule(f"set{i % 5}", f"rule {i}", f"w{i}(x|y)[0-9]") for i in range(25_000)] + [Rule("set9", "late", "[0-9]{9}")]
    df = spark.createDataFrame([(1, "w7x3 and w24999y0"), (2, "w7 w8x"), (3, None), (4, "123456789")], "id int, text string")
    got = {r.id: [h.description for h in r.hits] for r in match_rules(df, "text", rules).collect()}
    assert got == {1: ["rule 7", "rule 24999"], 2: [], 3: [INVALID] * 6, 4: ["late"]}
    assert all(rule_needs(r) for r in rules[:-1]) and rule_needs(rules[-1]) is None


@pytest.mark.parametrize("sent_chars", [4_000_000, 60])
def test_rule_tables_of_any_size(spark, sent_chars):
    rules, rows = rules_and_texts(40)
    rules = [r for r in rules if not r.literal and not r.anchor]
    df = spark.createDataFrame(rows, "id int, text string")
    listed = [(r.rule_set, r.description, r.pattern) for r in rules] + [("set0", "none", None), ("set0", None, "zzz"), ("set0", None, "zzz")]
    table = spark.createDataFrame(listed, "rule_set_name string, description string, smarts string")
    want = sorted((i, *h) for i, t in rows if t is not None for h in plain([*rules, Rule("set0", "", "zzz")], t))
    assert sorted(map(tuple, match_rule_table(df, "id", "text", table, sent_chars=sent_chars).collect())) == want
    assert match_rule_table(df, "id", "text", table.limit(0), sent_chars=sent_chars).count() == 0


def test_texts_are_looked_through_one_at_a_time():
    """16 MB of texts lie in Arrow's memory; Python's own stays far below."""
    import tracemalloc

    import pyarrow as pa

    from winnow.operators.rules import _occurring

    batch = pa.array(["word token " * 1000, None, "plain"] * 1500)
    tracemalloc.start()
    (got,) = _occurring(iter([batch]), {"token": [3, 1]}, {"word": [2]}, [0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [[0, 1, 2, 3], None, [0]] * 1500
    assert peak < 4_000_000
