import hashlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import SF
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from winnow.llm.catalog import op11_token_alignment
from winnow.llm.token_alignment import Side, align, alignment_counts, same_as_ranks, squeezed, texts_in_batches, unsqueezed

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CASES = [
    "<|endoftext|> inside <s> and </s> <unk> <0x41>", "▁already▁marked", "tabs\tand  two  spaces \n", " leading", "🙂🙂 ünï 漢字漢字", "a\x00b\x01", "  wide　",
    "é combining", "word" * 400, "the the the the", "ﬁ ligature", "x",
]


@pytest.fixture(scope="module")
def sides():
    a, b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    return a, b


def spelled(sides, text):
    """Both sides' tokens as (id, start, end), or none if a side doesn't spell the text."""
    a, b = sides
    raw, out = b" " + text.encode(), []
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    bytes_a = [bytes(stand[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        if b"".join(parts) != raw:
            return [], []
        at, tokens = 0, []
        for i, p in zip(ids, parts, strict=True):
            tokens.append((i, at, at + len(p)))
            at += len(p)
        out.append(tokens)
    return out


def brute(sides, rows):
    seen, counts = [], Counter()
    for i, text in rows:
        a, b = spelled(sides, text) if text else ([], [])
        links = []
        for j, (y, bs, be) in enumerate(b):
            links += [(k, j, x, y) for k, (x, s, e) in enumerate(a) if s < be and bs < e]
        counts.update((x, y) for _, _, x, y in links)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = []
        for lo, hi in zip([0, *ends], ends, strict=False):
            part = [",".join(str(i) for i, s, _ in t if lo <= s < hi) for t in (a, b)]
            groups.append("|".join(part))
        seen.append((i, a, b, sorted(links), ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    out = []
    for i, a, b, links, groups in seen:
        pairs = [(x, y) for _, _, x, y in links]
        out.append((i, len(a), len(b), groups.count(";") + bool(groups), len(links), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr), seen


def taken(df):
    return sorted(map(tuple, df.collect()), key=repr)


QUICK, WHOLE = Side(A_PATH, public_tokenizers.PATTERN), Side(A_PATH)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("ab'sévß \n\t\r.,<|>_17ÿ\xa0\x1c­½é漢"), max_size=30))
def test_words_are_cut_as_the_tokenizer_cuts_them(text):
    assert QUICK.encode([text]) == WHOLE.encode([text])


def test_every_settled_character():
    assert same_as_ranks(A_PATH) and QUICK.encode is not WHOLE.encode
    texts = [f"{c}{c} a{c}b {c}'s 1{c}{c}  {c}\n{c}" for c in map(chr, range(1, 0x180))] + ["", " ", "  ", "a ", " a  b ", "\n", " \n \n", *CASES]
    assert QUICK.encode(texts) == WHOLE.encode(texts)


def test_every_document(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    assert QUICK.encode(texts) == WHOLE.encode(texts)


@pytest.mark.parametrize(("block", "pattern"), [(8 << 20, None), (300, public_tokenizers.PATTERN)])
def test_counts_against_brute_force(spark, awkward, sides, block, pattern):
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(100 + i, t) for i, t in enumerate(CASES)]
    rows += [(500 + i, "one very common text, many times") for i in range(60)]
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, id string, code int").repartition(4)
    assert taken(alignment_counts(df, A_PATH, B_PATH, pattern, block_bytes=block)) == brute(sides, rows)[0]


def test_the_alignment_itself(spark, sides):
    rows = list(enumerate([*CASES, None, ""]))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id int, text string, links string")
    got = {r.doc_id: r for r in align(df, A_PATH, B_PATH).collect()}
    assert len(got) == len(rows)
    for i, a, b, links, groups in brute(sides, rows)[1]:
        r = got[i]
        assert r.tokens_a == [x for x, _, _ in a] and r.tokens_b == [y for y, _, _ in b]
        assert [(x.a, x.b) for x in r.links] == [(k, j) for k, j, _, _ in links] and r.groups == groups


def test_very_long_texts(spark, sides):
    rows = [(1, "and" * 60_000), (2, "some words of prose, " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in align(df, A_PATH, B_PATH, public_tokenizers.PATTERN).collect():
        x, y = sides[0].encode(" " + rows[r.doc_id - 1][1], add_special_tokens=False).ids, sides[1].encode(rows[r.doc_id - 1][1])
        assert r.tokens_a == x and r.tokens_b == y
        n = r.groups.count(";") + 1
        # a chain of overlapping tokens within each group has one link less than tokens
        assert len(r.links) == len(x) + len(y) - n


def test_empty_table(spark, nothing):
    assert alignment_counts(nothing, A_PATH, B_PATH).collect() == [] and align(nothing, A_PATH, B_PATH).collect() == []


def test_packing_and_batches():
    import numpy as np

    arrays = [np.array([0, 5, 2**40]), np.zeros(0, np.int64), np.arange(1000)]
    assert [x.tolist() for x in unsqueezed(squeezed(*arrays))] == [x.tolist() for x in arrays]
    assert [(s.start, s.stop) for s in texts_in_batches(["ab", None, "c" * 9, "", "d"], 5)] == [(0, 2), (2, 3), (3, 5)]


def test_registered_query(spark, sides):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 3000]
    df = op11_token_alignment(spark, SF)
    assert [k for _, k in df.dtypes] == ["bigint"] * 7 + ["string"]
    got = taken(df)
    assert len(got) == len(rows)
    plain = {i: (n_a, n_b, n_g, n_l, sha) for i, n_a, n_b, n_g, n_l, _, _, sha in brute(sides, short)[0]}
    assert all(plain[r[0]] == (*r[1:5], r[7]) for r in got if r[0] in plain)
