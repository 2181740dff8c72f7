import public_tokenizers as tokenizers

from winnow.llm import token_counts
from winnow.llm.vocabulary import encoding_of

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")


def test_against_brute_force(spark, awkward, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 4)
    encode = encoding_of(RANKS, tokenizers.PATTERN).encode_ordinary
    sizes = sorted(len(encode(r.text or "")) for r in awkward.collect())
    hist = token_counts.histogram(token_counts.lengths(awkward, RANKS, tokenizers.PATTERN))
    sums = token_counts.suffix_sums(hist)
    assert sum(r.n_docs for r in sums.collect()) == len(sizes)
    for r in sums.collect():
        limit = r.n_tokens
        assert r.n_docs == sizes.count(limit)
        assert r.docs_at_least == sum(s >= limit for s in sizes) and r.tokens_at_least == sum(s for s in sizes if s >= limit)
        assert r.docs_cut == sum(s > limit for s in sizes) and r.truncated_tokens == sum(min(s, limit) for s in sizes)
        assert abs(r.quantile - sum(s <= limit for s in sizes) / len(sizes)) < 1e-12
    limits = spark.createDataFrame([(x,) for x in (0, 1, 3, 17, 17, 10**6, None, -1)], "context long")
    for r in token_counts.at_limits(sums, limits).collect():
        assert (r.docs_cut, r.truncated_tokens) == (sum(s > r.context for s in sizes), sum(min(s, r.context) for s in sizes))
    assert token_counts.at_limits(sums, limits).count() == 5


def test_empty(nothing):
    assert token_counts.suffix_sums(token_counts.histogram(token_counts.lengths(nothing, RANKS, tokenizers.PATTERN))).count() == 0
