import random
import time
import tracemalloc

import public_tokenizers as tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from winnow.llm.bpe import Encoder, Pairs, encode, encode_digests, merge_all, merge_long
from winnow.llm.vocabulary import encoding_of

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
OWN = Encoder(RANKS, tokenizers.PATTERN)
LIBRARY = encoding_of(RANKS, tokenizers.PATTERN)


def same(text: str) -> bool:
    ids = OWN.ids([text])[0]
    return ids == " ".join(map(str, LIBRARY.encode_ordinary(text))) and OWN.decode(ids) == text.encode()


@given(st.text(max_size=80).filter(lambda t: t.encode("utf-8", "ignore").decode() == t))
@settings(max_examples=300, deadline=None)
def test_any_text_as_the_library(text):
    assert same(text)


@pytest.mark.parametrize("text", ["", "a" * 30_001, "ab" * 9000, "thequick" * 2000, "they're it's I'll", " \n\n  x \t", "x\x1cy\x85z\xa0 　w", "²½ ªº ñandú 漢字 😀"])
def test_long_and_odd_texts(text):
    assert same(text)


def test_merges_that_bring_up_a_lower_rank():
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"bc": 256, b"abc": 257, b"ab": 258, b"abab": 259, b"aba": 260, b"abca": 261, b"cab": 262}
    pairs = Pairs(ranks)

    def plain(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = min(((ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1)), default=(1 << 30, 0))
            if found[0] == 1 << 30:
                return [ranks[p] for p in parts]
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]

    random.seed(5)
    pieces = ["".join(random.choice("abc") for _ in range(random.randint(1, 14))).encode() for _ in range(400)]
    assert merge_all(pieces, ranks, pairs) == [plain(p) for p in pieces]
    assert [merge_long(p, ranks) for p in pieces] == [plain(p) for p in pieces]


@pytest.mark.parametrize("word", ["and", "band", "a", "thequick"])
def test_time_grows_with_the_length_of_a_repeated_word(word):
    def seconds(size):
        text = (word * size)[:size]
        assert same(text)
        start = time.process_time()
        OWN.ids([text])
        return time.process_time() - start

    assert seconds(64_000) < 4.5 * max(0.05, min(seconds(16_000) for _ in range(3)))


def test_texts_of_megabytes():
    random.seed(9)
    assert same("".join(random.choice("abcdefgh-_0123456789") for _ in range(1_000_000)))
    assert same("word and " * 250_000)
    assert same(" " * 300_000 + "\n" * 300_000)


def test_table(awkward, nothing):
    rows = encode(awkward, RANKS, tokenizers.PATTERN).collect()
    texts = [r.text or "" for r in awkward.collect()]
    assert sorted((r.ids for r in rows)) == sorted(LIBRARY.encode_ordinary(t) for t in texts)
    assert sorted(bytes(r.decoded) for r in rows) == sorted(t.encode() for t in texts)
    assert encode_digests(awkward, RANKS, tokenizers.PATTERN).where("doc_id is null").count() == 2
    assert encode(nothing, RANKS, tokenizers.PATTERN).count() == 0


def test_slices_measure_texts_without_copies_of_them():
    import pyarrow as pa

    from winnow.llm import bpe

    texts = ["é" * 400, None, "", "a" * 2500, "b" * 599, "c", "\U0001f600" * 1000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9), pa.int64()), pa.array(["x" * 99, *texts, "y"])], names=["id", "text"]).slice(1, 7)
    tracemalloc.start()
    parts = [p.column(1).to_pylist() for p in bpe.slices(batch, 1000)]
    tracemalloc.stop()
    assert sum(parts, []) == texts and [len(p) for p in parts] == [3, 1, 2, 1]
    big = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(["word " * 2000] * 400)], names=["id", "text"])
    tracemalloc.start()
    assert sum(p.num_rows for p in bpe.slices(big, 50_000)) == 400
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000


def test_new_words_of_a_slice_merge_in_few_turns(monkeypatch):
    random.seed(11)
    words = {"".join(random.choice("aeiouthndsérl") for _ in range(random.randint(2, 30))) for _ in range(5000)}
    turns, of = [], Pairs.of
    monkeypatch.setattr(Pairs, "of", lambda self, left, right: turns.append(len(left)) or of(self, left, right))
    text = " ".join(sorted(words)) + " " + "ha" * 100 + " " + "=" * 120 + " " + "nana" * 30 + "n"
    assert Encoder(RANKS, tokenizers.PATTERN).ids([text])[0] == " ".join(map(str, LIBRARY.encode_ordinary(text)))
    assert len(turns) < 500


def test_single_positions_leave_the_queue_by_rank_and_place():
    from winnow.llm.bpe import RankQueue

    random.seed(12)
    queue, held, left = RankQueue(), [], []
    for _ in range(3000):
        entry = random.choice([3, 70, 4100, 49_000]), random.randint(0, 50)
        queue.push_one(*entry)
        held.append(entry)
        if random.random() < 0.5:
            left.append(queue.pop_one())
            assert left[-1] == min(held)
            held.remove(left[-1])
    assert [queue.pop_one() for _ in range(len(held))] == sorted(held) and not queue.top
