import numpy as np

from winnow.llm.ngram_join import MOST_COUNT, Block, Rule


def test_a_pair_at_the_threshold_with_clamped_counts_survives():
    sizes, one = np.array([MOST_COUNT, MOST_COUNT + 1]), np.array([1, 2])
    rule = Rule(1, MOST_COUNT, MOST_COUNT + 1)  # one shingle more is just allowed
    assert rule.most_apart(*sizes) == 1
    counts = np.minimum(sizes, MOST_COUNT).astype(np.int16)[:, None]
    block = Block(rule, one, sizes, counts, np.array([[3], [4]], dtype=np.uint16), one, np.full(2, -1))
    a, b, apart = block.survivors(np.array([0]), np.array([1]))
    assert (a.tolist(), b.tolist(), apart.tolist()) == ([0], [1], [1])
    few = Block(rule, one, sizes, counts - 1, np.array([[3], [4]], dtype=np.uint16), one, np.full(2, -1))
    assert not len(few.survivors(np.array([0]), np.array([1]))[0])
