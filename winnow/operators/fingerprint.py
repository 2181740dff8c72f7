"""Fingerprint similarity and set-level diversity."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from winnow.functions.numbers import half_even, ratio
from winnow.operators.identity import sample_per_group
from winnow.operators.ranks import row_numbers
from winnow.session import shuffle_parts, small_or_same, written

# Rows of a block: a task compares two blocks, however large their group is.
BLOCK_ROWS = 2048

WORD = 64
# Of the index: sets of a list before it is keyed again, bits shared by the sets of the deepest lists, rows of a bucket,
# pairs that are compared at once.
LIST_ROWS = 4096
MOST_SHARED = 3
BUCKET_ROWS = 20_000
PAIRS_AT_ONCE = 100_000
# Of the comparison by groups: blocks at least, rows of a block at most, widening of the sizes that share a number of
# groups, rows unpacked at once.
LEAST_BLOCKS = 16
SIZE_BLOCK_ROWS = 65_536
SIZE_STEP = 1.15
UNPACKED_ROWS = 4096
# Groups that are tried, and meetings in all groups, as a share of the pairs, beyond which every pair is compared.
TRIED_GROUPS = 8
MOST_MEETINGS = 0.3
# Of greedy coverage: sets of a group that one task decides at once. Rows of a stripe of a comparison.
FIRST_ROWS = 8192
STRIPE = 128


def sign_bits(vector: Column) -> Column:
    """Positions of the positive entries of a vector."""
    marked = F.transform(vector, lambda x, i: F.when(x > 0, i))
    return F.filter(marked, lambda i: i.isNotNull())


def _flat(bits: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """All positions of a batch one after the other, and the row of each."""
    sizes = bits.map(len).to_numpy()
    positions = np.concatenate([np.zeros(0, np.int64), *bits]).astype(np.int64)
    return positions, np.repeat(np.arange(len(bits)), sizes)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _words(bits: pd.Series, n_words: pd.Series) -> pd.Series:
    """Set-bit positions as 64-bit words."""
    n = int(n_words.iloc[0]) if len(n_words) else 1
    positions, row = _flat(bits)
    flags = np.zeros((len(bits), n * WORD), dtype=np.uint8)
    flags[row, positions] = 1
    return pd.Series(list(np.packbits(flags, axis=1, bitorder="little").view(np.int64)))


def fingerprint_groups(df: DataFrame, row_id: str, bits: str) -> tuple[DataFrame, DataFrame]:
    """(representatives, members): one row per distinct bit set with its number of copies, and the
    representative of every row.  Pairs are computed between representatives only, so a bit set
    with many copies costs as much as one."""
    keyed = df.select(row_id, F.array_sort(F.array_distinct(bits)).alias("bits"))
    # the digest stands for the bits wherever rows are grouped or joined; bits may be dear, so they are made once
    digest = F.sha2(F.array_join(F.col("bits").cast("array<string>"), ","), 256)
    keyed = written(keyed.withColumn("digest", digest), "digests")
    reps = keyed.groupBy("digest").agg(F.min(row_id).alias("rep"), F.count(F.lit(1)).alias("copies"))
    sets = keyed.join(reps.select("rep", "copies"), keyed[row_id] == F.col("rep")).select("rep", "bits", "copies")
    return sets, keyed.select(row_id, "digest").join(reps, "digest").select(row_id, "rep")


def similar_pairs(
    df: DataFrame, row_id: str, bits: str, threshold: float, n_bits: int, method: str = "index", block_rows: int = BLOCK_ROWS,
    list_rows: int = LIST_ROWS, size_block_rows: int = SIZE_BLOCK_ROWS,
) -> DataFrame:
    """All pairs of distinct bit sets with Tanimoto >= threshold: (id_a, id_b, similarity, copies_a, copies_b).

    Exact by any method.  ``blocks`` is for short or dense bit sets, most of which are similar to many others: sets
    are dealt to blocks of bounded size and every pair is compared once, in even tasks.  ``index`` is for sets with rare bits:
    the bits of a set are ordered from the rarest to the commonest of the table, and two sets that are t-similar share one
    of their first (1 - t) n + 1 bits, so only sets in a common list of an inverted index over these meet.  A list of
    more than ``list_rows`` sets is keyed again by the next shared bit (similar sets share two of their first
    (1 - t) n + 2 bits, and so on, ``MOST_SHARED`` at most); what is still longer is cut into chunks that meet in pairs.
    Pairs are held against bounds by size and place in the list and then compared on all their bits.
    ``groups`` is for sets without rare bits, whose lists would be nearly as long as the table: sets of near sizes meet in
    blocks, as packed words, and in a task only pairs that agree in a whole group of bits are compared (see
    ``_similar_by_groups``). A set is sent a few times, whatever its bits; the work in the tasks grows with the pairs of
    blocks.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    if method not in ("index", "blocks", "groups"):
        raise ValueError(f"unknown method: {method}")
    reps, _ = fingerprint_groups(df, row_id, bits)
    if method == "blocks":
        return _similar_in_blocks(written(reps.filter(F.size("bits") > 0), "sets"), threshold, n_bits, block_rows)
    if method == "groups":
        return _similar_by_groups(written(reps.filter(F.size("bits") > 0), "sets"), threshold, n_bits, size_block_rows)
    sets = written(_by_rarity(reps.filter(F.size("bits") > 0), n_bits), "ranked")
    lists = _index_lists(sets, threshold, list_rows)
    rows = lists.agg(F.count(F.lit(1))).first()[0]
    buckets = max(shuffle_parts(df.sparkSession), -(-rows // BUCKET_ROWS))
    n_words = (n_bits + WORD - 1) // WORD
    kind = dict(sets.dtypes)["rep"]
    words = sets.select(F.col("rep").alias("of"), _words("order", F.lit(n_words)).alias("words"))
    # lists of equal keys lie side by side in a bucket, so that many short ones are one call
    dealt = lists.join(words, lists["rep"] == words["of"]).select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), "key", "rep", "size", "pos", "level", "words")

    def compare(table: pa.Table) -> pa.Table:
        a, b, similarity = _similar_in_lists(table, threshold, n_words)
        ids = table["rep"].combine_chunks()
        return pa.Table.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(similarity)], names=["a", "b", "similarity"])

    pairs = dealt.groupBy("bucket").applyInArrow(compare, f"a {kind}, b {kind}, similarity double")
    pairs = pairs.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "similarity").distinct()
    return _with_copies(pairs, sets)


def _with_copies(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    copies = sets.select("rep", "copies")
    for side in "ab":
        pairs = pairs.join(copies.withColumnsRenamed({"rep": f"id_{side}", "copies": f"copies_{side}"}), f"id_{side}")
    return pairs.select("id_a", "id_b", "similarity", "copies_a", "copies_b")


def _by_rarity(sets: DataFrame, n_bits: int) -> DataFrame:
    """``order``: the bits of each set as ranks, rarest first. The counts that decide are one number per position."""
    counts = sets.select(F.explode("bits").alias("bit")).groupBy("bit").agg(F.count(F.lit(1)).alias("n"))
    n = {r["bit"]: r["n"] for r in counts.collect()}
    ranks = [0] * n_bits
    for rank, bit in enumerate(sorted(range(n_bits), key=lambda b: (n.get(b, 0), b))):
        ranks[bit] = rank
    listed = F.from_json(F.lit(json.dumps(ranks)), "array<int>")
    order = F.array_sort(F.transform("bits", lambda b: listed[b.cast("int")]))
    return sets.select("rep", "copies", F.size("bits").alias("size"), order.alias("order"))


def _index_lists(sets: DataFrame, threshold: float, list_rows: int) -> DataFrame:
    """(key, rep, size, pos, level): the lists of the index; level bits are shared by all sets of a list."""

    def prefix(level: int) -> Column:
        # t * n is rounded down a little first, so that rounding never shortens a prefix
        needed = F.ceil(F.col("size") * threshold - 1e-9)
        return F.least(F.col("size"), F.greatest(F.col("size") - needed + level, F.lit(0))).cast("int")

    def chunked(rows: DataFrame) -> DataFrame:
        """Rows of a long list once for each pair of its chunks that their own is in."""
        chunks = F.ceil(F.col("n") / F.lit(list_rows)).cast("int")
        own = F.pmod(F.xxhash64("rep"), chunks).cast("int")
        cut = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
        return cut.withColumn("key", F.xxhash64("key", F.lit("chunks"), F.least("own", "other"), F.greatest("own", "other")))

    first = F.posexplode(F.slice("order", F.lit(1), prefix(1))).alias("pos", "rank")
    now = sets.select("rep", "size", "order", first).select("rep", "size", "order", "pos", F.xxhash64("rank").alias("key"))
    out = []
    for level in range(1, MOST_SHARED + 1):
        counts = now.groupBy(F.col("key").alias("long")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > list_rows)
        now = now.join(small_or_same(counts, "long-lists"), F.col("key") == F.col("long"), "left")
        is_long = F.col("n").isNotNull()
        # sets so small that a similar one may share no further bit stay in the list
        stays = F.lit(True) if level == MOST_SHARED else F.col("size") * threshold <= level
        here = now.filter(~is_long).unionByName(chunked(now.filter(is_long & stays)).drop("own", "other"))
        out.append(here.select("key", "rep", "size", "pos", F.lit(level).alias("level")))
        if level < MOST_SHARED:
            after = F.slice("order", F.col("pos") + 2, F.greatest(prefix(level + 1) - F.col("pos") - 1, F.lit(0)))
            longer = now.filter(is_long).select("rep", "size", "order", F.col("pos").alias("before"), "key", F.posexplode(after).alias("k", "rank"))
            now = longer.select("rep", "size", "order", (F.col("before") + 1 + F.col("k")).alias("pos"), F.xxhash64("key", "rank").alias("key"))
    return written(reduce(DataFrame.unionByName, out), "lists")


def _similar_in_lists(table: pa.Table, threshold: float, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows with the same key that reach the threshold: rows, rows, similarity."""
    key, size = table["key"].to_numpy(), table["size"].to_numpy().astype(np.int64)
    order = np.lexsort((size, key))
    key, size = key[order], size[order]
    rest = size - table["pos"].to_numpy()[order] - 1
    level = table["level"].to_numpy()[order]
    words = table["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, n_words)
    segment = np.cumsum(np.append(0, key[1:] != key[:-1]))
    wide = int(size.max(initial=0)) + 2
    reach = np.minimum((size / threshold + 1e-9).astype(np.int64), wide - 1)
    partners = np.searchsorted(segment * wide + size, segment * wide + reach, "right") - np.arange(size.size) - 1
    found = []
    edges = np.append(0, np.cumsum(partners))
    for lo in _slices(edges):
        i = np.repeat(np.arange(*lo), partners[slice(*lo)])
        j = i + 1 + np.arange(i.size) - (edges[i] - edges[lo[0]])
        union_and_shared = size[i] + size[j]
        least = np.ceil(threshold / (1 + threshold) * union_and_shared - 1e-9)
        near = level[i] + np.minimum(rest[i], rest[j]) >= least
        i, j, both = i[near], j[near], union_and_shared[near]
        shared = np.bitwise_count(words[order[i]] & words[order[j]]).sum(axis=1, dtype=np.int64)
        similarity = shared / (both - shared)
        good = similarity >= threshold
        found.append((order[i[good]], order[j[good]], similarity[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _size_blocks(sets: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Sets once for each pair of blocks that theirs is in: (..., block, i, j), i <= j.

    Blocks are even ranges of the sets in the order of their sizes, sets of one size dealt by hash; only blocks that hold
    sizes near enough for the threshold meet. What decides is one number per size.
    """
    counted = sorted((r["size"], r["n"]) for r in sets.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect())
    sizes, counts = np.array([s for s, _ in counted], int), np.array([n for _, n in counted], int)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    blocks = max(LEAST_BLOCKS, -(-total // block_rows))
    rows = max(1, -(-total // blocks))
    starts = np.arange(0, max(total, 1), rows)
    if total:
        low = sizes[np.searchsorted(ends, starts, "right")]
        high = sizes[np.searchsorted(ends, np.minimum(starts + rows, total) - 1, "right")]
    else:
        low = high = np.zeros(1, int)
    # a is near b if a >= t * b, rounded so that no pair is missed
    first = np.searchsorted(high, threshold * low - 1e-9, "left")
    last = np.searchsorted(threshold * low - 1e-9, high, "right") - 1
    by_size = {int(s): [int(e - n), int(n)] for s, n, e in zip(sizes, counts, ends, strict=True)}
    places = F.from_json(F.lit(json.dumps([by_size.get(s, [0, 1]) for s in range(int(sizes.max(initial=0)) + 1)])), "array<array<long>>")
    reach = F.from_json(F.lit(json.dumps([[int(min(f, k)), int(max(n, k))] for k, (f, n) in enumerate(zip(first, last, strict=True))])), "array<array<int>>")
    own = places[F.col("size")]
    placed = sets.withColumn("block", F.floor((own[0] + F.pmod(F.xxhash64("rep"), own[1])) / F.lit(rows)).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(reach[F.col("block")][0], reach[F.col("block")][1])))
    return met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")


def _similar_by_groups(reps: DataFrame, threshold: float, n_bits: int, block_rows: int) -> DataFrame:
    """Two sets of at most D different bits agree in one whole group of bits, if the bits are cut into D + 1 groups.

    Bits are dealt to groups by rarity, so that groups are alike. Sets meet in blocks of near sizes, every pair in one
    task; what agrees in a group there is compared on all its bits, and a pair is given at the first group it agrees in.
    """
    kind = dict(reps.dtypes)["rep"]
    n_words = (n_bits + WORD - 1) // WORD
    ranked = _by_rarity(reps, n_bits)
    sets = written(ranked.select("rep", "copies", "size", _words("order", F.lit(n_words)).alias("words")), "words")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        size, block = table["size"].to_numpy().astype(np.int64), table["block"].to_numpy()
        words = table["words"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, n_words)
        ids, copies = table["rep"].combine_chunks(), table["copies"].combine_chunks()
        order = np.argsort(size, kind="stable")
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        left, right = order[block[order] == i], order[block[order] == j]
        for a, b, similarity in _agreeing(words, size, left, right, i == j, threshold):
            a, b = pa.array(left[a]), pa.array(right[b])
            yield pa.RecordBatch.from_arrays(
                [ids.take(a), ids.take(b), pa.array(similarity), copies.take(a), copies.take(b)], names=["a", "b", "similarity", "ca", "cb"]
            )

    cells = _size_blocks(sets, threshold, block_rows).select("i", "j", "block", "rep", "copies", "size", "words")
    pairs = cells.groupBy("i", "j").applyInArrow(compare, f"a {kind}, b {kind}, similarity double, ca long, cb long")
    swapped = F.col("a") > F.col("b")
    return pairs.select(
        F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "similarity",
        F.when(swapped, F.col("cb")).otherwise(F.col("ca")).alias("copies_a"), F.when(swapped, F.col("ca")).otherwise(F.col("cb")).alias("copies_b"),
    )


def _group_sums(words: np.ndarray, groups: int) -> np.ndarray:
    """A checksum of the bits of every group, for each row."""
    n_bits = words.shape[1] * WORD
    # sums of up to 2,048 such numbers are exact as double; equal sums of different bits only cost a comparison
    values = np.random.default_rng(1).integers(1, 1 << 40, n_bits).astype(float)
    out = np.empty((len(words), groups), np.uint32)
    for lo in range(0, len(words), UNPACKED_ROWS):
        part = words[lo : lo + UNPACKED_ROWS]
        row, bit = np.nonzero(np.unpackbits(part.view(np.uint8), axis=1, bitorder="little"))
        sums = np.bincount(row * groups + bit % groups, values[bit], len(part) * groups)
        out[lo : lo + UNPACKED_ROWS] = (sums.astype(np.int64) & 0xFFFFFFFF).reshape(len(part), groups)
    return out


def _mean_partners(gx: np.ndarray, gy: np.ndarray) -> float:
    """Pairs that agree in a group, as the mean of a few groups."""
    some = np.unique(np.linspace(0, gx.shape[1] - 1, TRIED_GROUPS).astype(int))
    keys = [np.sort(gy[:, g]) for g in some]
    return float(np.mean([(np.searchsorted(k, gx[:, g], "right") - np.searchsorted(k, gx[:, g], "left")).sum() for g, k in zip(some, keys, strict=True)]))


def _all_pairs(
    x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, ahead: int | None, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that reach the threshold, by stripes. With ``ahead``, x lies that many rows ahead of y in one block."""
    for lo in range(0, len(x), STRIPE):
        part = x[lo : lo + STRIPE]
        end = int(np.searchsorted(sy, sx[lo + len(part) - 1] / threshold + 1e-9, "right"))
        for at in range(0 if ahead is None else max(0, lo + ahead + 1), end, BLOCK_ROWS):
            similarity = _tanimoto(part, y[at : min(at + BLOCK_ROWS, end)])
            i, j = np.nonzero(similarity >= threshold)
            if ahead is not None:
                once = i + lo + ahead < j + at
                i, j = i[once], j[once]
            if i.size:
                yield i + lo, j + at, similarity[i, j]


def _agreeing(
    words: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, threshold: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in left, places in right, similarity) of the pairs that reach the threshold, each once.

    Both sides are in the order of their sizes, and no set of ``left`` is larger than one of ``right``; ``same`` says that
    they are one block, of which a pair is given once.
    """
    far = (1 - threshold) / (1 + threshold)
    small, large = size[left], size[right]
    head = max(1, words.shape[1] // 4)
    at = 0
    while at < right.size:
        to = int(np.searchsorted(large, max(large[at] * SIZE_STEP, large[at] + 1), "left"))
        of = slice(int(np.searchsorted(small, threshold * large[at] - 1e-9, "left")), int(np.searchsorted(small, large[to - 1], "right")))
        x, y, first_x, first_y = words[left[of]], words[right[at:to]], of.start, at
        sx, sy = small[of], large[at:to]
        at = to
        if not len(x):
            continue
        groups = int(2 * far * sy[-1] + 1e-9) + 1
        gx, gy = (_group_sums(w, groups) if groups <= words.shape[1] * WORD else None for w in (x, y))
        if gx is None or _mean_partners(gx, gy) * groups > MOST_MEETINGS * len(x) * len(y):
            for i, j, similarity in _all_pairs(x, y, sx, sy, first_x - first_y if same else None, threshold):
                yield i + first_x, j + first_y, similarity
            continue
        for g in range(groups):
            order = np.argsort(gy[:, g], kind="stable")
            keys = gy[order, g]
            lo = np.searchsorted(keys, gx[:, g], "left")
            partners = np.searchsorted(keys, gx[:, g], "right") - lo
            edges = np.append(0, np.cumsum(partners))
            for part in _slices(edges):
                i = np.repeat(np.arange(*part), partners[slice(*part)])
                j = order[lo[i] + np.arange(i.size) - (edges[i] - edges[part[0]])]
                near = sx[i] >= threshold * sy[j] - 1e-9
                if same:
                    near &= i + first_x < j + first_y
                i, j = i[near], j[near]
                most = far * (sx[i] + sy[j]) + 1e-9
                near = np.bitwise_count(x[i, :head] ^ y[j, :head]).sum(axis=1, dtype=np.int64) <= most
                i, j = i[near], j[near]
                shared = np.bitwise_count(x[i] & y[j]).sum(axis=1, dtype=np.int64)
                similarity = shared / (sx[i] + sy[j] - shared)
                good = similarity >= threshold
                i, j, similarity = i[good], j[good], similarity[good]
                if g:
                    new = ~(gx[i, :g] == gy[j, :g]).any(axis=1)
                    i, j, similarity = i[new], j[new], similarity[new]
                if i.size:
                    yield i + first_x, j + first_y, similarity


def _slices(edges: np.ndarray, most: int = PAIRS_AT_ONCE):
    """(first, last) row ranges of about ``most`` pairs; ``edges`` are running totals, a row of more pairs is alone."""
    lo, n = 0, edges.size - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def _packed(bits: pd.Series, n_bits: int) -> np.ndarray:
    """A row of 64-bit words per bit set."""
    n_words = (n_bits + WORD - 1) // WORD
    positions, row = _flat(bits)
    flags = np.zeros((len(bits), n_words * WORD), dtype=np.uint8)
    flags[row, positions] = 1
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def _stacked(words: pd.Series) -> np.ndarray:
    return np.stack(words.to_list()).view(np.uint64) if len(words) else np.zeros((0, 1), np.uint64)


def _tanimoto(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of all rows of a to all rows of b; two empty sets have none."""
    sizes = np.bitwise_count(a).sum(axis=1, dtype=np.int32)[:, None] + np.bitwise_count(b).sum(axis=1, dtype=np.int32)[None, :]
    shared = np.zeros(sizes.shape, np.int32)
    for lo in range(0, len(a), STRIPE):  # a stripe of rows at a time stays in the cache
        for w in range(a.shape[1] if len(b) else 0):
            shared[lo : lo + STRIPE] += np.bitwise_count(a[lo : lo + STRIPE, w, None] & b[None, :, w])
    return np.divide(shared, sizes - shared, out=np.zeros(sizes.shape), where=sizes > shared)


def block_pairs(df: DataFrame, group: str, row_id: str, keep: Sequence[str], block_rows: int) -> DataFrame:
    """Every row once for each pair of blocks its block is in: (group, row_id, keep..., __block, __i, __j), __i <= __j.

    A group of n rows has ceil(n / block_rows) blocks, dealt by a hash of the row id, and every pair of rows meets in
    exactly one pair of blocks. Blocks are bounded, so a hot group is many even tasks.
    """
    rows = df.select(group, row_id, *keep)
    n = small_or_same(rows.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n")), "group-sizes")
    rows = rows.join(n, rows[group].eqNullSafe(n["__g"])).drop("__g")
    blocks = F.ceil(F.col("__n") / F.lit(block_rows)).cast("int")
    rows = rows.withColumn("__block", F.pmod(F.xxhash64(row_id), blocks).cast("int"))
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(group, row_id, *keep, "__block", F.least("__block", "__other").alias("__i"), F.greatest("__block", "__other").alias("__j"))


def _similar_in_blocks(reps: DataFrame, threshold: float, n_bits: int, block_rows: int) -> DataFrame:
    kind = dict(reps.dtypes)["rep"]

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = _sides(pdf)
        sim = _tanimoto(_packed(left["bits"], n_bits), _packed(right["bits"], n_bits))
        i, j = np.nonzero(np.triu(sim, 1) >= threshold if same else sim >= threshold)
        return pd.DataFrame({"a": left["rep"].to_numpy()[i], "b": right["rep"].to_numpy()[j], "similarity": sim[i, j]})

    cells = block_pairs(reps.withColumn("__all", F.lit(0)), "__all", "rep", ["bits"], block_rows)
    pairs = cells.groupBy("__i", "__j").applyInPandas(find, f"a {kind}, b {kind}, similarity double")
    return _with_copies(pairs.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "similarity"), reps)


def _sides(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    """The two blocks of a pair, and whether they are one and the same."""
    i, j = pdf["__i"].iloc[0], pdf["__j"].iloc[0]
    return pdf[pdf["__block"] == i], pdf[pdf["__block"] == j], i == j


def distinct_sets(df: DataFrame, group: str, row_id: str, bits: str, n_bits: int) -> DataFrame:
    """One row per group and distinct bit set: (group, set, words, copies, first), where ``set`` is a digest of the words
    and ``first`` the smallest row id. Copies are counted before they are shuffled, so they cost nothing later."""
    packed = df.select(group, F.col(row_id).alias("first"), _words(bits, F.lit((n_bits + WORD - 1) // WORD)).alias("words"))
    sets = packed.groupBy(group, "words").agg(F.count(F.lit(1)).alias("copies"), F.min("first").alias("first"))
    return sets.select(group, F.sha2(F.array_join(F.col("words").cast("array<string>"), ","), 256).alias("set"), "words", "copies", "first")


def tanimoto_profile(df: DataFrame, group: str, row_id: str, bits: str, n_bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean and largest similarity of every row to the other rows of its group; NULL for the only row of a group.

    All rows take part: distinct bit sets are compared block by block, weighted by their copies, and each set's sums
    then go to its rows.
    """
    sets = written(distinct_sets(df, group, row_id, bits, n_bits), "sets")

    def profile(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = _sides(pdf)
        sim = _tanimoto(_stacked(left["words"]), _stacked(right["words"]))
        out = []
        for side, other, s in ((left, right, sim),) if same else ((left, right, sim), (right, left, sim.T)):
            weights = other["copies"].to_numpy(dtype=float)
            sums, own = s @ weights, np.zeros(len(side))
            if same:  # a row is no other row of itself, but its copies are
                own = np.diagonal(s).copy()
                s = np.where(np.eye(len(side), dtype=bool) & (weights == 1), 0.0, s)
            most = s.max(axis=1) if s.size else np.zeros(len(side))
            out.append(pd.DataFrame({group: side[group], "set": side["set"], "s": sums - own, "m": most}))
        return pd.concat(out)

    schema = f"`{group}` {dict(df.dtypes)[group]}, set string, s double, m double"
    cells = block_pairs(sets, group, "set", ["words", "copies"], block_rows).groupBy(group, "__i", "__j").applyInPandas(profile, schema)
    sums = cells.groupBy(group, "set").agg(F.sum("s").alias("s"), F.max("m").alias("m"))
    n = small_or_same(sets.groupBy(F.col(group).alias("__g")).agg(F.sum("copies").alias("__n")), "group-sizes")
    sums = sums.join(n, sums[group].eqNullSafe(n["__g"])).select(F.col(group).alias("__group"), F.col("set").alias("__set"), "s", "m", "__n")
    words = _words(bits, F.lit((n_bits + WORD - 1) // WORD))
    keyed = df.select(group, row_id, F.sha2(F.array_join(words.cast("array<string>"), ","), 256).alias("set"))
    out = keyed.join(sums, keyed[group].eqNullSafe(F.col("__group")) & (keyed["set"] == F.col("__set")))
    many = F.col("__n") > 1
    return out.select(
        group, row_id, F.when(many, F.col("s") / (F.col("__n") - 1)).alias("mean_similarity"), F.when(many, F.col("m")).alias("max_similarity")
    )


def int_div(df: DataFrame, group: str, row_id: str, bits: str, n_bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Internal diversity per group: 1 - mean(T) and 1 - sqrt(mean(T^2)) over all ordered pairs of its rows, self included.

    All rows take part: distinct bit sets are compared block by block, each pair weighted by its copies. The work is the
    square of a group's distinct sets; ``int_div_estimate`` is for groups where that is out of reach.
    """

    def partial(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, same = _sides(pdf)
        sim = _tanimoto(_stacked(left["words"]), _stacked(right["words"]))
        a, b = left["copies"].to_numpy(dtype=float), right["copies"].to_numpy(dtype=float)
        times = 1.0 if same else 2.0
        return pd.DataFrame({group: [pdf[group].iloc[0]], "s1": [times * (a @ sim @ b)], "s2": [times * (a @ sim**2 @ b)]})

    sets = written(distinct_sets(df, group, row_id, bits, n_bits), "sets")
    schema = f"`{group}` {dict(df.dtypes)[group]}, s1 double, s2 double"
    sums = block_pairs(sets, group, "set", ["words", "copies"], block_rows).groupBy(group, "__i", "__j").applyInPandas(partial, schema)
    sums = sums.groupBy(group).agg(F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    counts = sets.groupBy(F.col(group).alias("__g")).agg(F.sum("copies").alias("n"))
    n = F.col("n")
    return sums.join(counts, sums[group].eqNullSafe(counts["__g"])).select(
        group, "n", (1 - F.col("s1") / (n * n)).alias("int_div1"), (1 - F.sqrt(F.col("s2") / (n * n))).alias("int_div2")
    )


def int_div_estimate(
    df: DataFrame, group: str, row_id: str, bits: str, n_bits: int, pairs: int = 100_000, seed: int = 42, z: float = 3.0
) -> DataFrame:
    """Internal diversity per group from random pairs, with an interval: (group, n, pairs, int_div1, error1, int_div2, error2).

    Two independent samples of a group's rows are laid side by side by rank, so each of the ``pairs`` pairs is uniform
    over all ordered pairs, self included, as in ``int_div``. ``error`` is ``z`` standard errors: with z = 3 the exact
    value lies within it in 99.7 % of cases once a few hundred pairs are drawn. The work is linear in the rows. A group
    of fewer than ``pairs`` rows gives a pair per row; one of a single row has no error.
    """

    def side(name: str, own_seed: int) -> DataFrame:
        chosen, _ = sample_per_group(df.select(group, row_id, bits), [group], row_id, pairs, own_seed)
        order = F.md5(F.concat_ws(":", F.lit(str(own_seed)), F.col(row_id).cast("string")))
        ranked = row_numbers(chosen.withColumn("__tag", order), [group], ["__tag", row_id], "__rank")
        return ranked.select(F.col(group).alias(f"{name}_group"), F.col("__rank").alias(f"{name}_rank"), F.col(bits).alias(f"{name}_bits"))

    a, b = side("a", seed), side("b", seed + 1)
    drawn = a.join(b, (F.col("a_rank") == F.col("b_rank")) & F.col("a_group").eqNullSafe(F.col("b_group")))
    words = F.lit((n_bits + WORD - 1) // WORD)
    drawn = drawn.select(F.col("a_group").alias(group), _words("a_bits", words).alias("x"), _words("b_bits", words).alias("y"))

    def count(w: Column) -> Column:
        return F.aggregate(w, F.lit(0), lambda n, v: n + v)

    shared = count(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseAND(q))))
    union = count(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseOR(q))))
    t = drawn.select(group, F.when(union > 0, shared / union).otherwise(0.0).alias("t"))
    k, mean, square = F.count(F.lit(1)), F.avg("t"), F.avg(F.col("t") * F.col("t"))
    stats = t.groupBy(group).agg(k.alias("pairs"), mean.alias("m1"), square.alias("m2"), F.stddev_samp("t").alias("d1"), F.stddev_samp(F.col("t") * F.col("t")).alias("d2"))
    sizes = df.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("n"))
    root = F.sqrt(F.col("pairs"))
    error2 = F.when(F.col("m2") > 0, z * F.col("d2") / (2 * F.sqrt("m2") * root)).otherwise(0.0)
    return stats.join(sizes, stats[group].eqNullSafe(sizes["__g"])).select(
        group, "n", "pairs", (1 - F.col("m1")).alias("int_div1"), F.coalesce(z * F.col("d1") / root, F.lit(0.0)).alias("error1"),
        (1 - F.sqrt("m2")).alias("int_div2"), F.coalesce(error2, F.lit(0.0)).alias("error2"),
    )


def sphere_exclusion(
    df: DataFrame, group: str, row_id: str, bits: str, n_bits: int, distance: float = 0.65, block_rows: int = BLOCK_ROWS, first_rows: int = FIRST_ROWS
) -> DataFrame:
    """Greedy coverage per group: in id order a row is picked if it is farther than ``distance``
    (1 - Tanimoto) from every earlier pick; the metric is picks / rows.

    All rows take part; of equal bit sets only the first row can be picked, so the sets are decided. While that at least
    halves what is undecided, the first ``first_rows`` sets of every group are decided in one task and rule out the rest
    near their picks. What is left then has few near neighbours and is decided by rounds over the table of near pairs: a
    set is picked when no earlier near one is undecided, and out when an earlier near one is picked.
    """
    kind, id_kind = dict(df.dtypes)[group], dict(df.dtypes)[row_id]
    sets = written(distinct_sets(df, group, row_id, bits, n_bits), "sets")
    counts = sets.groupBy(F.col(group).alias("__g")).agg(F.sum("copies").alias("n"))
    left = sets.select(group, "set", "words", "first")
    schema = f"`{group}` {kind}, set string, words array<long>, first {id_kind}"
    limit = distance + 1e-12
    picks, before = [], sets.count()

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 1.0 - _tanimoto(a, b) <= limit

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first")
        words = _stacked(pdf["words"])
        picked, rest = [], np.arange(len(pdf))
        while rest.size:
            picked.append(rest[0])
            rest = rest[1:][~near(words[rest[:1]], words[rest[1:]])[0]]
        return pdf.iloc[picked][[group, "set", "words", "first"]]

    def exclude(later: pd.DataFrame, picked: pd.DataFrame) -> pd.DataFrame:
        if len(later) and len(picked):
            words, chosen = _stacked(later["words"]), _stacked(picked["words"])
            free = np.ones(len(later), dtype=bool)
            for lo in range(0, len(chosen), STRIPE):
                free[free] = ~near(words[free], chosen[lo : lo + STRIPE]).any(axis=1)
            later = later[free]
        return later[[group, "set", "words", "first"]]

    while before:
        if left.groupBy(group).count().agg(F.max("count")).first()[0] <= first_rows:
            picks.append(left.groupBy(group).applyInPandas(decide, schema).select(group, "set"))
            before = 0
            break
        numbered = written(row_numbers(left, [group], ["first"], "__rn"), "numbered")
        now = written(numbered.filter(F.col("__rn") <= first_rows).groupBy(group).applyInPandas(decide, schema), "picks")
        picks.append(now.select(group, "set"))
        later = numbered.filter(F.col("__rn") > first_rows).withColumn("__block", ((F.col("__rn") - 1) / block_rows).cast("int"))
        # the picks of a group, first_rows at most, go to each of its later blocks
        own = later.select(F.col(group).alias("__g"), F.col("__block").alias("__to")).distinct()
        sent = now.join(own, now[group].eqNullSafe(own["__g"])).select(now[group].alias("__pg"), F.col("__to"), now["set"], now["words"], now["first"])
        sent = sent.withColumnRenamed("__pg", group)
        left = written(later.groupBy(group, "__block").cogroup(sent.groupBy(group, "__to")).applyInPandas(exclude, schema), "undecided")
        after = left.count()
        if after * 2 > before:
            break
        before = after
    if before and after:
        picks.append(_first_independent(left, group, limit, block_rows))
    if not picks:
        return counts.select(F.col("__g").alias(group), "n", F.lit(0).cast("long").alias("picks"), F.lit(0.0).alias("se_div"))
    found = reduce(DataFrame.unionByName, picks).groupBy(group).agg(F.count(F.lit(1)).alias("picks"))
    out = found.join(counts, found[group].eqNullSafe(counts["__g"]))
    return out.select(group, "n", "picks", (F.col("picks") / F.col("n")).alias("se_div"))


def _first_independent(sets: DataFrame, group: str, limit: float, block_rows: int) -> DataFrame:
    """(group, set) of the sets that are picked when all are decided in the order of ``first``, by rounds over near pairs."""
    kind, id_kind = dict(sets.dtypes)[group], dict(sets.dtypes)["first"]

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, same = _sides(pdf)
        close = 1.0 - _tanimoto(_stacked(a["words"]), _stacked(b["words"])) <= limit
        i, j = np.nonzero(np.triu(close, 1) if same else close)
        fa, fb = a["first"].to_numpy()[i], b["first"].to_numpy()[j]
        earlier = fa < fb
        sa, sb = a["set"].to_numpy()[i], b["set"].to_numpy()[j]
        return pd.DataFrame({group: pdf[group].to_numpy()[np.zeros(len(i), int)], "early": np.where(earlier, sa, sb), "late": np.where(earlier, sb, sa)})

    cells = block_pairs(sets, group, "set", ["words", "first"], block_rows)
    edges = written(cells.groupBy(group, "__i", "__j").applyInPandas(pairs, f"`{group}` {kind}, early string, late string"), "near-pairs")
    open_ = sets.select(F.struct(F.col(group), F.col("set")).alias("v"))
    edges = edges.select(F.struct(F.col(group), F.col("early").alias("set")).alias("early"), F.struct(F.col(group), F.col("late").alias("set")).alias("late"))
    picked = []
    while not open_.isEmpty():
        now = written(open_.join(edges.select("late").distinct(), F.col("v") == F.col("late"), "left_anti"), "picked")
        picked.append(now)
        gone = written(edges.join(now, F.col("early") == F.col("v"), "left_semi").select(F.col("late").alias("x")).distinct().unionByName(now.select(F.col("v").alias("x"))), "decided")
        open_ = written(open_.join(gone, F.col("v") == F.col("x"), "left_anti"), "open")
        edges = edges.join(gone, F.col("early") == F.col("x"), "left_anti").join(gone, F.col("late") == F.col("x"), "left_anti")
        edges = written(edges, "edges")
    return reduce(DataFrame.unionByName, picked).select(F.col(f"v.{group}").alias(group), "v.set")


def uniqueness(df: DataFrame, group: str, key: str, valid: Column | None = None) -> DataFrame:
    """Per group: share of valid rows, and distinct keys / valid rows."""
    ok = F.col(key).isNotNull() if valid is None else valid
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(ok.cast("double")).alias("validity"),
        ratio(F.countDistinct(F.when(ok, F.col(key))), F.count_if(ok), None).alias("uniqueness"),
    )


def key_diversity(df: DataFrame, group: str, key: str) -> DataFrame:
    """Distinct keys / rows, and keys seen once / distinct keys, per group."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(group, key).agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(group).agg(
        F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.count(F.lit(1)) / F.sum("c")).alias("key_div"),
        (F.count_if(F.col("c") == 1) / F.count(F.lit(1))).alias("key_uniqueness"),
    )


def array_key_diversity(df: DataFrame, group: str, keys: str) -> DataFrame:
    """Distinct keys / all key occurrences of a list column, per group."""
    counts = df.select(group, F.explode(keys).alias("k")).groupBy(group, "k").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy(group).agg(
        F.sum("c").alias("occurrences"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.count(F.lit(1)) / F.sum("c")).alias("key_div"),
    )


def set_metrics(metrics: dict[str, DataFrame], stage: str, keep: Sequence[str] | None = None, stages: Sequence[str] = ()) -> DataFrame:
    """Metric x stage table, four decimals, only the configured metrics.

    ``metrics`` maps a metric name to a (stage, value) table.
    """
    wanted = {m: d for m, d in metrics.items() if keep is None or m in keep}
    rows = None
    for name, d in wanted.items():
        part = d.select(F.lit(name).alias("metric"), F.col(stage).cast("string").alias("stage"), F.col("value").cast("double"))
        rows = part if rows is None else rows.union(part)
    return rows.groupBy("metric").pivot("stage", list(stages)).agg(half_even(F.first("value"), 4))
