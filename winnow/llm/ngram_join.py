"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, as connected components.

The shingles of a set are hashed into groups; the numbers per group are the set's point. Two sets that link differ in
at most D shingles, so their points are at most D apart, and with more than D groups at least one group is the same in
both. That gives the distributed part: sets that agree in one whole group come into one block. Groups of several
shingles hardly agree by chance; whatever they connect is one block, in which a set stands once however many groups it
shares. Smaller groups make a block each, for pairs that are in no block together yet.

Inside a block an R-tree over the points bounds the overlap of two boxes by the sum of coordinate minima of their upper
corners; pairs that it leaves are held against the groups' checksums, and what survives is verified on the shingles
themselves. Components need no more than a spanning forest, so pairs that are connected already are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.llm.components import components
from winnow.llm.storage import scratch, without, written
from winnow.llm.textkernel import LOWER, flat, mix, shingles, slices, word_hashes, words

FLUSH = 400_000  # signatures a task holds before it hands them on
CHUNK = 1024  # members of a block that one task compares
LEAF = 32
CELLS = 1_000_000  # pairs times groups that are compared at once
PAIRS = 100_000  # pairs of a block that are handed on at once
SLICE = 500_000  # bytes of texts that are cut into shingles at once
BATCH_ROWS = 500  # rows with whole texts or sets of shingles
WIDENING = 1.8  # ratio of the sizes that share a number of groups
FILTER_BITS = 1 << 23
CHUNK_SHINGLES = 2_000_000
BAND_BITS = 5
MOST_COUNT = 31  # larger counts of a group are taken for this, which never enlarges a difference
STRONG = 4  # shingles of a group that sets do not share by chance

DOC, SIGNED, POINT, LIVE, EDGE = 0, 1, 2, 3, 4
_SPLIT = np.uint64(0x8EBC6AF09C88C6E3)


@dataclass(frozen=True)
class Rule:
    """Link if ``den`` * intersection >= ``num`` * union, on shingles of ``k`` words."""

    k: int
    num: int
    den: int

    def most_apart(self, a, b):
        """Largest symmetric difference of two linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def bands(self) -> list[tuple[int, int, int]]:
        return _bands(self)

    def band_of(self, size: int) -> int:
        lows = [low for low, _, _ in self.bands()]
        return int(np.searchsorted(lows, size, side="right")) - 1

    def spare(self, band: int, sizes: np.ndarray) -> np.ndarray:
        """Groups beyond the first in which sets of these sizes agree with each partner in the band, empty ones included.

        The band's groups are counted for its largest pair; smaller sets differ from their partners in fewer.
        """
        low, groups, _ = self.bands()[band]
        most = _high(low) - 1
        return groups - 1 - self.most_apart(np.minimum(sizes, most), np.where(sizes > most, sizes, sizes * self.den // self.num))

    def bands_for(self, size: int) -> range:
        """Bands in which a set of this size may meet a partner: its own and those of the least smaller partner."""
        return range(self.band_of(-(-size * self.num // self.den)), self.band_of(size) + 1)


def _high(low: int) -> int:
    """Least size of the band after the one from ``low``."""
    return max(low + 1, int(low * WIDENING))


@lru_cache(maxsize=8)
def _bands(rule: Rule) -> list[tuple[int, int, int]]:
    """(least size, groups, spare groups) per band; a band is named by the smaller set of a pair.

    With D the largest difference of a pair there are D + 1 + spare groups. A set with no more empty groups than spare
    ones shares a group that is not empty with each partner, so its empty groups need no signature. The spare ones grow
    with D, as the empty ones do: a signed empty group is a block of all sets that lack it.
    """
    out, low = [], 1
    for _ in range(1 << BAND_BITS):
        high = _high(low)
        apart = rule.most_apart(high - 1, (high - 1) * rule.den // rule.num)
        spare = min(4, 1 + apart // 8) + apart // 16
        out.append((low, apart + 1 + spare if apart else 0, spare))
        low = high
    return out


def sets_of(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    data = LOWER[data]
    start, end, owner = words(data, offsets)
    return shingles(word_hashes(data, start, end), owner, len(column), k)


def keys_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit key per set, the same for equal sets."""
    total = np.zeros(len(bounds) - 1, dtype=np.uint64)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        total[full] = np.add.reduceat(mix(hashes ^ _SPLIT), bounds[:-1][full])
    return mix(total + (bounds[1:] - bounds[:-1]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def spread_ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges start .. start + size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


def grouped(hashes: np.ndarray, bounds: np.ndarray, rows: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and checksums per group (rows x groups) of the chosen sets."""
    sizes = (bounds[1:] - bounds[:-1])[rows]
    own = hashes[spread_ranges(bounds[:-1][rows], sizes)]
    mixed = mix(own + _SPLIT)
    cell = ((mixed >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
    cell += np.repeat(np.arange(len(rows)) * groups, sizes)
    sums = np.zeros(len(rows) * groups, dtype=np.uint64)
    np.add.at(sums, cell, mix(mixed))
    return np.bincount(cell, minlength=len(sums)).reshape(-1, groups), sums.reshape(-1, groups)


def packed_point(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A byte per group: five bits of the count (up to MOST_COUNT) and three of the checksum."""
    return (np.minimum(counts, MOST_COUNT) << 3).astype(np.uint8) | (sums >> np.uint64(61)).astype(np.uint8)


_ROW = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("band", pa.int32()), ("need", pa.int32())]
    + [("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())]
)
_ROW_DDL = "bucket int, kind int, id long, node long, n long, band int, need int, x binary, y binary, z binary"
_OUT = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("band", pa.int32()), ("need", pa.int32()), ("sig", pa.int64()), ("point", pa.binary())])
_OUT_DDL = "kind int, id long, node long, n long, band int, need int, sig long, point binary"


def _rows(schema: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def is_strong(sig: np.ndarray) -> np.ndarray:
    return sig >> BAND_BITS & 1 == 1


def _packed(chosen: np.ndarray, x: np.ndarray, y: np.ndarray, kind: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct pairs (x, y) as rows of bounded size, for any bucket."""
    if not chosen.any():
        return
    pairs = np.unique(np.stack([x[chosen], y[chosen]], axis=1), axis=0)
    for start in range(0, len(pairs), 100_000):
        own = pairs[start : start + 100_000]
        yield _rows(_ROW, 1, bucket=[abs(int(own[0, 1])) % buckets], kind=[kind], x=[own[:, 0].tobytes()], y=[own[:, 1].tobytes()])


def _sign(rule: Rule, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts -> a row per document, a row per set and band (its point), and packed signatures by bucket."""

    def hand_on(signatures: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not signatures:
            return
        sig, node = np.concatenate(signatures), np.concatenate(nodes)
        order = np.argsort(sig, kind="stable")
        sig, node = sig[order], node[order]
        first = np.append(True, sig[1:] != sig[:-1])
        leader = node[first][np.cumsum(first) - 1]
        shared = ~first | np.append(~first[1:], False)
        # of a signature that several sets here have, one entry goes to the bucket, marked; what the others need is known
        yield from _packed(~first & is_strong(sig), leader, node, EDGE, buckets)
        yield from _packed(~first & ~is_strong(sig), sig, node, LIVE, buckets)
        sig, node, shared = sig[first], node[first], shared[first]
        bucket = (sig.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        sig, node, shared = sig[order], node[order], shared[order]
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            own = slice(cuts[b], cuts[b + 1])
            yield _rows(_ROW, 1, bucket=[b], kind=[SIGNED], x=[sig[own].tobytes()], y=[node[own].tobytes()], z=[shared[own].tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures, nodes, held, seen = [], [], 0, set()
        for part in slices(batches, most=SLICE):
            hashes, bounds = sets_of(part.column(1), rule.k)
            size, key = bounds[1:] - bounds[:-1], keys_of(hashes, bounds)
            yield _rows(_ROW, len(size), bucket=np.abs(key) % buckets, kind=np.full(len(size), DOC), id=part.column(0), node=key, n=size)
            fresh = []  # one of equal sets is enough
            for row in np.flatnonzero((size > 0) & np.asarray(part.column(0).is_valid())).tolist():
                if (k := int(key[row])) not in seen:
                    seen.add(k)
                    fresh.append(row)
            of_band: dict[int, list[int]] = {}
            for row in fresh:
                for band in rule.bands_for(int(size[row])):
                    of_band.setdefault(band, []).append(row)
            for band, rows in of_band.items():
                groups = rule.bands()[band][1]
                if not groups:
                    continue  # only equal sets link here
                rows = np.array(rows)
                spare = rule.spare(band, size[rows])
                counts, sums = grouped(hashes, bounds, rows, groups)
                empty = counts == 0
                none = empty.sum(axis=1)
                used = ~empty | (none > spare)[:, None]
                # partners that do not sign the empty groups share but one of these sets' for certain
                need = np.where(none > spare, 1, 1 + spare - none)
                full = mix(sums + mix(np.arange(groups, dtype=np.uint64) + np.uint64(band << 40)))
                strong = (counts >= STRONG).astype(np.uint64) << np.uint64(BAND_BITS)
                sig = (full >> np.uint64(BAND_BITS + 1) << np.uint64(BAND_BITS + 1) | strong | np.uint64(band)).view(np.int64)
                signatures.append(sig[used])
                nodes.append(np.repeat(key[rows], used.sum(axis=1)))
                held += len(signatures[-1])
                yield _rows(
                    _ROW, len(rows), bucket=np.abs(key[rows]) % buckets, kind=np.full(len(rows), POINT), node=key[rows], n=size[rows], band=np.full(len(rows), band), need=need,
                    x=[r.tobytes() for r in packed_point(counts, sums)],
                )
            if held >= FLUSH:
                yield from hand_on(signatures, nodes)
                signatures, nodes, held, seen = [], [], 0, set()
        yield from hand_on(signatures, nodes)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """One bucket: documents and points pass. Sets that share a strong signature are linked to one of them by an edge;
    of the other signatures those stay that two sets have."""
    kind = table["kind"].to_numpy()
    out = []
    for k in (DOC, POINT):
        own = table.filter(pa.array(kind == k))
        out.append(pa.table([own[c].combine_chunks() if c in own.column_names else pa.nulls(len(own), f.type) for c, f in ((_PASSED.get(f.name, f.name), f) for f in _OUT)], schema=_OUT))

    def packed(k: int, column: str, dtype) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x, dtype) for x in table[column].filter(pa.array(kind == k)).to_pylist())])

    sig, node, marked = packed(SIGNED, "x", np.int64), packed(SIGNED, "y", np.int64), packed(SIGNED, "z", bool)
    order = np.lexsort((node, sig))
    sig, node, marked = sig[order], node[order], marked[order]
    edges = [(packed(EDGE, "x", np.int64), packed(EDGE, "y", np.int64))]
    live = [(packed(LIVE, "x", np.int64), packed(LIVE, "y", np.int64))]
    if len(sig):
        start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(start, len(sig)))
        fresh = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
        several = (np.add.reduceat(fresh.astype(np.int64), start) > 1) | np.logical_or.reduceat(marked, start)
        weak = fresh & np.repeat(several, size) & ~is_strong(sig)
        live.append((sig[weak], node[weak]))
        leader = np.repeat(node[start], size)
        linked = is_strong(sig) & (node != leader)
        edges.append(tuple(np.unique(np.stack([leader[linked], node[linked]], axis=1), axis=0).T))
    for k, pairs in ((LIVE, live), (EDGE, edges)):
        for x, y in pairs:
            x, y = np.ascontiguousarray(x), np.ascontiguousarray(y)
            out.append(pa.Table.from_batches([_rows(_OUT, len(x), kind=np.full(len(x), k), sig=x, node=y)]))
    return pa.concat_tables(out)


_PASSED = {"point": "x"}


class Forest:
    """Union-find over the members of one block."""

    def __init__(self, label: np.ndarray):
        _, first, index = np.unique(label, return_index=True, return_inverse=True)
        self.up = first[index].tolist()
        self.trees = len(first)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        self.trees -= 1
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))])


@dataclass
class Block:
    """Members that share one signature, with their points."""

    rule: Rule
    node: np.ndarray
    n: np.ndarray
    counts: np.ndarray
    sums: np.ndarray
    label: np.ndarray  # pairs of one label are connected already
    seen: np.ndarray  # pairs of one number have been compared already; -1: none

    def survivors(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of rows that may link, by the points and then the checksums, and a lower bound of their difference."""
        step = max(1, CELLS // max(1, len(others) * self.counts.shape[1]))
        parts = [self._survivors(rows[k : k + step], others) for k in range(0, len(rows), step)]
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _survivors(self, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        most = self.rule.most_apart(self.n[rows][:, None], self.n[others][None, :])
        off = np.abs(self.counts[rows][:, None, :] - self.counts[others][None, :, :])
        new = (self.label[rows][:, None] != self.label[others][None, :]) & ((self.seen[rows][:, None] != self.seen[others][None, :]) | (self.seen[rows] < 0)[:, None])
        i, j = np.nonzero((off.sum(axis=2, dtype=np.int64) <= most) & new)
        if not len(i):
            return rows[i], others[j], i
        off = off[i, j]
        # an equal number of other shingles makes a difference of at least two; clamped counts may differ by one
        least = np.where(self.counts[rows[i]] < MOST_COUNT, 2, 1)
        apart = np.where(self.sums[rows[i]] != self.sums[others[j]], np.where(off == 0, least, off), 0).sum(axis=1)
        near = apart <= most[i, j]
        return rows[i[near]], others[j[near]], apart[near]

    def tree(self) -> list[tuple[np.ndarray, np.ndarray, int, object]]:
        """R-tree, packed from the top: (rows, upper corner, least size, children) per node; the root is the first."""
        nodes, waiting = [], [(np.arange(len(self.node)), None)]
        while waiting:
            rows, parent = waiting.pop()
            own = self.counts[rows]
            children: list[int] = []
            if parent is not None:
                parent.append(len(nodes))
            nodes.append((rows, own.max(axis=0).astype(np.int64), int(self.n[rows].min()), children))
            if len(rows) > LEAF:
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                order = np.argsort(own[:, widest], kind="stable")
                waiting += [(half, children) for half in np.array_split(rows[order], 2)]
        return nodes

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Surviving pairs, each once, leaf against leaf; boxes that cannot overlap enough are left out."""
        if len(self.node) <= 2 * LEAF:
            i, j, apart = self.survivors(np.arange(len(self.node)), np.arange(len(self.node)))
            yield tuple(x[i < j] for x in (i, j, apart))
            return
        nodes = self.tree()
        rule, waiting = self.rule, [(0, 0)]
        while waiting:
            a, b = waiting.pop()
            (rows, high, least, inner), (others, top, fewest, within) = nodes[a], nodes[b]
            if rule.num * (least + fewest) > (rule.num + rule.den) * int(np.minimum(high, top).sum()) and not (high.max() >= MOST_COUNT and top.max() >= MOST_COUNT):
                continue
            label = self.label[rows[0]]
            if (self.label[rows] == label).all() and (self.label[others] == label).all():
                continue
            if a == b:
                if inner:
                    waiting += [(inner[0], inner[0]), (inner[1], inner[1]), (inner[0], inner[1])]
                    continue
                i, j, apart = self.survivors(rows, rows)
                yield tuple(x[i < j] for x in (i, j, apart))
            elif inner and (not within or len(rows) >= len(others)):
                waiting += [(child, b) for child in inner]
            elif within:
                waiting += [(a, child) for child in within]
            else:
                yield self.survivors(rows, others)

    def left(self) -> tuple[np.ndarray, np.ndarray]:
        """All surviving pairs, best ones first."""
        found = list(self.pairs())
        i, j, apart = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64),) * 3
        order = np.argsort(apart * 1000 // np.maximum(self.n[i] + self.n[j], 1), kind="stable")
        return i[order], j[order]

    def forest(self, links: Callable[[int, int], bool] = lambda i, j: True) -> list[tuple[int, int]]:
        """A forest of the surviving pairs that ``links`` accepts; it joins whatever any accepted pair can join."""
        i, j = self.left()
        forest, edges = Forest(self.label), []
        while len(i) and forest.trees > 1:
            for a, b in zip(i[:4096].tolist(), j[:4096].tolist(), strict=True):
                if forest.root(a) != forest.root(b) and links(a, b):
                    forest.join(a, b)
                    edges.append((int(self.node[a]), int(self.node[b])))
            i, j = i[4096:], j[4096:]
            root = forest.roots()
            open_still = root[i] != root[j]
            i, j = i[open_still], j[open_still]
        return edges


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _blocks(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[list[pa.RecordBatch]]:
    """Rows sorted by ``by``, in pieces that do not cut between rows of one block."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch[c].to_numpy() for c in by]
        change = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        if rest and any(rest[-1][c][-1].as_py() != k[0] for c, k in zip(by, keys, strict=True)):
            yield rest
            rest = []
        if len(change):
            yield [*rest, batch.slice(0, int(change[-1]))]
            rest = [batch.slice(int(change[-1]))]
        else:
            rest.append(batch)
    if rest:
        yield rest


def _cuts(table: pa.Table, by: tuple[str, ...]) -> list[tuple[int, int]]:
    keys = [table[c].to_numpy() for c in by]
    change = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
    cuts = [0, *change.tolist(), len(table)]
    return list(zip(cuts, cuts[1:], strict=False))


def _edges(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=_PAIR)


def _link(rule: Rule, by: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of (node, label, seen, items) -> verified links that connect what links inside each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _blocks(batches, by):
            table = pa.Table.from_batches(pieces)
            found: list[tuple[int, int]] = []
            for a, b in _cuts(table, by):
                node, first = np.unique(table["node"].slice(a, b - a).to_numpy(), return_index=True)
                label, seen = (table[c].slice(a, b - a).to_numpy()[first] for c in ("label", "seen"))
                if len(node) < 2 or (label == label[0]).all():
                    continue
                items = table["items"].slice(a, b - a).take(pa.array(first)).to_pylist()
                sets = [np.frombuffer(x, dtype=np.uint64) for x in items]
                n = np.array([len(x) for x in sets], dtype=np.int64)
                # any number of groups will do here; few shingles a group keep the bounds sharp
                groups = max(4, int(np.median(n)) // 5)
                counts, sums = grouped(np.concatenate(sets), np.concatenate([[0], np.cumsum(n)]), np.arange(len(n)), groups)
                block = Block(rule, node, n, np.minimum(counts, MOST_COUNT).astype(np.int16), (sums >> np.uint64(48)).astype(np.uint16), label, seen)

                def links(i: int, j: int, sets=sets) -> bool:
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    return rule.den * common >= rule.num * (len(sets[i]) + len(sets[j]) - common)

                found += block.forest(links)
            yield from _edges(found)

    return run


def _compare(rule: Rule, everything: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of points -> pairs to be verified: a forest of each block, or everything that is left."""
    by = ("sig", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _blocks(batches, by):
            table = pa.Table.from_batches(pieces)
            node, n, label, seen = (table[c].to_numpy() for c in ("node", "n", "label", "seen"))
            points = table["point"].to_pylist()
            found: list[tuple[int, int]] = []
            for a, b in _cuts(table, by):
                if b - a < 2 or (label[a:b] == label[a]).all():
                    continue
                point = np.frombuffer(b"".join(points[a:b]), dtype=np.uint8).reshape(b - a, -1)
                block = Block(rule, node[a:b], n[a:b], (point >> 3).astype(np.int16), point & 7, label[a:b], seen[a:b])
                if everything:
                    i, j = block.left()
                    for start in range(0, len(i), PAIRS):
                        yield pa.RecordBatch.from_arrays([pa.array(block.node[x[start : start + PAIRS]]) for x in (i, j)], schema=_PAIR)
                else:
                    found += block.forest()
            yield from _edges(found)

    return run


def _pair_cells(own: Column, chunks: Column) -> Column:
    """Cells in which the members of a chunk meet those of every chunk."""
    return F.transform(F.sequence(F.lit(0), chunks - 1), lambda other: F.least(own, other) * chunks + F.greatest(own, other))


def _first_cells(members: DataFrame, block: str) -> DataFrame:
    """Members (block, node) with a cell: a block is cut into chunks of bounded size, each with its least member."""
    size = members.groupBy(block).agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("node", block), chunks).cast("int")
    cells = F.when(F.col("node") == F.col("low"), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(own))
    return members.join(size, block).withColumn("cell", F.explode(cells)).drop("size", "low")


def _last_cells(members: DataFrame, block: str) -> DataFrame:
    """Members (block, node, label, seen) with cells in which all of different labels meet, each pair of them once.

    Members of a large block that have its most common label are connected: they meet the rest only, chunk by chunk, and
    the rest meets itself. Nothing is sent twice for pairs that are connected already.
    """
    major = members.groupBy(block, "label").agg(F.count(F.lit(1)).alias("n_label"))
    major = major.groupBy(block).agg(F.max_by("label", F.struct("n_label", "label")).alias("major"), F.max("n_label").alias("n_major"), F.sum("n_label").alias("size"))
    major = major.withColumn("c", F.ceil(F.col("n_major") / CHUNK).cast("int")).withColumn("r", F.ceil((F.col("size") - F.col("n_major")) / CHUNK).cast("int"))
    own = lambda of: F.pmod(F.xxhash64("node", block), F.greatest(F.lit(1), F.col(of))).cast("int")
    c, r = F.col("c"), F.col("r")
    entry = lambda cell, seen: F.struct(cell.cast("int").alias("cell"), seen.cast("long").alias("seen"))
    whole = F.array(entry(F.lit(0), F.col("seen")))
    connected = F.transform(F.sequence(F.lit(0), r - 1), lambda x: entry(own("c") * r + x, F.lit(0)))
    others = F.concat(
        F.transform(F.sequence(F.lit(0), c - 1), lambda x: entry(x * r + own("r"), F.lit(1))),
        F.transform(_pair_cells(own("r"), r), lambda x: entry(c * r + x, F.col("seen"))),
    )
    cells = F.when(F.col("size") <= CHUNK, whole).when(r < 1, F.array().cast("array<struct<cell:int,seen:bigint>>")).when(F.col("label") == F.col("major"), connected).otherwise(others)
    out = members.join(major, block).withColumn("met", F.explode(cells))
    return out.withColumn("cell", F.col("met.cell")).withColumn("seen", F.col("met.seen")).drop("met", "major", "n_major", "size", "c", "r")


def _apart(members: DataFrame, block: str) -> DataFrame:
    """Blocks whose members are not all connected yet."""
    return members.groupBy(block).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select(block)


def _super_links(docs: DataFrame, own: DataFrame, supers: DataFrame, rule: Rule) -> DataFrame:
    """Verified links inside the blocks of strong signatures (node, label: the block).

    A large block is cut into chunks of bounded size, each with the block's first member; what is still apart then meets.
    """
    size = supers.groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    chunks = F.greatest(F.ceil(F.col("size") / CHUNK), F.ceil(F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    sized = supers.join(size.select("label", chunks.alias("chunks")), "label")
    sized = sized.select("node", F.col("label").alias("super"), "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("own"))
    sized = written(sized, "supers")
    sets = _sets(docs, own, sized, rule.k)

    def compared(rows: DataFrame) -> DataFrame:
        by = ("super", "cell")
        rows = sets.join(rows, "node").select(*by, "node", "label", "seen", "items").repartition(*by).sortWithinPartitions(*by)
        return written(rows.mapInArrow(_link(rule, by), "a long, b long"), "links", batch_rows=BATCH_ROWS)

    first = F.when(F.col("node") == F.col("super"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))
    links = compared(sized.select("node", "super", F.col("node").alias("label"), F.lit(-1).cast("long").alias("seen"), F.explode(first).alias("cell")))
    large = sized.where("chunks > 1")
    if large.isEmpty():
        return links
    large = large.join(components(links), "node", "left").select("node", "super", F.coalesce("label", "node").alias("label"), F.lit(-1).cast("long").alias("seen"))
    large = written(large.join(_apart(large, "super"), "super"), "apart")
    return links.unionByName(compared(_last_cells(large, "super")))


def _weak_members(live: DataFrame, needs: DataFrame) -> DataFrame:
    """sig, node, seen, band of the sets that can have a partner in the blocks of weak signatures.

    Two sets that link without a strong signature in common share at least as many weak ones as either needs, so a set
    that has fewer in blocks of different sets has no partner there. What goes makes other blocks smaller. Of the shared
    ones the one in the smallest block has need - 1 others after it in both sets, if each orders its own by the size of
    their blocks; so a set leaves its need - 1 largest blocks.
    """
    for _ in range(2):
        mixed = live.groupBy("sig").agg(F.min("seen").alias("x"), F.max("seen").alias("y")).where("x <> y").select("sig")
        live = written(live.join(mixed, "sig", "left_semi"), "live")
        enough = live.groupBy("node", "band").agg(F.count(F.lit(1)).alias("held")).join(needs, ["node", "band"]).where("held >= need")
        live = written(live.join(enough.select("node", "band"), ["node", "band"], "left_semi"), "live")
    sized = live.join(live.groupBy("sig").agg(F.count(F.lit(1)).alias("size")), "sig").join(needs, ["node", "band"])
    own = Window.partitionBy("node", "band")
    place = F.row_number().over(own.orderBy(F.desc("size"), F.desc("sig")))
    return written(sized.withColumn("place", place).where("place >= need").select(*live.columns), "live")


def _compared(members: DataFrame, points: DataFrame, rule: Rule, everything: bool) -> DataFrame:
    """Pairs (a < b) to verify from members with cells: a forest of each cell, or all that is left in it."""
    rows = members.join(points, ["node", "band"]).select("sig", F.col("cell").cast("int").alias("cell"), "node", "n", "label", "seen", "point")
    rows = rows.repartition("sig", "cell").sortWithinPartitions("sig", "cell", "node")
    pairs = rows.mapInArrow(_compare(rule, everything), "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _weak_links(docs: DataFrame, own: DataFrame, members: DataFrame, points: DataFrame, rule: Rule, links: DataFrame) -> DataFrame:
    """Verified links that connect what links in the blocks of weak signatures, given the links found before.

    First each set looks only into its largest block, which connects most copies by a pair a set. Then come forests of
    all blocks that are still apart, cut ones in chunks with one member in common, and last, in blocks that hold a pair
    that failed or were cut, all that is left.
    """
    found: list[DataFrame] = []
    failed: list[DataFrame] = []

    def verify(pairs: DataFrame) -> None:
        if failed:
            pairs = pairs.join(reduce(DataFrame.unionByName, failed), ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            return
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        sets = _sets(docs, own, ends, rule.k).dropDuplicates(["node"])
        checked = written(_verified(pairs, sets, rule), "checked", batch_rows=BATCH_ROWS)
        found.append(checked.where("links").select("a", "b"))
        failed.append(checked.where("not links").select("a", "b"))

    def labelled(rows: DataFrame) -> DataFrame:
        labels = components(reduce(DataFrame.unionByName, found, links))
        rows = written(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
        return written(rows.join(_apart(rows, "sig"), "sig"), "apart")

    largest = members.groupBy("node").agg(F.max(F.struct("size", "sig"))["sig"].alias("sig"))
    first = labelled(members).join(largest, ["node", "sig"]).drop("size")
    verify(_compared(_first_cells(first, "sig"), points, rule, False))
    verify(_compared(_first_cells(labelled(members.drop("size")), "sig"), points, rule, False))
    again = members.where(F.col("size") > CHUNK).select("sig")
    if failed:
        pairs = reduce(DataFrame.unionByName, failed)
        ends = [members.select("sig", F.col("node").alias(c)) for c in "ab"]
        again = again.unionByName(pairs.join(ends[0], "a").join(ends[1], ["sig", "b"]).select("sig"))
    rest = labelled(members.drop("size").join(again.distinct(), "sig"))
    verify(_compared(_last_cells(rest, "sig"), points, rule, True))
    return reduce(DataFrame.unionByName, found, links)


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size, eight nodes a byte, in which every node is marked; other nodes may be, too."""
    bit = F.pmod(F.col("node"), F.lit(FILTER_BITS))
    found = nodes.groupBy((bit / 64).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(node, {FILTER_BITS}) % 64 as int))")).alias("bits"))
    table = found.toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint8)


def _marked(bitmap: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = nodes % (8 * len(bitmap))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _sets(docs: DataFrame, own: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """node, items (its sorted shingle hashes) of the nodes and of some others; a node may come more than once, always
    the same. Of each node only the text with its least id is cut into shingles again (``own``: id, node)."""
    schema = pa.schema([("node", pa.int64()), ("items", pa.binary())])
    least = own.where(F.col("id").isNotNull()).join(nodes.select("node").distinct(), "node").groupBy("node").agg(F.min("id").alias("id"))
    bitmap = _node_filter(least.select(F.col("id").alias("node")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = _marked(bitmap, batch.column(0).to_numpy())
            if held.any():
                yield batch.filter(pa.array(held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(chosen(batches), most=SLICE):
            hashes, bounds = sets_of(part.column(1), k)
            key = keys_of(hashes, bounds)
            rows = [r for r in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist() if int(key[r]) not in seen]
            if len(seen) > 200_000:
                seen.clear()
            first = {int(key[r]): r for r in reversed(rows)}
            seen.update(first)
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int64()), pa.array([hashes[bounds[r] : bounds[r + 1]].tobytes() for r in first.values()], pa.binary())], schema=schema)

    return docs.select("id", "text").mapInArrow(run, "node long, items binary")


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """a, b, links: each pair held against the shingles. The sets of many partners of one node come to it in portions."""
    portions = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("portions"))
    to = pairs.join(portions, "a").select("a", F.col("b").alias("node"), F.pmod(F.xxhash64("b"), "portions").cast("int").alias("portion"), F.lit(1).alias("side"))
    hubs = portions.select("a", F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), F.lit(0).alias("side"))
    rows = to.unionByName(hubs).join(sets, "node").repartition("a", "portion").sortWithinPartitions("a", "portion", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = own = None
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            for a, node, side, items in zip(*(batch[c].to_pylist() for c in ("a", "node", "side", "items")), strict=True):
                held = np.frombuffer(items, dtype=np.uint64)
                if side == 0:
                    hub, own = a, held
                    continue
                if hub != a:
                    raise ValueError(f"the set of {a} is missing")
                common = len(np.intersect1d(own, held, assume_unique=True))
                out.append((a, node, rule.den * common >= rule.num * (len(own) + len(held) - common)))
            if out:
                a, b, links = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.bool_())], names=["a", "b", "links"])

    return rows.select("a", "node", "side", "items").mapInArrow(run, "a long, b long, links boolean")


def linked_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, the least id that links reach from it.

    Texts in lower case (A-Z) are cut into words at white space; a text of fewer than ``k`` words has its whole
    sequence as its only shingle. Two documents link when den * intersection >= num * union of their sets. Null, empty
    and blank texts have no shingles and are their own component; rows without an id take no part and get a null
    component. Repeated ids are rows like others. Other columns are not looked at. Empty tables give empty results.
    """
    with scratch(docs.sparkSession):
        return written(_components(docs, Rule(k, num, den), id_col, text_col), "components", lasting=True)


def _components(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = docs.mapInArrow(_sign(rule, buckets), _ROW_DDL).groupBy("bucket").applyInArrow(_meet, _OUT_DDL)
    met = written(met, "signatures", by="kind", batch_rows=BATCH_ROWS)
    own = met.where(F.col("kind") == DOC).select("id", "node", "n")
    docs = docs.where(F.col("id").isNotNull())

    edges = met.where(F.col("kind") == EDGE).select(F.col("sig").alias("a"), F.col("node").alias("b"))
    supers = components(edges)
    sizes = own.select("node", "n").distinct()
    supers = written(supers.join(sizes, "node"), "supers")
    links = _super_links(docs, own, supers, rule)

    # weak signatures: blocks with members that no strong one has brought together; those of the same sets are one block
    live = met.where(F.col("kind") == LIVE).select("sig", "node").dropDuplicates(["sig", "node"]).withColumn("band", F.expr(f"cast(sig & {(1 << BAND_BITS) - 1} as int)"))
    live = live.join(supers.select("node", F.col("label").alias("super")), "node", "left").withColumn("seen", F.coalesce("super", "node")).drop("super")
    points = met.where(F.col("kind") == POINT)
    live = _weak_members(live, points.select("node", "band", "need").distinct())
    mark = (F.sum(F.pmod(F.xxhash64("node", F.lit(i)), F.lit(1 << 31))).alias(f"mark{i}") for i in (0, 1))
    blocks = live.groupBy("sig", "band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), *mark, F.min("seen").alias("x"), F.max("seen").alias("y"))
    blocks = blocks.where("x <> y").groupBy("size", "low", "mark0", "mark1", "band").agg(F.min("sig").alias("sig"))
    members = written(live.join(blocks.select("sig", "size"), "sig"), "members")
    points = points.select("node", "band", "n", "point").join(members.select("node", "band").distinct(), ["node", "band"], "left_semi")
    points = written(points.dropDuplicates(["node", "band"]), "points")
    links = _weak_links(docs, own, members, points, rule, links)
    labels = components(links)

    own = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    linked = F.col("n") > 0
    least = own.where(linked & F.col("id").isNotNull()).groupBy("label").agg(F.min("id").alias("least"))
    joined = own.join(least, "label", "left")
    component: Column = F.when(F.col("id").isNotNull(), F.when(linked, F.col("least")).otherwise(F.col("id")))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row whose id is its name, and all rows without an id.

    If an id occurs more than once, its rows are told apart: each is linked by its own text, and of those that share
    a component's least id one stays, by the digest of the text.
    """
    if not docs.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").isEmpty():
        return _keep_one_row(docs, k, num, den, id_col, text_col)
    found = linked_components(docs, k, num, den, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    return without(docs, gone, {"_gone": docs[id_col]}, "_gone")


def _keep_one_row(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """``keep_one`` on rows that are numbered once, as the names of components do not tell rows of one id apart."""
    rows = written(docs.withColumn("_row", F.when(F.col(id_col).isNotNull(), F.monotonically_increasing_id())), "numbered", batch_rows=BATCH_ROWS)
    found = linked_components(rows, k, num, den, "_row", text_col).where(F.col("_row").isNotNull()).select("_row", "component_id")
    keys = rows.select("_row", F.struct(F.col(id_col), F.md5(F.coalesce(F.col(text_col), F.lit(""))), F.col("_row").alias("row")).alias("key"))
    stays = found.join(keys, "_row").groupBy("component_id").agg(F.min("key")["row"].alias("_row")).select("_row")
    kept = rows.where(F.col("_row").isNotNull()).join(stays, "_row", "left_semi")
    return kept.unionByName(rows.where(F.col("_row").isNull())).drop("_row")
