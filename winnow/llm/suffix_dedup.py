"""Removal of repeated byte strings with suffix arrays of bounded size.

A window is a string of ``length`` bytes. Every window is dealt to a bucket by the least hash among its 16-byte grams, so
all occurrences of a string meet in one bucket, and windows side by side mostly share it: a run of them travels as one
piece of text. Four steps over blocks of documents, which are shuffled once:

1. each block tells every bucket which keys (least hashes) it has; a bucket answers which are in several documents;
2. blocks send the pieces of these keys only, equal pieces of a block once, with their smallest document;
3. a bucket sorts the rotations of its pieces, takes the Burrows-Wheeler transform and extends intervals backward, breadth
   first: level by level this finds where neighbours in the order share 0, 1, 2, ... bytes, and it stops at ``length``;
   what has no boundary by then shares a whole window, and the smallest document of each such interval decides;
4. blocks read the verdicts, a bit per window, and cut the covered bytes out.

A key of very many documents is dealt window by window instead, by the window's own hash, and equal windows of a block
travel once. So no group holds more than a row per block and string, however common a passage is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 8 << 20
HOT_DOCS = 100_000
STEP = 1 << 17
MOST_WINDOWS = 64
PARTS = 16
NO_ID = np.iinfo(np.int64).max
UNSET = np.iinfo(np.uint16).max

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407)]
BYTE_HASH = np.random.default_rng(13).integers(0, 2**64, 256, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD[1]
    h = (h ^ (h >> np.uint64(29))) * ODD[2]
    return h ^ (h >> np.uint64(32))


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash per gram of ``gram`` bytes (a power of two), by doubling."""
    h, size = BYTE_HASH[text], 1
    while size < gram:
        h = (h[:-size] * ODD[size.bit_length() % len(ODD)]) ^ (h[size:] + (h[:-size] >> np.uint64(37)))
        size *= 2
    return mixed(h)


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least value of each ``width`` neighbours."""
    size, n = 1, h.size - width + 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:n], h[width - size : width - size + n])


def gram_of(length: int) -> int:
    return 1 << max(0, (length // 3).bit_length() - 1)


def runs(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same key, within one document each: first window, number of windows (64 at most), key."""
    gram, found = gram_of(length), []
    for lo in range(0, text.size - length + 1, STEP):
        hi = min(lo + STEP, text.size - length + 1)
        least = least_of(gram_hashes(text[lo : hi + length - 1], gram), length - gram + 1)
        near = ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, hi - 1, "right") + 1]
        end = np.repeat(near, np.diff(np.clip(np.concatenate([[lo], near]), lo, hi)))
        valid = end - np.arange(lo, hi) >= length
        edge = np.ones(hi - lo, bool)
        edge[1:] = (valid[1:] != valid[:-1]) | (least[1:] != least[:-1])
        first = np.flatnonzero(edge)
        count = np.diff(np.append(first, hi - lo))
        inside = valid[first]
        found.append((first[inside] + lo, count[inside], least[first[inside]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at, count, key = (np.concatenate(x) for x in zip(*found, strict=True))
    if count.max(initial=0) > MOST_WINDOWS:
        times = -(-count // MOST_WINDOWS)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at, count, key = np.repeat(at, times) + nth * MOST_WINDOWS, np.minimum(np.repeat(count, times) - nth * MOST_WINDOWS, MOST_WINDOWS), np.repeat(key, times)
    return at, count, mixed(key) >> np.uint64(16)  # 48 bits


@dataclass
class Block:
    """Documents of a block in an order that doesn't depend on how they arrive."""

    ids: np.ndarray
    own: list[int | None]
    text: np.ndarray
    ends: np.ndarray
    at: np.ndarray
    count: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    buckets: int

    @staticmethod
    def of(docs: pa.Table, length: int, buckets: int) -> Block:
        rows = sorted(zip((NO_ID if i is None else i for i in docs["id"].to_pylist()), docs["text"].to_pylist(), docs["id"].to_pylist(), strict=True), key=lambda r: r[:2])
        ends = np.cumsum([len(t) for _, t, _ in rows], dtype=np.int64)
        text = np.frombuffer(b"".join(t for _, t, _ in rows), np.uint8)
        at, count, key = runs(text, ends, length)
        return Block(np.array([i for i, _, _ in rows], np.int64), [o for _, _, o in rows], text, ends, at, count, key, np.searchsorted(ends, at, "right"), buckets)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys by bucket, the number of documents with each (255 at most), and where each run's key stands."""
        key, first, where = np.unique(self.key, return_index=True, return_inverse=True)
        pairs = np.unique(where * np.int64(self.ids.size + 1) + self.doc) // (self.ids.size + 1)
        n = np.bincount(pairs, minlength=key.size)
        order = np.argsort(bucket_of(key, self.buckets), kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(order.size)
        return key[order], np.minimum(n[order], 255).astype(np.uint8), back[where]


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key % np.uint64(buckets)).astype(np.int64)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of equal values of a sorted array."""
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), bucket.size) if bucket.size else []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[lo]), slice(lo, hi)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, bytes of equal weight together, compressed."""
    raw = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(a.size, -1).T).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def array_of(raw: bytes, at: int, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()


SENT = "bucket int, block int, kind int, n int, packed binary"
NAMES = ["bucket", "block", "kind", "n", "packed"]
KEYS, FLAGS, PIECES, MASKS = range(4)


def sent(rows: list[tuple]) -> pa.Table:
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("packed", pa.binary())])
    return pa.Table.from_pydict(dict(zip(NAMES, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in NAMES}, schema=schema)


def send_keys(block: int, b: Block) -> pa.Table:
    key, n, _ = b.keys()
    low = key.view(np.uint8).reshape(-1, 8)[:, :6]
    return sent([(bucket, block, KEYS, s.stop - s.start, np.ascontiguousarray(low[s]).tobytes() + n[s].tobytes()) for bucket, s in by_bucket(bucket_of(key, b.buckets))])


def judge_keys(rows: pa.Table, hot_docs: int) -> pa.Table:
    """0 for a key of one document, 1 for several, 2 for very many."""
    sizes, packed = rows["n"].to_pylist(), rows["packed"].to_pylist()
    keys = np.zeros((sum(sizes), 8), np.uint8)
    keys[:, :6] = np.concatenate([np.frombuffer(p, np.uint8, n * 6).reshape(n, 6) for n, p in zip(sizes, packed, strict=True)])
    counts = np.concatenate([np.frombuffer(p, np.uint8, n, n * 6) for n, p in zip(sizes, packed, strict=True)])
    _, where = np.unique(keys.view(np.uint64).ravel(), return_inverse=True)
    docs = np.bincount(where, weights=counts)[where]
    flags = np.split((docs > 1).astype(np.uint8) + (docs > hot_docs), np.cumsum(sizes)[:-1])
    return sent([(bucket, block, FLAGS, n, pack(f)) for bucket, block, n, f in zip(rows["bucket"].to_pylist(), rows["block"].to_pylist(), sizes, flags, strict=True)])


@dataclass
class Items:
    """What a block asks about: runs of shared keys (single windows of hot ones), and the distinct pieces among them."""

    at: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    piece: np.ndarray  # of each item, its place among the pieces
    owner: np.ndarray  # of each piece, its smallest document
    first: np.ndarray  # of each piece, an item with its text
    bucket: np.ndarray  # of each piece, in rising order
    part: np.ndarray


def items(b: Block, answers: pa.Table, length: int) -> Items:
    _, _, where = b.keys()
    flag_rows = sorted((r for r in answers.to_pylist() if r["kind"] == FLAGS), key=lambda r: r["bucket"])
    flags = np.concatenate([np.frombuffer(unpack(r["packed"]), np.uint8) for r in flag_rows]) if flag_rows else np.zeros(0, np.uint8)
    flag = flags[where] if where.size else np.zeros(0, np.uint8)
    times = np.where(flag == 2, b.count, flag)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    single = np.repeat(flag == 2, times)
    at, doc, key = np.repeat(b.at, times) + nth, np.repeat(b.doc, times), np.repeat(b.key, times)
    count = np.where(single, 1, np.repeat(b.count, times))
    raw, seen, piece, first, deal = b.text.tobytes(), {}, [], [], []
    stops = (at + count + length - 1).tolist()
    for i, (lo, hi, k, alone) in enumerate(zip(at.tolist(), stops, key.tolist(), single.tolist(), strict=True)):
        text = raw[lo:hi]
        p = seen.setdefault(text, len(seen))
        piece.append(p)
        if p == len(first):
            first.append(i)
            deal.append(zlib.crc32(text) * 0x9E3779B1 % (1 << 48) if alone else k)
    piece, first, deal = np.array(piece, np.int64), np.array(first, np.int64), np.array(deal, np.uint64)
    bucket, part = bucket_of(deal, b.buckets), ((deal // np.uint64(b.buckets)) % np.uint64(PARTS)).astype(np.uint8)
    order = np.lexsort((part, bucket))
    back = np.empty_like(order)
    back[order] = np.arange(order.size)
    first = first[order]
    return Items(at, count, doc, back[piece] if piece.size else piece, doc[first], first, bucket[order], part[order])


def send_pieces(block: int, b: Block, length: int, answers: pa.Table) -> pa.Table:
    it, rows = items(b, answers, length), []
    raw, lo = b.text.tobytes(), it.at[it.first]
    hi = lo + it.count[it.first] + length - 1
    for bucket, s in by_bucket(it.bucket):
        owners, owner = np.unique(b.ids[it.owner[s]], return_inverse=True)
        text = np.frombuffer(b"".join([raw[x:y] for x, y in zip(lo[s].tolist(), hi[s].tolist(), strict=True)]), np.uint8)
        n = s.stop - s.start
        packed = pack(np.array([owners.size], np.int64), owners, owner.astype(np.uint32), it.count[it.first[s]].astype(np.uint8), it.part[s], text)
        rows.append((bucket, block, PIECES, n, packed))
    return sent(rows)


def rotations(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text ordered by the ``depth`` bytes (or more) that follow, read around the end.

    Eight bytes first, then twice as many in each turn, by the ranks of what follows; only ties are sorted again.
    """
    n, size = text.size, 8
    around = np.resize(text, n + size)
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = (key << np.uint64(8)) | around[k : k + n]
    order, at = np.argsort(key), np.arange(n)  # at: the places in the order that are sorted in this turn
    rank, key = np.empty(n, np.int64), key[order]
    while True:
        new = np.append(True, key[1:] != key[:-1])
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(at.size), 0))]
        tied = ~new | ~np.append(new[1:], True)
        at = at[tied]
        if size >= depth or not at.size:
            return order
        mine = order[at]
        key = rank[mine] * n + rank[(mine + size) % n]
        turn = np.argsort(key)
        order[at], key = mine[turn], key[turn]
        size *= 2


def common_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in rotation order, and for each the bytes it shares with the place before it; UNSET for ``least`` or more.

    Breadth-first backward extension on the Burrows-Wheeler transform: the intervals of all strings of one length that
    still end at an unknown boundary are extended to the left by each byte before them, which gives intervals of the
    next length; where such an interval ends at a boundary not yet set, the two neighbours share just that many bytes.
    """
    n = text.size
    order = rotations(text, least)
    before = text[order - 1]  # the transform; place 0 reads around the end
    to = np.empty(n, np.int32)
    to[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)  # where a place stands after one step to the left
    starts_byte = np.zeros(n + 1, bool)
    starts_byte[np.cumsum(np.bincount(before, minlength=256))] = True
    starts_byte[0] = True
    shared = np.full(n + 1, UNSET, np.uint16)
    shared[0] = shared[n] = 0
    owner = np.full(n + 2, -1, np.int32)  # of a place, the last interval that was extended to it
    lo, hi, named = np.array([0], np.int32), np.array([n], np.int32), 0
    for level in range(least):
        sizes = hi - lo
        who = np.repeat(np.arange(named, named + lo.size, dtype=np.int32), sizes)
        places = np.arange(who.size, dtype=np.int32) + np.repeat(lo - (np.cumsum(sizes, dtype=np.int32) - sizes), sizes)
        named += lo.size
        reached = to[places]
        owner[reached] = who
        last = (owner[reached + 1] != who) | starts_byte[reached + 1]
        first = (owner[reached - 1] != who) | starts_byte[reached]
        hi, lo = np.sort(reached[last]) + 1, np.sort(reached[first])
        fresh = shared[hi] == UNSET
        lo, hi = lo[fresh], hi[fresh]
        if not lo.size:
            break
        shared[hi] = level
    return order, shared[:n]


def smaller_owners(pieces: list[bytes], owner: np.ndarray, length: int) -> np.ndarray:
    """Per piece a bit for each window that also stands in a piece of a smaller owner."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"".join(pieces), np.uint8)
    start = np.cumsum(sizes) - sizes
    order, shared = common_prefixes(text, length)
    of = np.repeat(np.arange(sizes.size), sizes)
    place = np.arange(text.size) - start[of]
    whole = place + length <= sizes[of]  # windows within one piece
    owners = np.where(whole, owner[of], NO_ID)[order]
    cuts = np.flatnonzero(shared != UNSET)
    least = np.empty(text.size, np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owners, cuts), np.diff(np.append(cuts, text.size)))
    bits = (whole & (least < owner[of])).astype(np.uint64) << np.where(whole, place, 0).astype(np.uint64)
    return np.bitwise_or.reduceat(bits, start)


def judge_pieces(rows: pa.Table, length: int) -> pa.Table:
    """For each piece a bit per window: whether a smaller document has it. Parts of the bucket are taken one by one."""
    sizes, owner, counts, part, text, where = rows["n"].to_pylist(), [], [], [], [], []
    for r, (n, packed) in enumerate(zip(sizes, rows["packed"], strict=True)):
        raw = unpack(packed.as_py())
        k = int(array_of(raw, 0, 1, np.int64)[0])
        owners = array_of(raw, 8, k, np.int64)
        owner.append(owners[array_of(raw, 8 + 8 * k, n, np.uint32)])
        counts.append(array_of(raw, 8 + 8 * k + 4 * n, n, np.uint8).astype(np.int64))
        part.append(array_of(raw, 8 + 8 * k + 5 * n, n, np.uint8))
        text.append(raw[8 + 8 * k + 6 * n :])
    begins = [np.cumsum(c + length - 1) - (c + length - 1) for c in counts]
    source = np.repeat(np.arange(len(sizes)), sizes)
    owner, counts, part, begin = (np.concatenate(x) for x in (owner, counts, part, begins))
    masks = np.zeros(owner.size, np.uint64)
    by_part = np.argsort(part, kind="stable")
    for _, s in by_bucket(part[by_part]):
        mine = by_part[s]
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(text[r][x : x + c + length - 1], len(seen)) for r, x, c in zip(source[mine].tolist(), begin[mine].tolist(), counts[mine].tolist(), strict=True)])
        smallest = np.full(len(seen), NO_ID)
        np.minimum.at(smallest, which, owner[mine])
        bits = smaller_owners(list(seen), smallest, length)
        full = np.uint64(2**64 - 1) >> (64 - counts[mine]).astype(np.uint64)
        masks[mine] = np.where(owner[mine] > smallest[which], full, bits[which])
    found = np.split(masks, np.cumsum(sizes)[:-1])
    return sent([(bucket, block, MASKS, n, pack(m)) for bucket, block, n, m in zip(rows["bucket"].to_pylist(), rows["block"].to_pylist(), sizes, found, strict=True)])


def cut_out(b: Block, length: int, answers: pa.Table) -> pa.Table:
    it = items(b, answers, length)
    mask_rows = sorted((r for r in answers.to_pylist() if r["kind"] == MASKS), key=lambda r: r["bucket"])
    masks = np.concatenate([array_of(unpack(r["packed"]), 0, r["n"], np.uint64) for r in mask_rows]) if mask_rows else np.zeros(0, np.uint64)
    full = np.uint64(2**64 - 1) >> (64 - it.count).astype(np.uint64)
    mask = np.where(b.ids[it.doc] > b.ids[it.owner[it.piece]], full, masks[it.piece]) if it.piece.size else full
    depth = np.zeros(b.text.size + 1, np.int32)
    whole = mask == full
    np.add.at(depth, it.at[whole], 1)
    np.add.at(depth, it.at[whole] + it.count[whole] + length - 1, -1)
    some = ~whole & (mask != 0)
    for bit in range(int(it.count[some].max(initial=0))):
        begin = it.at[some][(mask[some] >> np.uint64(bit)) & np.uint64(1) == 1] + bit
        np.add.at(depth, begin, 1)
        np.add.at(depth, begin + length, -1)
    gone = np.cumsum(depth, dtype=np.int32)[:-1] > 0
    starts = np.append(0, b.ends[:-1])
    edge = np.append(gone[:1], gone[1:] & ~gone[:-1])
    edge[starts[(starts < b.ends)]] |= gone[starts[starts < b.ends]]
    stop = np.append(gone[:-1] & ~gone[1:], gone[-1:])
    stop[b.ends[starts < b.ends] - 1] |= gone[b.ends[starts < b.ends] - 1]
    lo, hi = np.flatnonzero(edge), np.flatnonzero(stop) + 1
    doc = np.searchsorted(b.ends, lo, "right")
    offsets = np.append(0, np.cumsum(np.bincount(doc, minlength=b.ids.size))).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(lo - starts[doc]), pa.array(hi - starts[doc])], names=["start", "end"]))
    kept = [b.text[x:y][~gone[x:y]].tobytes() for x, y in zip(starts.tolist(), b.ends.tolist(), strict=True)]
    return pa.Table.from_arrays([pa.array(b.own, pa.int64()), pa.array(b.ends - starts), spans, pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"])


def without_repeated_strings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, block_bytes: int = BLOCK_BYTES, hot_docs: int = HOT_DOCS
) -> DataFrame:
    """Per row: id, n_bytes, removed (spans in bytes, ``end`` exclusive), kept (the remaining bytes).

    A byte goes if a string of ``length`` bytes around it also starts in a row with a smaller id; strings are judged on
    the input. Null and empty texts have no bytes. Rows of equal id don't lose anything to each other, and a row
    without an id counts as one with the largest id. Repeated rows come out as often as they come in; other columns
    are not looked at. An empty table gives an empty result. ``kept`` may cut a character in two, so it is binary.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    n = max(1, -(-max(total["n"] or 0, 200 * total["rows"]) // block_bytes))
    # the input partition spreads repeated rows over blocks
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(n)).cast("int"))
    blocks = rows.groupBy("block")

    def first(key: tuple, table: pa.Table) -> pa.Table:
        return send_keys(key[0].as_py(), Block.of(table, length, n))

    def second(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        return send_pieces(key[0].as_py(), Block.of(table, length, n), length, answers)

    def last(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        return cut_out(Block.of(table, length, n), length, answers)

    flags = blocks.applyInArrow(first, SENT).groupBy("bucket").applyInArrow(lambda t: judge_keys(t, hot_docs), SENT)
    pieces = blocks.cogroup(flags.groupBy("block")).applyInArrow(second, SENT)
    masks = pieces.groupBy("bucket").applyInArrow(lambda t: judge_pieces(t, length), SENT)
    done = blocks.cogroup(flags.unionByName(masks).groupBy("block")).applyInArrow(last, "id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")
    return done.withColumnRenamed("id", id_col)
