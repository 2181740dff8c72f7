"""Byte-level BPE encoding and decoding by ranks, with a hierarchical-bitmap rank queue.

Within a pre-token the pair of neighbours with the lowest rank merges first, the leftmost first among equals. Pairs
wait in buckets by rank, which hold the positions of their left parts in a linked list of parts. Three levels of
bitmaps say which buckets are in use, so the next one is found by three find-first-set steps however long the
pre-token is. A merge leaves its neighbours' old entries where they are; they are recognised as stale when popped.
Pre-tokens are independent, so all new short ones of a slice of texts share one queue, with a bucket for many neighbouring
ranks: at each turn every pre-token with a pair in the lowest bucket merges its own lowest one. A long one has a queue of
its own, whose buckets give one position at a time: its work grows with its length, whatever repeats in it.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from winnow.llm.vocabulary import load_ranks

CACHE_ENTRIES = 150_000
CACHE_CHARS = 64
WIDTH = 12  # bits of the ranks that share a bucket of the shared queue
LONG_BYTES = 256  # longer pre-tokens are merged place by place
SLICE_CHARS = 500_000

# The Latin-1 members of the Unicode classes L, N and White_Space.
L1_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
L1_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
L1_SPACE = "\t-\r \x85\xa0"


class RankQueue:
    """Buckets by rank, of positions: ``push_one`` in any order, ``pop_one`` takes the least of the lowest rank.

    Positions that come in rising order wait in a queue of their own and need no heap.
    """

    def __init__(self) -> None:
        self.buckets: dict = {}
        self.leaf: dict[int, int] = {}
        self.middle: dict[int, int] = {}
        self.top = 0
        self.least: int | None = None  # the lowest bucket in use, if it is known

    def push_one(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = bucket = deque(), []
            self._mark(rank)
        rising, others = bucket
        if not rising or position > rising[-1]:
            rising.append(position)
        else:
            heapq.heappush(others, position)

    def _mark(self, rank: int) -> None:
        word, block = rank >> 6, rank >> 12
        if self.least is not None and rank < self.least:
            self.least = rank
        self.leaf[word] = self.leaf.get(word, 0) | 1 << (rank & 63)
        self.middle[block] = self.middle.get(block, 0) | 1 << (word & 63)
        self.top |= 1 << block

    def lowest(self) -> int:
        if self.least is not None:
            return self.least
        block = (self.top & -self.top).bit_length() - 1
        held = self.middle[block]
        word = block << 6 | (held & -held).bit_length() - 1
        bits = self.leaf[word]
        self.least = word << 6 | (bits & -bits).bit_length() - 1
        return self.least

    def _clear(self, rank: int):
        self.least = None
        word, block = rank >> 6, rank >> 12
        bits, held = self.leaf[word], self.middle[block]
        self.leaf[word] = bits = bits & (bits - 1)
        if not bits:
            self.middle[block] = held = held & (held - 1)
            if not held:
                self.top &= self.top - 1
        return self.buckets.pop(rank)

    def pop_one(self) -> tuple[int, int]:
        rank = self.least
        if rank is None:
            rank = self.lowest()
        rising, others = self.buckets[rank]
        position = heapq.heappop(others) if others and (not rising or others[0] < rising[0]) else rising.popleft()
        if not rising and not others:
            self._clear(rank)
        return rank, position


class SharedQueue(RankQueue):
    """As ``RankQueue`` for places of many pre-tokens: a bucket holds arrays of places of ``1 << WIDTH`` neighbouring ranks."""

    def push(self, bucket: int, places: np.ndarray) -> None:
        held = self.buckets.get(bucket)
        if held is not None:
            held.append(places)
            return
        self.buckets[bucket] = [places]
        self._mark(bucket)

    def push_all(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Entries of many ranks; a rank below 0 stands for no entry."""
        held = np.flatnonzero(ranks >= 0)
        if not len(held):
            return
        buckets = ranks[held] >> WIDTH
        order = np.argsort(buckets, kind="stable")
        buckets, places = buckets[order], places[held[order]]
        bounds = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
        for start, stop in zip(bounds, bounds[1:], strict=False):
            self.push(int(buckets[start]), places[start:stop])

    def pop(self) -> tuple[int, np.ndarray]:
        """The lowest bucket and its places in order, each once."""
        bucket = self.lowest()
        held = self._clear(bucket)
        places = np.sort(np.concatenate(held) if len(held) > 1 else held[0])
        return bucket, places[np.append(True, places[1:] != places[:-1])]


class Pairs:
    """The rank of every pair of tokens whose bytes together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(found, dtype=np.int64).reshape(-1, 3).T
        self.width = max(ranks.values()) + 2
        keys = left * self.width + right
        order = np.argsort(keys)
        self.keys, self.rank = np.append(keys[order], np.iinfo(np.int64).max), np.append(rank[order], -1)
        # merges after which a pair of a lower rank can come up
        self.falls = np.zeros(self.width, dtype=bool)
        self.falls[left[rank < left]] = self.falls[right[rank < right]] = True
        byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.of_bytes = self.of(byte[:, None], byte[None, :])

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 if there is none or an id is -1."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.rank[at], -1)


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], pairs: Pairs) -> list[list[int]]:
    """Ids of each of many non-empty pre-tokens, which share one queue: nothing merges across their borders.

    Of a bucket each pre-token merges the places of its own lowest rank, which is the lowest it has anywhere, and the rest
    waits. They merge together, except overlapping ones (``aaa``), of which every second one is stale, and where a merge
    may bring up a lower rank: there only the leftmost one merges.
    """
    if not pieces:
        return []
    byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
    text = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    n = len(text)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    stops = np.cumsum(lengths)
    starts = stops - lengths
    owner = np.repeat(np.arange(len(pieces)), lengths)
    # linked lists of parts; place n is the border on both sides and has no id
    ids = np.append(byte_id[text], -1)
    after = np.arange(1, n + 2)
    after[stops - 1] = n
    before = np.arange(-1, n)
    before[starts] = n
    pair = np.full(n + 1, -1)
    pair[: n - 1] = pairs.of_bytes[text[:-1], text[1:]]
    pair[stops - 1] = -1
    queue = SharedQueue()
    queue.push_all(pair, np.arange(n + 1))
    while queue.top:
        bucket, places = queue.pop()
        places = places[pair[places] >> WIDTH == bucket]  # the others are stale
        if not len(places):
            continue
        rank, own = pair[places], owner[places]
        first = np.append(True, own[1:] != own[:-1])
        lowest = np.minimum.reduceat(rank, np.flatnonzero(first))[np.cumsum(first) - 1]
        now = rank == lowest
        if not now.all():
            queue.push(bucket, places[~now])
        places, rank, own = places[now], rank[now], own[now]
        again = np.append(False, own[1:] == own[:-1])  # not the leftmost place of its pre-token
        if again.any():
            wait = again & pairs.falls[rank]
            if wait.any():
                queue.push(bucket, places[wait])
            chained = again & np.append(False, after[places[:-1]] == places[1:])
            index = np.arange(len(places))
            in_chain = index - np.maximum.accumulate(np.where(chained, 0, index))
            now = ~wait & (in_chain % 2 == 0)
            places, rank = places[now], rank[now]
        right = after[places]
        beyond = after[right]
        ids[places], ids[right] = rank, -1
        after[places] = beyond
        before[beyond] = places
        pair[right] = -1
        ahead = before[places]
        changed = np.concatenate([places, ahead[ahead < n]])
        pair[changed] = new = pairs.of(ids[changed], ids[after[changed]])
        queue.push_all(new, changed)
    left = ids[:-1] >= 0
    out = ids[:-1][left].tolist()
    bounds = np.cumsum(np.add.reduceat(left.astype(np.int64), starts)).tolist()
    return [out[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long pre-token, merged place by place; as ``merge_all``, in time that grows with its length."""
    n = len(piece)
    part = [piece[i : i + 1] for i in range(n)] + [b""]
    after, before = list(range(1, n + 1)) + [n], list(range(-1, n))
    rank_of = ranks.get
    pair = [rank_of(part[i] + part[i + 1], -1) for i in range(n - 1)] + [-1, -1]
    queue = RankQueue()
    push, pop = queue.push_one, queue.pop_one
    for i, rank in enumerate(pair):
        if rank >= 0:
            push(rank, i)
    while queue.top:
        rank, i = pop()
        if pair[i] != rank:
            continue  # stale
        j = after[i]
        beyond = after[j]
        part[i] += part[j]
        part[j], pair[j] = b"", -1
        after[i], before[beyond] = beyond, i
        pair[i] = new = rank_of(part[i] + part[beyond], -1) if beyond < n else -1
        if new >= 0:
            push(new, i)
        ahead = before[i]
        if ahead >= 0:
            pair[ahead] = new = rank_of(part[ahead] + part[i], -1)
            if new >= 0:
                push(new, ahead)
    return [ranks[x] for x in part if x]


class Encoder:
    """One vocabulary and its pattern; keeps the ids of recent pre-tokens, up to a fixed number."""

    def __init__(self, ranks_path: str, pattern: str):
        self.ranks = load_ranks(ranks_path)
        self.pairs = Pairs(self.ranks)
        self.bytes_of = {str(i): token for token, i in self.ranks.items()}
        self.decimal = {int(i): i for i in self.bytes_of}.__getitem__
        # tiktoken's \s is White_Space, without the separators 1C-1F
        self.general = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{L1_SPACE}{L1_LETTER}{L1_NUMBER}]").replace(r"\p{L}", f"[{L1_LETTER}]").replace(r"\p{N}", f"[{L1_NUMBER}]")
        latin = latin.replace(r"\S", f"[^{L1_SPACE}]").replace(r"\s", f"[{L1_SPACE}]")
        self.latin = None if r"\p" in latin else re.compile(latin)
        self.known: dict[str, str] = {}

    def split(self, text: str) -> list[str]:
        if self.latin is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.latin.findall(text)
        return self.general.findall(text)

    def ids(self, texts: list[str]) -> list[str]:
        """Decimal ids joined by one space, per text; empty for an empty text."""
        known = self.known
        split = [self.split(text) for text in texts]
        new = list(set().union(*split).difference(known))
        if new:
            ranks, decimal = self.ranks, self.decimal
            found, short = {}, []
            for piece in new:
                held = piece.encode()
                rank = ranks.get(held)
                if rank is not None:
                    found[piece] = decimal(rank)
                elif len(held) <= LONG_BYTES:
                    short.append(held)
                    found[piece] = ""
                else:
                    found[piece] = " ".join(map(decimal, merge_long(held, ranks)))
            merged = iter(merge_all(short, ranks, self.pairs))
            found.update((piece, " ".join(map(decimal, next(merged)))) for piece, ids in found.items() if not ids)
            if len(known) + len(found) > CACHE_ENTRIES:
                used = set().union(*split)
                self.known = known = {piece: known[piece] for piece in used if piece in known}
            known.update(found)
        out = [" ".join(map(known.__getitem__, pieces)) for pieces in split]
        for piece in new:
            if len(piece) > CACHE_CHARS:
                del known[piece]
        return out

    def decode(self, ids: str) -> bytes:
        """Bytes of decimal ids joined by one space."""
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(ranks_path, pattern)


def slices(batch: pa.RecordBatch, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Cuts between rows so that the texts of a slice (column 1) have ``most_chars`` characters, or are one text."""
    sizes = np.cumsum(pc.utf8_length(batch.column(1).fill_null("")).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most_chars, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def each_text(make: Callable[[Encoder, str], tuple], schema: pa.Schema, ranks_path: str, pattern: str):
    """Batches (id, text) -> batches of id and what ``make`` returns for the ids of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks_path, pattern)
        for whole in batches:
            for batch in slices(whole, SLICE_CHARS):
                made = [make(own, ids) for ids in own.ids([text or "" for text in batch.column(1).to_pylist()])]
                columns = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    return run


def _digests(own: Encoder, ids: str) -> tuple[int, str, str]:
    sha = hashlib.sha256
    return (ids.count(" ") + 1 if ids else 0), sha(ids.encode()).hexdigest(), sha(own.decode(ids)).hexdigest()


def _round_trip(own: Encoder, ids: str) -> tuple[list[int], bytes]:
    return (list(map(int, ids.split(" "))) if ids else []), own.decode(ids)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of token ids), n_tokens, decoded (bytes of the ids) per row.

    Null and empty texts have no ids. Each match of the pattern is encoded by itself, without special tokens. Repeated
    rows give repeated rows, null ids stay null, other columns are left out; an empty table gives an empty result.
    ``ranks_path`` must be readable on every executor.
    """
    kind = docs.select(id_col).schema[0]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    arrow = pa.schema([("id", _arrow(kind)), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
    out = rows.mapInArrow(each_text(_round_trip, arrow, ranks_path, pattern), f"id {kind.dataType.simpleString()}, ids array<int>, decoded binary")
    return out.select(F.col("id").alias(id_col), "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode``, with SHA-256 digests in place of the ids (decimal, joined by one space) and the decoded bytes."""
    kind = docs.select(id_col).schema[0]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    arrow = pa.schema([("id", _arrow(kind)), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    out = rows.mapInArrow(each_text(_digests, arrow, ranks_path, pattern), f"id {kind.dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)


def _arrow(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)
