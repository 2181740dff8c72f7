"""Alignment of two tokenizers over the same texts.

A batch of texts is encoded by both sides and laid out as two tables of tokens with their byte offsets. ``merge_asof``,
keyed by document, gives each token start the token of the other side that covers it; both directions together are all
overlaps, and equal ends cut the tokens into groups. Id pairs are counted per block of documents first, so the corpus
counts come from an ordinary aggregation, and each block gets the counts of just its own pairs back.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from winnow.llm.storage import written

BATCH_BYTES = 1 << 19
BLOCK_BYTES = 8 << 20
BATCH_ROWS = 2000


# Characters whose classes no Unicode version changes: on these alone both libraries cut words alike.
SETTLED = regex.compile(r"[\t\n\x20-\x7e\u00a1-\u00ac\u00ae-\u017f]*")


def same_as_ranks(path: str) -> bool:
    """Whether a byte-level vocabulary is one of plain ranks: merges in the order of the ids they give, nothing before."""
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    vocab, merges = read["model"]["vocab"], read["model"]["merges"]
    given = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
    cut = read["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and read["normalizer"] is None
    return bool(plain) and all(a < b for a, b in zip(given[:-1], given[1:], strict=True))


class Side:
    """One tokenizer in a Python worker: ids per text and the bytes of every id."""

    def __init__(self, path: str, pattern: str | None = None):
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True
            byte = byte_of_letter()
            specials = {i: t.content.encode() for i, t in model.get_added_tokens_decoder().items()}
            self.bytes = [specials[i] if i in specials else bytes(byte[c] for c in model.id_to_token(i) or "") for i in range(model.get_vocab_size())]

            def whole(texts: list[str]) -> list[list[int]]:
                return [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

            if pattern and same_as_ranks(path):  # four times as fast, for texts of settled characters
                ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks={b: i for i, b in enumerate(self.bytes) if i not in specials}, special_tokens={})

                def spaced(texts: list[str]) -> list[list[int]]:
                    plain = [SETTLED.fullmatch(t) is not None for t in texts]
                    rest = iter(whole([" " + t for t, p in zip(texts, plain, strict=True) if not p]))
                    return [ranks.encode_ordinary(" " + t) if p else next(rest) for t, p in zip(texts, plain, strict=True)]

                self.encode = spaced
            else:
                self.encode = lambda texts: whole([" " + t for t in texts])
        else:
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
            self.encode = lambda texts: model.encode(texts, num_threads=1)  # it adds the space itself
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.digits = np.array([str(i).encode() for i in range(len(self.bytes))])


def byte_of_letter() -> dict[str, int]:
    """The printable letters that stand for bytes in byte-level vocabularies: a byte that prints stands for itself, the
    others take the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def side_of(path: str, pattern: str | None = None) -> Side:
    return Side(path, pattern)


class Aligned:
    """Tokens, links and groups of a batch of texts; texts that the two sides don't both spell out have no tokens."""

    def __init__(self, texts: list[str | None], a: Side, b: Side):
        n = len(texts)
        given = [i for i, t in enumerate(texts) if t]
        ids_a: list[list[int]] = [[] for _ in texts]
        ids_b: list[list[int]] = [[] for _ in texts]
        wanted = [texts[i] for i in given]
        for i, x, y in zip(given, a.encode(wanted), b.encode(wanted), strict=True) if given else ():
            raw = b" " + texts[i].encode()
            if b"".join([a.bytes[t] for t in x]) == raw and b"".join([b.bytes[t] for t in y]) == raw:
                ids_a[i], ids_b[i] = x, y
        self.a, self.n_a, starts_a, ends_a, doc_a = laid_out(ids_a, a)
        self.b, self.n_b, starts_b, ends_b, doc_b = laid_out(ids_b, b)
        left = pd.DataFrame({"start": starts_a, "doc": doc_a, "a": np.arange(self.a.size)})
        right = pd.DataFrame({"start": starts_b, "doc": doc_b, "b": np.arange(self.b.size)})
        over_a = pd.merge_asof(left, right, on="start", by="doc")
        right["at"] = right["start"]
        left["begin"] = left["start"]
        over_b = pd.merge_asof(right, left, on="start", by="doc")
        over_b = over_b[over_b["at"] != over_b["begin"]]  # equal starts are links of both directions
        self.link_a = np.concatenate([over_a["a"].to_numpy(), over_b["a"].to_numpy()])
        self.link_b = np.concatenate([over_a["b"].to_numpy(), over_b["b"].to_numpy()])
        self.link_doc = np.concatenate([over_a["doc"].to_numpy(), over_b["doc"].to_numpy()])
        self.n_links = np.bincount(self.link_doc, minlength=n)
        self.cut_a, self.cut_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        self.n_groups = np.bincount(doc_a[self.cut_a], minlength=n)
        self.sides = a, b

    def groups(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` per text: a semicolon between groups, A's ids before B's."""
        a, b = self.sides
        group_a, group_b = np.cumsum(self.cut_a) - self.cut_a, np.cumsum(self.cut_b) - self.cut_b
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        width = max(a.digits.itemsize, b.digits.itemsize) + 1
        laid = np.zeros((self.a.size + self.b.size, width), np.uint8)
        place_a = np.arange(self.a.size) + (np.cumsum(size_b) - size_b)[group_a]
        place_b = np.arange(self.b.size) + np.cumsum(size_a)[group_b]
        for ids, place, cut, side, mark in ((self.a, place_a, self.cut_a, a, "|"), (self.b, place_b, self.cut_b, b, ";")):
            laid[place, : side.digits.itemsize] = side.digits[ids].view(np.uint8).reshape(ids.size, -1)
            laid[place, width - 1] = np.where(cut, ord(mark), ord(","))
        stops = np.cumsum(self.n_a + self.n_b)
        laid[stops[self.n_a > 0] - 1, width - 1] = 0
        return [laid[x:y].tobytes().translate(None, b"\0") for x, y in zip(np.append(0, stops[:-1]).tolist(), stops.tolist(), strict=True)]

    def pairs(self) -> np.ndarray:
        """Of each link, id of A * size of B's vocabulary + id of B."""
        return self.a[self.link_a] * np.int64(len(self.sides[1].bytes)) + self.b[self.link_b]


def laid_out(ids: list[list[int]], side: Side) -> tuple[np.ndarray, ...]:
    """All ids, tokens per text, byte offsets (texts one after the other) and the text of each token."""
    n = np.array([len(x) for x in ids], np.int64)
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
    ends = np.cumsum(side.sizes[flat])
    return flat, n, ends - side.sizes[flat], ends, np.repeat(np.arange(len(ids)), n)


def texts_in_batches(texts: list[str | None], most: int = BATCH_BYTES) -> Iterator[slice]:
    """Slices of texts of about ``most`` characters, a longer text alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t or "") > most:
            yield slice(lo, i)
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield slice(lo, len(texts))


def align(docs: DataFrame, byte_path: str, piece_path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, per row: id, tokens_a, tokens_b (ids), links (places of an A and a B token whose bytes
    overlap), groups (`a1,a2|b1;a3|b2,b3`). ``pattern`` is how the byte-level side cuts words; it only saves time.

    Null and empty texts, and texts that one side doesn't spell out byte by byte, have no tokens. Repeated rows come
    out as they come in; other columns are not looked at. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side_of(byte_path, pattern), side_of(piece_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s in texts_in_batches(texts):
                found = Aligned(texts[s], a, b)
                base_a, base_b = np.cumsum(found.n_a) - found.n_a, np.cumsum(found.n_b) - found.n_b
                order = np.lexsort((found.link_b, found.link_a))
                link_doc = found.link_doc[order]
                links = pa.StructArray.from_arrays([pa.array((found.link_a[order] - base_a[link_doc]).astype(np.int32)), pa.array((found.link_b[order] - base_b[link_doc]).astype(np.int32))], names=["a", "b"])
                lists = [pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), v) for n, v in ((found.n_a, pa.array(found.a.astype(np.int32))), (found.n_b, pa.array(found.b.astype(np.int32))), (found.n_links, links))]
                groups = pa.array([g.decode() for g in found.groups()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("id")[s.start : s.stop], *lists, groups], names=["id", "tokens_a", "tokens_b", "links", "groups"])

    schema = f"id {kind}, tokens_a array<int>, tokens_b array<int>, links array<struct<a: int, b: int>>, groups string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


COUNTED = ["n_a", "n_b", "n_groups", "n_links"]


class BlockOfTexts:
    """Counts of the texts since the last row was made, and the id pairs of each."""

    def __init__(self) -> None:
        self.size, self.ids, self.digests, self.counted, self.codes, self.times, self.distinct = 0, [], [], [], [], [], []

    def add(self, ids: list, texts: list[str | None], found: Aligned) -> None:
        self.size += sum(len(t or "") for t in texts)
        self.ids += ids
        self.digests += [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups()]
        self.counted.append(np.array([found.n_a, found.n_b, found.n_groups, found.n_links]))
        a, b = found.sides
        space = len(a.bytes) * len(b.bytes)  # a batch has few texts, so text and pair fit one number
        pairs = np.sort(found.link_doc * space + found.pairs())
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if pairs.size else np.zeros(0, np.int64)
        self.codes.append(pairs[first] % space)
        self.times.append(np.diff(np.append(first, pairs.size)))
        self.distinct.append(np.bincount(pairs[first] // space, minlength=len(ids)))

    def row(self, block: int) -> pa.RecordBatch:
        """Pairs of the block by falling count; texts hold places in that list, so that frequent pairs are short."""
        codes, where = np.unique(np.concatenate(self.codes), return_inverse=True)
        times = np.concatenate(self.times)
        total = np.bincount(where, weights=times, minlength=codes.size).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(order.size)
        held = squeezed(np.concatenate(self.counted, axis=1).ravel(), np.concatenate(self.distinct), back[where], times)
        values = [[block], [self.ids], [self.digests], [held], [codes[order]], [total[order]]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["block", "ids", "digests", "held", "codes", "n"])


def squeezed(*arrays: np.ndarray) -> bytes:
    """Non-negative integers as bytes of equal weight, compressed, with the lengths in front."""
    out = [np.array([len(arrays)], np.int64).tobytes()]
    for a in arrays:
        raw = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(a.size, 8).T).tobytes()
        packed = pa.compress(raw, codec="zstd", asbytes=True)
        out += [np.array([a.size, len(packed)], np.int64).tobytes(), packed]
    return b"".join(out)


def unsqueezed(held: bytes) -> list[np.ndarray]:
    out, at = [], 8
    for _ in range(int(np.frombuffer(held, np.int64, 1)[0])):
        n, size = np.frombuffer(held, np.int64, 2, at).tolist()
        raw = pa.decompress(held[at + 16 : at + 16 + size], n * 8, codec="zstd", asbytes=True)
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").ravel().astype(np.int64))
        at += 16 + size
    return out


def alignment_counts(
    docs: DataFrame, byte_path: str, piece_path: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 ('' without tokens).

    A pair's count is the number of links of all texts that hold it; n_best counts the links whose pair has the
    highest count of its B id (ties too), count_sum adds the counts over the links. The other cases are as in ``align``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side_of(byte_path, pattern), side_of(piece_path)
        task = TaskContext.get()
        block, number = BlockOfTexts(), (task.partitionId() if task else 0) << 32
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for s in texts_in_batches(texts):
                block.add(ids[s], texts[s], Aligned(texts[s], a, b))
                if block.size >= block_bytes:
                    yield block.row(number)
                    block, number = BlockOfTexts(), number + 1
        if block.ids:
            yield block.row(number)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "block long, ids array<long>, digests array<string>, held binary, codes array<long>, n array<long>"
    blocks = written(texts.mapInArrow(encode, schema), "aligned", batch_rows=BATCH_ROWS)
    asked = blocks.select("block", F.explode(F.arrays_zip("codes", "n")).alias("pair")).select("block", F.col("pair.codes").alias("code"), F.col("pair.n").alias("n"))
    counts = asked.groupBy("code").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.pmod("code", F.lit(len(side_of(piece_path).bytes))))  # one B id: at most a row per A id
    scored = counts.select("code", "total", (F.col("total") == F.max("total").over(of_b)).alias("best"))
    answers = asked.select(F.col("block").alias("asker"), "code").join(scored, "code")

    def count(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        code = answers["code"].to_numpy()
        order = np.argsort(code)
        place = order[np.searchsorted(code, np.array(row["codes"], np.int64), sorter=order)] if code.size else order
        total, best = answers["total"].to_numpy()[place], answers["best"].to_numpy()[place].astype(np.int64)
        counted, distinct, where, times = unsqueezed(row["held"])
        stops = np.cumsum(distinct)
        sums = [np.append(0, np.cumsum(times * x[where]))[np.stack([stops - distinct, stops])] for x in (best, total)]
        values = [*counted.reshape(len(COUNTED), -1), *(s[1] - s[0] for s in sums)]
        return pa.Table.from_arrays([pa.array(row["ids"], pa.int64()), *map(pa.array, values), pa.array(row["digests"], pa.string())], names=["id", *COUNTED, "n_best", "count_sum", "groups_sha256"])

    result = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    done = blocks.select("block", "ids", "digests", "held", "codes").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(count, result)
    return done.withColumnRenamed("id", id_col)
