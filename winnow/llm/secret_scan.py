"""Secret scan: fixed patterns plus a token-efficiency test.

A random string costs a tokenizer nearly one token per one or two characters, words and names far fewer. Runs of key
characters that the patterns do not cover are encoded with a tiktoken vocabulary; a run with few characters per token
is reported, unless its form is that of a known digest, a UUID or an identifier.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from winnow.llm.vocabulary import encoding_of

# The base patterns, their least lengths and their order.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")
# Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

LEAST_RANDOM = 20
CHARS_PER_TOKEN = 1.9

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_assign_words = ("passw", "secret", "token", "api")
_access = re.compile(ACCESS)
_hex = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}")
_run = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}")
_uuid = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_word = re.compile(r"[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+|")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds."""
    found = []
    small = text.lower()
    if any(word in small for word in _assign_words):
        found += [(m.start(), 0, m.end()) for m in _assign.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in _hex.finditer(text)]
    return sorted(found)


def has_known_form(run: str) -> bool:
    """A digest, a UUID, or words and numbers joined as identifiers are."""
    if len(run) in DIGEST_LENGTHS and all(c in "0123456789abcdefABCDEF" for c in run):
        return True
    if _uuid.fullmatch(run):
        return True
    if not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return True
    return all(_word.fullmatch(part) for part in re.split(r"[+/_=-]", run))


def random_spans(text: str, base: list[tuple[int, int, int]], encoding: tiktoken.Encoding, most: float) -> list[tuple[int, int, int]]:
    """Runs of key characters outside the base spans with at most ``most`` characters per token."""
    found = []
    for m in _run.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, _, b in base) or has_known_form(m[0]):
            continue
        if end - start <= most * len(encoding.encode_ordinary(m[0])):
            found.append((start, 3, end))
    return found


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chars_per_token: float = CHARS_PER_TOKEN) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_random, base_sha256, spans per row.

    ``spans`` lists kind:start:end by start, then kind, in code points with the end excluded; ``base_sha256`` digests
    the same list without the added kind ``random``. Null and empty texts have no spans (the digest is that of an empty
    string). Whole texts are scanned. Null ids, repeated rows and ties of start are kept as they come; other columns
    are left out; an empty table gives an empty result.
    """
    kind = docs.select(id_col).schema[0].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoding_of(ranks_path, pattern)
        for batch in batches:
            counts, digests, lists = [[] for _ in KINDS], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + random_spans(text, base, encoding, chars_per_token))
                for k, held in enumerate(counts):
                    held.append(sum(s[1] == k for s in spans))
                digests.append(hashlib.sha256(shown(base).encode()).hexdigest())
                lists.append(shown(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(lists, pa.string())], schema=schema)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(scan, f"id {kind.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)
