"""Rank files of public tokenizers; their path is a parameter and must be readable on every executor."""

from __future__ import annotations

import base64
from functools import lru_cache

import tiktoken


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def encoding_of(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """One encoding per Python worker and vocabulary, without special tokens."""
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})
