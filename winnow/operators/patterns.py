"""Which literal texts a match of a regular expression must contain.

Java's and Python's expressions agree on a common core. A pattern within that core is parsed here and its literals are
taken from the parse tree; for a pattern outside of it nothing is claimed.
"""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass
from itertools import product
from re import _constants as c, _parser

MOST_TEXTS = 32
MOST_LETTERS = 6  # of a class that is spelled out
LEAST_LENGTH = 2
# what follows a backslash in both dialects with one meaning; digits may be octal in one of them and are left out
SAME_ESCAPES = set("dDwWsSbBAZtnrf")


@dataclass(frozen=True)
class Needed:
    """Every match contains one of ``texts``, in lower case after A-Z are lowered if ``folded``."""

    texts: frozenset[str]
    folded: bool = False


def common_core(pattern: str) -> bool:
    """Whether both dialects read the pattern the same way, as far as literals go."""
    i, in_class, n = 0, False, len(pattern)
    while i < n:
        ch = pattern[i]
        if ch == "\\":
            after = pattern[i + 1 : i + 2]
            if not after or (after.isalnum() and after not in SAME_ESCAPES) or (after == "b" and pattern[i + 2 : i + 3] == "{"):
                return False
            i += 2
            continue
        if in_class:
            if ch == "[" or (ch == "&" and pattern[i + 1 : i + 2] == "&"):
                return False
            if ch == "]":
                in_class = False
        elif ch == "[":
            in_class = True
            if pattern[i + 1 : i + 2] == "^":
                i += 1
            if pattern[i + 1 : i + 2] in ("]", "["):
                return False
        elif ch == "(" and pattern[i + 1 : i + 2] == "?":
            # Python takes flags of a whole pattern at its start only; i, s and m mean the same in both
            if not re.match(r"\(\?(?:[:=!>]|<[=!]|[ism]+:)", pattern[i:]) and not (i == 0 and re.match(r"\(\?[ism]+\)", pattern)):
                return False
        i += 1
    return True


def needed(pattern: str) -> Needed | None:
    """The texts of which every match contains one, or None if nothing (or nothing of two characters) is known."""
    if not common_core(pattern):
        return None
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("error")
            tree = _parser.parse(pattern)
    except (re.error, Warning, OverflowError, RecursionError):
        return None
    folded = bool(tree.state.flags & re.IGNORECASE)
    _, texts = _sequence(tree)
    if not texts or min(map(len, texts)) < LEAST_LENGTH:
        return None
    if folded:
        return Needed(frozenset(t.lower() for t in texts), True) if all(t.isascii() for t in texts) else None
    return Needed(frozenset(texts))


def _better(a: set[str] | None, b: set[str] | None) -> set[str] | None:
    """Longer texts first, then fewer."""

    def worth(x: set[str] | None) -> tuple[int, int]:
        return (min(min(map(len, x)), 8), -len(x)) if x else (0, 0)

    return a if worth(a) >= worth(b) else b


def _joined(a: set[str], b: set[str]) -> set[str] | None:
    return {x + y for x, y in product(a, b)} if len(a) * len(b) <= MOST_TEXTS else None


def _sequence(items) -> tuple[set[str] | None, set[str] | None]:
    """(all texts the items can match, if these are few; texts of which every match contains one)."""
    best: set[str] | None = None
    run: set[str] = {""}
    exact = True
    for op, value in items:
        own, inside = _item(op, value)
        longer = _joined(run, own) if own is not None else None
        if longer is not None:
            run = longer
            continue
        exact = False
        best = _better(_better(best, run if "" not in run else None), inside)
        run = own if own is not None else {""}
    return (run if exact else None), _better(best, run if "" not in run else None)


def _item(op, value) -> tuple[set[str] | None, set[str] | None]:
    if op is c.LITERAL:
        return {chr(value)}, {chr(value)}
    if op is c.IN:
        return _class(value), _class(value)
    if op in (c.AT, c.ASSERT, c.ASSERT_NOT):
        return {""}, None
    if op is c.SUBPATTERN:
        _, added, removed, inner = value
        return (None, None) if added or removed else _sequence(inner)
    if op is c.ATOMIC_GROUP:
        return _sequence(value)
    if op is c.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        exact = set().union(*(e for e, _ in parts)) if all(e is not None for e, _ in parts) else None
        inside = set().union(*(n for _, n in parts)) if all(n for _, n in parts) else None
        return (exact if exact is None or len(exact) <= MOST_TEXTS else None), (inside if inside is None or len(inside) <= MOST_TEXTS else None)
    if op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
        low, high, inner = value
        if low == 0:
            return None, None
        exact, inside = _sequence(inner)
        times: set[str] | None = {""}
        for _ in range(min(int(low), MOST_TEXTS)):
            times = _joined(times, exact) if times is not None and exact is not None else None
        if times is None:
            return None, inside
        return (times if int(low) == high else None), _better(inside, times if "" not in times else None)
    return None, None


def _class(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is c.LITERAL:
            found.add(chr(value))
        elif op is c.RANGE and value[1] - value[0] < MOST_LETTERS:
            found |= {chr(x) for x in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_LETTERS else None
