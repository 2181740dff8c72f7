"""Matching candidates against a rule catalogue.

A few rules become one projection over the candidates.  For more of them, the texts that a match must contain are taken
from each pattern (``patterns.needed``) and looked for all at once by an Aho-Corasick automaton, so a text is read once
whatever the number of rules; only rules one of whose texts occurred are tried, by Spark's own ``rlike``.  Rules without
such a text are tried on every row.  A table of rules too large to be sent to every task (``match_rule_table``) meets the
rows by equi-joins on the first characters of those texts instead.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from winnow.operators.flags import all_flags
from winnow.operators.patterns import LEAST_LENGTH, Needed, needed
from winnow.session import small_or_same, written

# Fixed value: reason given to a candidate that cannot be read.
INVALID = "invalid_molecule"

# More rules than this are looked for by an automaton; up to this many characters of texts (or patterns) go to every task.
INLINE_RULES = 4
SENT_CHARS = 4_000_000
GRAM = 4


@dataclass(frozen=True)
class Rule:
    rule_set: str
    description: str
    pattern: str
    literal: bool = False
    # text every match must contain; looked for first because it is much cheaper than the pattern
    anchor: str | None = None

    def test(self, text: Column) -> Column:
        if self.literal:
            return text.contains(self.pattern)
        found = text.rlike(self.pattern)
        return F.when(text.contains(self.anchor), found).otherwise(F.lit(False)) if self.anchor else found


def load_rules(df: DataFrame, include: Sequence[str], exclude: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Rules of the included rule sets without the excluded (rule set, description) pairs."""
    kept = df.filter(F.col("rule_set_name").isin(*include))
    for name, descriptions in (exclude or {}).items():
        bad = (F.col("rule_set_name") == name) & F.col("description").isin(*descriptions)
        kept = kept.filter(~F.coalesce(bad, F.lit(False)))
    return kept


def rules_from(df: DataFrame, pattern: str = "smarts") -> list[Rule]:
    """Bring a catalogue to the plan. Tables of any size go through ``match_rule_table``."""
    return [Rule(r[0], r[1] or "", r[2]) for r in df.select("rule_set_name", "description", pattern).toLocalIterator()]


def rule_needs(rule: Rule) -> Needed | None:
    """What a match of the rule must contain; None if the rule has to be tried on every row."""
    known = [rule.pattern] if rule.literal else [rule.anchor] if rule.anchor else None
    if known:
        return Needed(frozenset(known)) if len(known[0]) >= LEAST_LENGTH else None
    return None if rule.literal else needed(rule.pattern)


def _automaton(texts: dict[str, list[int]]) -> ahocorasick.Automaton | None:
    found = ahocorasick.Automaton()
    for text, numbers in texts.items():
        found.add_word(text, numbers)
    if not texts:
        return None
    found.make_automaton()
    return found


def candidate_rules(text: Column, needs: Sequence[Needed | None]) -> Column:
    """Numbers of the rules that may match a text, in rising order: those whose needed text occurs, and those without one.

    The automata are built once per task. A missing text has no candidates.
    """
    plain: dict[str, list[int]] = {}
    folded: dict[str, list[int]] = {}
    always = [i for i, need in enumerate(needs) if need is None]
    for i, need in enumerate(needs):
        for t in sorted(need.texts) if need else ():
            (folded if need.folded else plain).setdefault(t, []).append(i)

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _occurring(batches, plain, folded, always)

    return run(text)


def _occurring(batches: Iterator[pa.Array], plain: dict[str, list[int]], folded: dict[str, list[int]], always: list[int]) -> Iterator[pa.Array]:
    """Numbers of the rules per text. A batch stays in Arrow's memory, and one text at a time becomes a Python text."""
    exact, lower = _automaton(plain), _automaton(folded)

    def of(value: str | None) -> list[int] | None:
        if value is None:
            return None
        found = set(always)
        # each distinct text's rules once, however often it occurs
        hits = {id(numbers): numbers for _, numbers in exact.iter(value)} if exact else {}
        if lower:
            hits |= {id(numbers): numbers for _, numbers in lower.iter(value.lower())}
        for numbers in hits.values():
            found.update(numbers)
        return sorted(found)

    for batch in batches:
        yield pa.array((of(value.as_py()) for value in batch), pa.list_(pa.int32()), size=len(batch))


def _hits(text: Column, rules: Sequence[Rule]) -> Column:
    found = [
        F.when(r.test(text), F.struct(F.lit(r.rule_set).alias("rule_set"), F.lit(r.description).alias("description")))
        for r in rules
    ]
    return F.filter(F.array(*found), lambda h: h.isNotNull())


def _hits_by_automaton(text: Column, candidates: Column, rules: Sequence[Rule]) -> Column:
    # one literal, parsed when the plan is optimised
    listed = F.from_json(F.lit(json.dumps([[r.rule_set, r.description, r.pattern, str(r.literal).lower()] for r in rules])), "array<array<string>>")
    tried = F.transform(candidates, lambda i: listed[i])
    matching = F.filter(tried, lambda r: F.when(r[3] == "true", F.contains(text, r[2])).otherwise(F.rlike(text, r[2])))
    return F.transform(matching, lambda r: F.struct(r[0].alias("rule_set"), r[1].alias("description")))


def match_rules(df: DataFrame, text: str, rules: Sequence[Rule], out: str = "hits", inline: int = INLINE_RULES) -> DataFrame:
    """Add ``hits``: the distinct (rule set, description) pairs that match, in catalogue order.

    A missing text hits every rule set once with the reason for unreadable candidates. Up to ``inline`` rules are one
    projection; more are looked for by their needed texts first.
    """
    names = list(dict.fromkeys(r.rule_set for r in rules))
    invalid = F.array(
        *[F.struct(F.lit(n).alias("rule_set"), F.lit(INVALID).alias("description")) for n in names]
    )
    if not rules:
        return df.withColumn(out, F.array().cast("array<struct<rule_set: string, description: string>>"))
    if len(rules) <= inline:
        found = F.array_distinct(_hits(F.col(text), rules))
        return df.withColumn(out, F.when(F.col(text).isNull(), invalid).otherwise(found))
    marked = df.withColumn("__candidates", candidate_rules(F.col(text), [rule_needs(r) for r in rules]))
    found = F.array_distinct(_hits_by_automaton(F.col(text), F.col("__candidates"), rules))
    return marked.withColumn(out, F.when(F.col(text).isNull(), invalid).otherwise(found)).drop("__candidates")


@F.pandas_udf(T.StructType([T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("folded", T.BooleanType())]))
def _needed_texts(patterns: pd.Series) -> pd.DataFrame:
    found = patterns.map(lambda p: needed(p) if p else None)
    return pd.DataFrame({"texts": found.map(lambda n: sorted(n.texts) if n else []), "folded": found.map(lambda n: bool(n and n.folded))})


def match_rule_table(df: DataFrame, row_id: str, text: str, rules: DataFrame, pattern: str = "smarts", sent_chars: int = SENT_CHARS) -> DataFrame:
    """Rules from a table of any size: distinct (row_id, rule_set_name, description) for every pattern found in a text.

    The table is measured first. Up to ``sent_chars`` characters it goes to every task as an automaton; beyond that rows
    and rules meet by equi-joins on the first characters of the texts a match needs, pairs are made distinct by id, and
    only these get their text and pattern back. Rules without a needed text are tried on every row either way, in
    slices of bounded size. Missing texts and patterns match nothing; ``row_id`` must be unique.
    """
    listed = rules.filter(F.col(pattern).isNotNull()).select("rule_set_name", F.coalesce("description", F.lit("")).alias("description"), F.col(pattern).alias("pattern")).distinct()
    listed = listed.withColumn("need", _needed_texts("pattern"))
    listed = written(listed.withColumn("number", F.xxhash64("rule_set_name", "description", "pattern")), "rules")
    texts = F.aggregate("need.texts", F.lit(0), lambda n, t: n + F.length(t))
    chars = listed.agg(F.sum(F.length("pattern") + texts)).first()[0]
    rows = df.filter(F.col(text).isNotNull()).select(row_id, F.col(text).alias("text"))
    keys = [row_id, "rule_set_name", "description"]

    def by_automaton(some: DataFrame) -> DataFrame:
        found = rule_hits(match_rules(rows, "text", rules_from(some, "pattern"), inline=0), [row_id])
        return found.withColumnRenamed("rule_set", "rule_set_name")

    if (chars or 0) <= sent_chars:
        return by_automaton(listed).select(*keys).distinct()
    needy = listed.filter(F.size("need.texts") > 0)
    grams = needy.select("number", "need.folded", F.explode("need.texts").alias("t")).select("number", "folded", F.substring("t", 1, GRAM).alias("gram")).distinct()

    def met(value: Column, folded: bool) -> DataFrame:
        lengths = F.sequence(F.lit(LEAST_LENGTH), F.lit(GRAM))
        starts = F.sequence(F.lit(1), F.greatest(F.length(value) - LEAST_LENGTH + 1, F.lit(1)))
        pieces = F.flatten(F.transform(lengths, lambda n: F.transform(starts, lambda i: F.substring(value, i, n))))
        own = rows.select(row_id, F.explode(F.array_distinct(pieces)).alias("gram"))
        return own.join(grams.filter(F.col("folded") == folded), "gram").select(row_id, "number")

    pairs = met(F.col("text"), False).unionByName(met(F.lower("text"), True)).distinct()
    tried = pairs.join(needy, "number").join(rows, row_id).filter(F.rlike("text", F.col("pattern")))
    found = tried.select(*keys)
    plain = listed.filter(F.size("need.texts") == 0)
    slices = max(1, -(-int(plain.agg(F.sum(F.length("pattern"))).first()[0] or 0) // sent_chars))
    for k in range(slices):
        found = found.unionByName(by_automaton(plain.filter(F.pmod("number", F.lit(slices)) == k)).select(*keys))
    return found.distinct()


def match_literals(df: DataFrame, row_id: str, text: str, rules: DataFrame, pattern: str = "smarts") -> DataFrame:
    """Rules that are literal texts, from a table of any size: (row_id, rule_set_name, description) per contained text.

    A text that contains a rule's pattern contains the pattern's first characters; rows and rules meet by an equi-join
    on these, and the whole pattern is looked for in what meets.  Empty patterns match nothing.
    """
    size = F.least(F.length(pattern), F.lit(GRAM))
    marked = rules.filter(F.length(pattern) > 0).select(
        "rule_set_name", "description", F.col(pattern).alias("__pattern"), F.expr(f"substring(`{pattern}`, 1, {GRAM})").alias("__gram"), size.alias("__size")
    )
    marked = small_or_same(marked.distinct(), "literal-rules")
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.length(text), F.lit(GRAM))), lambda n: F.transform(
        F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.col(text).substr(i, n))))
    rows = df.filter(F.length(text) > 0).select(row_id, F.col(text).alias("__text"), F.explode(F.array_distinct(grams)).alias("__gram"))
    hits = rows.join(marked, "__gram").filter(F.contains("__text", "__pattern"))
    return hits.select(row_id, "rule_set_name", "description").distinct()


def rule_hits(matched: DataFrame, keep: Sequence[str], hits: str = "hits") -> DataFrame:
    """Long form: one row per candidate and hit."""
    return matched.select(*keep, F.explode(hits).alias("h")).select(
        *keep, F.col("h.rule_set").alias("rule_set"), F.col("h.description").alias("description")
    )


def rule_masks(matched: DataFrame, names: Sequence[str], hits: str = "hits", reasons: bool = True) -> DataFrame:
    """``pass_<set>`` and ``reasons_<set>`` per rule set, ``pass`` = all, ``pass_any`` = any."""
    def hit(name: str) -> Column:
        return F.exists(F.col(hits), lambda h: h["rule_set"] == name)

    def texts(name: str) -> Column:
        own = F.filter(F.col(hits), lambda h: (h["rule_set"] == name) & (h["description"] != ""))
        return F.array_join(F.transform(own, lambda h: h["description"]), ";")

    flags = {f"pass_{n}": ~hit(n) for n in names}
    why = {f"reasons_{n}": texts(n) for n in names} if reasons else {}
    out = matched.withColumns({**flags, **why})
    cols = list(flags)
    return out.withColumns({"pass": all_flags(cols), "pass_any": all_flags(cols, "any")})


def match_tokens(df: DataFrame, row_id: str, tokens: str, rules: DataFrame) -> DataFrame:
    """Rules that are single tokens: (row_id, rule_set, description) hits by an equi-join.

    ``rules`` has rule_set, description, token.  A catalogue that has been counted as small is sent to every task; the
    tokens of a row then stay where they are, and hits are made distinct before they are shuffled.
    """
    distinct = df.select(row_id, F.explode(F.array_distinct(tokens)).alias("token"))
    hits = distinct.join(small_or_same(rules.select("rule_set", "description", "token").distinct(), "token-rules"), "token")
    return hits.select(row_id, "rule_set", "description").distinct()
