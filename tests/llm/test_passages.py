"""Repeated passages of a few lines, whatever stands around them."""

import pytest

from winnow.llm.line_dedup import without_passages


def brute(rows):
    first, out = {}, []
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        lines = (text or "").split("\n")
        for at, pair in enumerate(zip(lines, lines[1:])):
            first.setdefault(pair, (i, at))
    for i, text in rows:
        lines = (text or "").split("\n")
        again = {at for at, pair in enumerate(zip(lines, lines[1:])) if i is not None and first[pair] != (i, at)}
        kept = [x for at, x in enumerate(lines) if at not in again and at - 1 not in again]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [2, 3, 7])
def test_every_short_passage_goes(spark, length):
    passage = [f"{'shared words ' * 15}{i}" for i in range(length)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(i % 4)] + passage + [f"end {i} {j}" for j in range(i % 3)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in without_passages(docs).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[3] for r in got) == 29 * length  # all but the first occurrence, however they are surrounded
    left = {line for r in got for line in r[1].split("\n")}
    assert left >= {line for _, text in rows for line in text.split("\n")}  # of every line one is left


def test_overlaps_and_awkward_rows(spark, awkward, nothing):
    rows = [(1, "a\nb\nc"), (2, "b\nc\nd"), (3, "c\nd\na\nb"), (4, "x\nx\nx\nx"), (5, "a\nd"), (None, "a\nb")]
    got = sorted((tuple(r) for r in without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute(rows)
    got = sorted((tuple(r) for r in without_passages(awkward).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert without_passages(nothing).count() == 0
