import hashlib

from winnow.llm.line_dedup import MEAN_LINES, PRIME, without_repeats


def chunks(text):
    lines, out, own, before = (text or "").split("\n"), [], [], 0
    for i, line in enumerate(lines):
        value = int(hashlib.md5(line.encode()).hexdigest()[:8], 16)
        own.append(line)
        if i == len(lines) - 1 or (value + 31 * before) % PRIME % MEAN_LINES == 0:
            out.append(own)
            own = []
        before = value
    return out


def brute(rows):
    seen, out = {}, []
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        for place, c in enumerate(chunks(text)):
            seen.setdefault(tuple(c), (i, place))
    for i, text in rows:
        parts = chunks(text)
        kept = [c for place, c in enumerate(parts) if i is None or len(c) < 2 or seen[tuple(c)] == (i, place)]
        out.append((i, "\n".join("\n".join(c) for c in kept), sum(map(len, parts)), sum(map(len, parts)) - sum(map(len, kept))))
    return sorted(out, key=repr)


def test_passages_that_many_documents_share(spark):
    passage = [f"shared line {i}" for i in range(12)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(i % 5)] + passage + [f"end {i}"] + passage * (i % 2))) for i in range(40)]
    rows.append((99, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in without_repeats(docs).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[3] for r in got) > 40 * 6  # the boundaries inside the passage do not depend on what stands before it


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = sorted((tuple(r) for r in without_repeats(awkward).collect()), key=repr)
    assert got == brute(rows)
    assert without_repeats(nothing).count() == 0
