"""Set metrics over blocks, ranges of any type, and tables combined on missing keys."""

import random

import pytest
from pyspark.errors import PySparkException

from winnow.operators import combine, fingerprint as fp, ranks
from winnow.operators.fragments import fit_fragments
from winnow.operators.plugins import with_calculator
from winnow.operators.rules import match_literals

BITS = 24


def sets(n, seed):
    random.seed(seed)
    base = [random.sample(range(BITS), 9) for _ in range(5)]
    return [sorted(set(random.choice(base)) ^ set(random.sample(range(BITS), random.randint(0, 4)))) or [0] for _ in range(n)]


def tanimoto(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_set_metrics_use_every_row(spark, block_rows):
    groups = {"hot": sets(90, 1), "few": sets(5, 2), "one": sets(1, 3), None: sets(12, 4)}
    rows = [(g, 1000 * i + j, b) for i, (g, own) in enumerate(groups.items()) for j, b in enumerate(own)]
    df = spark.createDataFrame(rows, "g string, id long, bits array<int>")
    divs = {r.g: r for r in fp.int_div(df, "g", "id", "bits", BITS, block_rows).collect()}
    cover = {r.g: r for r in fp.sphere_exclusion(df, "g", "id", "bits", BITS, 0.5, block_rows).collect()}
    profile = {(r.g, r.id): r for r in fp.tanimoto_profile(df, "g", "id", "bits", BITS, block_rows).collect()}
    assert len(profile) == len(rows) and set(divs) == set(cover) == set(groups)
    for i, (g, own) in enumerate(groups.items()):
        sim = [[tanimoto(a, b) for b in own] for a in own]
        flat = [x for r in sim for x in r]
        assert abs(divs[g].int_div1 - (1 - sum(flat) / len(flat))) < 1e-9 and divs[g].n == len(own)
        assert abs(divs[g].int_div2 - (1 - (sum(x * x for x in flat) / len(flat)) ** 0.5)) < 1e-9
        picks = []
        for j in range(len(own)):
            if all(1 - sim[j][k] > 0.5 + 1e-12 for k in picks):
                picks.append(j)
        assert (cover[g].n, cover[g].picks) == (len(own), len(picks))
        for j in range(len(own)):
            others = [x for k, x in enumerate(sim[j]) if k != j]
            got = profile[g, 1000 * i + j]
            if not others:
                assert got.mean_similarity is None and got.max_similarity is None
            else:
                assert abs(got.mean_similarity - sum(others) / len(others)) < 1e-9 and abs(got.max_similarity - max(others)) < 1e-9


def test_row_numbers_of_any_type(spark):
    rows = [(i % 3, f"LP-0001-{i:05d}", (i * 7 % 50, str(i))) for i in range(200)] + [(0, None, None)]
    df = spark.createDataFrame(rows, "g int, name string, pair struct<a:int,b:string>")
    for order in (["name"], ["pair"], ["pair", "name"]):
        plain = ranks.row_numbers(df, ["g"], order, in_task=10**9).collect()
        cut = ranks.row_numbers(df, ["g"], order, in_task=0).collect()
        assert sorted(map(repr, plain)) == sorted(map(repr, cut))
    cut = df.repartitionByRange(8, "name").selectExpr("spark_partition_id() as p").distinct().count()
    assert cut > 4  # a common prefix does not put all rows into one range


def test_survivors_and_failures_make_up_the_input(spark):
    nan = float("nan")
    rows = [(k, x, i) for i, (k, x) in enumerate([("a", 1.0), (None, 1.0), ("a", nan), (None, None), ("b", nan), ("b", None), (None, 1.0)])]
    df = spark.createDataFrame(rows, "k string, x double, i int")
    passed = df.filter("i in (1, 2, 3)")
    failed = {r.i for r in combine.split_failed(df, passed, ["k", "x"]).collect()}
    kept = {r.i for r in combine.intersect_survivors(df, [passed, df], ["k", "x"]).collect()}
    assert kept == {1, 2, 3, 6} and failed == {0, 4, 5}
    mask = df.selectExpr("k", "x", "i >= 2 as pass", "i as ord")
    table = {r.i: r.pass_m for r in combine.mask_table(df, {"m": mask}, ["k", "x"], "ord").collect()}
    assert table == {0: False, 1: True, 2: True, 3: True, 4: True, 5: True, 6: True}
    filled = combine.backfill(df, df.selectExpr("k", "x", "true as f").filter("k is null").distinct(), ["k", "x"], ["f"])
    assert {r.i for r in filled.filter("f").collect()} == {1, 3, 6}
    with pytest.raises(PySparkException, match="twice and no order"):
        combine.mask_table(df, {"m": mask.drop("ord")}, ["k", "x"]).collect()


def test_short_circuit_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 0), (None, 9)], "k int, v int")
    out = combine.short_circuit(df, ["k"], df.v > 3, lambda d: d.selectExpr("*", "v < 8 as ok"), "ok")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, 5, True), (1, 5, True), (2, 0, False), (None, 9, False)], key=repr)


def test_literal_rules_of_any_number(spark):
    rules = spark.createDataFrame([("s", "d1", "red"), ("s", "d2", "a"), ("t", "d3", "widget"), ("t", "d4", ""), ("t", "d5", None)], "rule_set_name string, description string, smarts string")
    df = spark.createDataFrame([(1, "small red widget"), (2, "blue"), (3, None), (4, "wid")], "id int, name string")
    got = sorted((r.id, r.description) for r in match_literals(df, "id", "name", rules).collect())
    assert got == [(1, "d1"), (1, "d2"), (1, "d3")]


def test_calculator_tells_what_it_raised(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")

    def calculate(state, batch):
        if (batch["x"] == 2).any():
            raise ValueError("two")
        return batch.assign(y=batch["x"] * 10.0)

    rows = {r.x: r for r in with_calculator(df, calculate, "y double", error="why").collect()}
    assert (rows[1].y, rows[1].why, rows[2].y, rows[2].why) == (10.0, None, None, "ValueError: two")
    model = fit_fragments(spark.createDataFrame([(1, ["a"]), (0, ["b"])], "label int, f array<string>"), "f", "label")
    assert model.count() == 2


def test_a_calculator_gets_bounded_batches(spark):
    """300 rows of 100,000 characters are 30 MB; at most 4 MB are handed on, and other columns as they are."""
    import pandas as pd
    from pyspark.sql import functions as F

    df = spark.range(300, numPartitions=1).select("id", F.repeat(F.lit("x"), 100_000).alias("text"), F.current_timestamp().alias("at"), F.map_from_arrays(F.array(F.lit("k")), F.array("id")).alias("m"))
    calculate = lambda _, batch: pd.DataFrame({"n": [len(batch)] * len(batch), "size": batch["text"].str.len()})
    rows = with_calculator(df, calculate, "n long, size long", inputs=["text"]).select("id", "n", "size", "m", "at").collect()
    assert sorted(r.id for r in rows) == list(range(300)) and {r.size for r in rows} == {100_000}
    assert max(r.n for r in rows) <= 40 and all(r.m == {"k": r.id} for r in rows)
    wide = with_calculator(df, lambda _, b: pd.DataFrame({"k": [m["k"] for m in b["m"]], "zone": [str(x.tz) for x in b["at"]]}), "k long, zone string")
    assert all(r.k == r.id and r.zone == "None" for r in wide.drop("text").collect())
