import pytest
from pyspark.sql import functions as F

from winnow.functions.numbers import nan_to_null
from winnow.operators import combine, flags, masks, prep
from winnow.operators.rules import INVALID, Rule, match_rules, match_tokens, rule_masks, rules_from

NAN = float("nan")


def test_missing_number_fails_missing_list_passes(spark, rows):
    df = spark.createDataFrame(
        [(0, 5.0, ["C", " N "], [5, 6]), (1, NAN, None, None), (2, None, [], [9]), (3, 50.0, ["Xx"], [6])],
        "id int, x double, chars array<string>, rings array<int>",
    )
    out = flags.range_flags(df, {"x": (1, 10)}, allowed={"chars": ["C", "N"]}, elements={"rings": (None, 8)})
    assert rows(out, "id", "x_pass", "chars_pass", "rings_pass") == [
        (0, True, True, True), (1, False, True, True), (2, False, True, False), (3, False, False, True),
    ]
    one_sided = flags.range_flags(df, {"x": (1, "inf")}).withColumnRenamed("x_pass", "p")
    assert rows(one_sided, "id", "p") == [(0, True), (1, False), (2, False), (3, True)]
    assert rows(flags.range_flags(df, {"x": (None, None)}), "x_pass") == [(True,)] * 4
    assert flags.drop_failing(out, exempt=["chars_pass", "rings_pass"]).count() == 1


def test_gates(spark, rows):
    df = spark.createDataFrame([(0, True), (1, False), (2, None)], "id int, is_neutral boolean")
    assert rows(flags.range_flags(df, {}, gates={"is_neutral": False}), "is_neutral_pass") == [(False,), (False,), (True,)]
    assert rows(flags.range_flags(df, {}, gates={"is_neutral": True}), "is_neutral_pass") == [(True,)] * 3
    sev = flags.severity_flags(spark.createDataFrame([(0,), (3,)], "severity int"), "severity", [1, 4])
    assert rows(sev, "pass_1", "pass_4", "pass") == [(False, True, False), (True, True, True)]
    zero = flags.zero_gate(spark.createDataFrame([(0,), (2,), (None,)], "d int"), "d")
    assert rows(zero, "pass") == [(False,), (False,), (True,)]
    halogens = spark.createDataFrame([(6, 3, 3), (7, 0, 0)], "n_F int, n_Br int, n_Cl int")
    assert rows(halogens.select(flags.count_gate(flags.HALOGEN_LIMITS))) == [(False,), (True,)]


def test_missing_score_passes(spark, rows):
    one = spark.createDataFrame([("a", 2.0), ("b", NAN), ("c", 8.0)], "smiles string, sa_score double")
    assert rows(flags.score_filter(one, {"sa_score": (0, 5)}), "smiles") == [("a",), ("b",)]
    two = spark.createDataFrame(
        [("a", 2.0, 0.9), ("b", 6.0, 0.9), ("c", 3.0, 0.3), ("d", 4.0, 0.6)], "smiles string, sa_score double, ra_score double"
    )
    kept = flags.score_filter(two, {"sa_score": (0, 5), "ra_score": (0.5, "inf"), "fragment_score": (0, "inf")})
    assert rows(kept, "smiles") == [("a",), ("d",)]
    empty = spark.createDataFrame([("a", None), ("b", None)], "smiles string, ra_score double")
    assert flags.score_filter(empty, {"ra_score": (0.5, 1)}).count() == 2
    assert nan_to_null(one).filter("sa_score is null").count() == 1


MASK_KEYS = ["smiles", "model_name", "mol_idx"]


def mask_fixture(spark):
    base = spark.createDataFrame([(f"C{i}", "m", i) for i in range(4)], "smiles string, model_name string, mol_idx int")
    a = base.withColumn("pass", F.col("mol_idx").isin(0, 1, 2))
    b = base.withColumn("pass", F.col("mol_idx").isin(1, 2, 3))
    return base, {"a": a, "b": b}


def test_mask_combination_equals_intersection(spark, rows):
    base, by_name = mask_fixture(spark)
    passed, failed = combine.combine_masks(base, by_name, MASK_KEYS)
    assert rows(passed, "mol_idx") == [(1,), (2,)]
    assert rows(failed, "mol_idx", "pass_a", "pass_b") == [(0, True, False), (3, False, True)]
    survivors = [m.filter("pass") for m in by_name.values()]
    assert rows(combine.intersect_survivors(base, survivors, MASK_KEYS)) == rows(passed)
    assert rows(combine.split_failed(base, passed, MASK_KEYS)) == rows(failed.select(*MASK_KEYS))
    any_passed, _ = combine.combine_masks(base, by_name, MASK_KEYS, mode="any")
    assert any_passed.count() == 4


def test_mask_edge_cases(spark, rows):
    base, by_name = mask_fixture(spark)
    assert combine.combine_masks(base, {}, MASK_KEYS)[0].isEmpty()
    assert combine.combine_masks(base, {**by_name, "c": None}, MASK_KEYS)[0].isEmpty()
    twice = by_name["a"].withColumn("ord", F.lit(1)).union(
        base.filter("mol_idx = 0").withColumn("pass", F.lit(False)).withColumn("ord", F.lit(2))
    )
    table = combine.mask_table(base, {"a": twice}, MASK_KEYS, "ord")
    assert rows(table, "mol_idx", "pass_a") == [(0, False), (1, True), (2, True), (3, False)]


def test_rule_contract(spark, rows):
    rules = [Rule("A", "has N", "N"), Rule("A", "has O", "O", literal=True), Rule("B", "has S", "S+", anchor="S")]
    df = spark.createDataFrame([("CCO", 0), ("CNSO", 1), ("CC", 2), (None, 3)], "smiles string, id int")
    out = rule_masks(match_rules(df, "smiles", rules), ["A", "B"])
    assert rows(out, "id", "pass_A", "pass_B", "pass", "pass_any", "reasons_A") == [
        (0, False, True, False, True, "has O"),
        (1, False, False, False, False, "has N;has O"),
        (2, True, True, True, True, ""),
        (3, False, False, False, False, INVALID),
    ]
    assert rows(masks.failure_counts(out, ["A", "B"])) == [("A", 3, 4, 75.0), ("B", 2, 4, 50.0)]
    reasons = masks.reason_counts(out, ["A", "B"])
    assert ("A", "has O", 2) in rows(reasons) and ("B", INVALID, 1) in rows(reasons)
    summary = masks.rule_summary(reasons, masks.failure_counts(out, ["A", "B"])).filter("rule_set = 'A'").first()
    assert (summary.top_reason_1, summary.top_reason_1_count, summary.unique_reasons) == ("has O", 2, 3)


def test_many_rules_and_tokens(spark, rows):
    df = spark.createDataFrame([(0, "w7 w1203 w7")], "id int, text string")
    rules = [Rule("R", f"d{i}", f"\\bw{i}\\b") for i in range(1300)]
    hits = match_rules(df, "text", rules).selectExpr("transform(hits, h -> h.description) as d").first().d
    assert hits == ["d7", "d1203"]
    table = spark.createDataFrame([("R", f"d{i}", f"w{i}") for i in range(1300)], "rule_set string, description string, token string")
    found = match_tokens(df.select("id", F.split("text", " ").alias("t")), "id", "t", table)
    assert rows(found, "description") == [("d1203",), ("d7",)]
    many = rules_from(spark.range(20_001).selectExpr("'s' as rule_set_name", "'d' as description", "'p' as smarts"))
    assert len(many) == 20_001 and set(many) == {Rule("s", "d", "p")}


def test_ratio_stats(spark):
    df = spark.createDataFrame(
        [("m", True, True, True, True), ("m", True, True, True, True), ("m", False, True, True, False), ("m", False, False, False, False)],
        "model_name string, pass boolean, pass_any boolean, pass_RulesetA boolean, pass_RulesetB boolean",
    )
    row = masks.mask_stats(df, "model_name", ["RulesetA", "RulesetB"]).first()
    assert (row.num_mol, row.all_banned_ratio, row.any_banned_ratio) == (4, 0.5, 0.25)
    assert (row.RulesetA_banned_ratio, row.RulesetB_banned_ratio) == (0.25, 0.5)
    back = masks.counts_from_ratios(spark.createDataFrame([(4, 0.5), (7, None)], "num_mol int, r double"), ["r"], "r")
    assert [(r.r_failed, r.passed, r.pass_rate) for r in back.orderBy("num_mol").collect()] == [(2, 2, 50.0), (0, 7, 100.0)]


def test_pose_mask_numbers(spark):
    df = spark.createDataFrame(
        [(0, "a", True, True, True), (1, "a", True, True, True), (2, "a", True, False, False), (3, "b", True, True, True), (4, "b", False, None, False)],
        "mol_idx int, model_name string, pass_search_box boolean, pass_pose_quality boolean, pass boolean",
    )
    got = {r["filter"]: (r.passed, r.total, r.pass_rate) for r in masks.pose_mask_summary(df, ["pass_search_box", "pass_pose_quality"]).collect()}
    assert got["all"] == (3, 5, 60.0) and got["search_box"] == (4, 5, 80.0) and got["pose_quality"] == (3, 4, 75.0)


def test_first_failure_and_metrics(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 9), ("c", None), ("d", 20)], "s string, n int")
    checked = prep.first_failure(df, [(F.col("n") > 5, "big", "filters"), (F.col("n") > 15, "huge", "filters")])
    assert rows(checked, "s", "reason") == [("a", None), ("a", None), ("b", "big"), ("c", None), ("d", "big")]
    m = prep.prep_metrics(checked, ["s"]).first()
    assert (m.rows_in, m.passed, m.failed, m.dedup_removed, m.failures_by_reason) == (5, 3, 2, 1, '{"big":2}')


def test_lookup_and_policies(spark, rows):
    left = spark.createDataFrame([("a",), ("a",), ("x",)], "smiles string")
    right = spark.createDataFrame([("a", 1, 2.5, 0), ("a", 0, 9.0, 1)], "smiles string, solved int, search_time double, ord int")
    out = combine.lookup(left, right, "smiles", {"solved": 0, "search_time": 0.0}, "ord")
    assert rows(out) == [("a", 1, 2.5), ("a", 1, 2.5), ("x", 0, 0.0)]
    flagged = spark.createDataFrame([(None, True), (None, False), (False, True)], "f boolean, seen boolean")
    assert rows(flagged.select(combine.fail_policy(F.col("f"), F.col("seen")))) == [(False,), (False,), (True,)]
    filled = combine.backfill(
        spark.createDataFrame([(1, True), (2, None)], "k int, f boolean"), spark.createDataFrame([(1, False), (3, None)], "k int, f boolean"), ["k"], ["f"], "full"
    )
    assert rows(filled) == [(1, False), (2, False), (3, False)]
