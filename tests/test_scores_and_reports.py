import math

import pytest
from pyspark.sql import functions as F

from winnow.operators import best, fragments, stats
from winnow.operators.plugins import filter_named, register, with_calculator, with_model_score
from winnow.plans import report
from winnow.plans.cascade import Cascade, Stage
from winnow.sources import stages
from winnow.sources.stages import existing, latest_stage, manifest, read_runs, read_stage


def test_best_pose(spark, rows):
    df = spark.createDataFrame(
        [(0, "mol-A", "-7.0"), (1, "mol-A", "-8.0"), (2, "", "bad"), (3, "mol-B", None), (4, "mol-B", "-1"), (5, "mol-A", "-8.0")],
        "mol_idx int, source string, score string",
    )
    out = best.best_per(df, "source", "score", "mol_idx", renumber="n")
    assert rows(out, "source", "mol_idx", "n") == [("2", 2, 0), ("mol-A", 1, 1), ("mol-B", 4, 2)]


def test_two_tool_scores(spark, rows):
    poses = spark.createDataFrame(
        [("m1", "t1", -7.1, 0), ("m1", "t1", -8.4, 1), ("m1", "t2", -9.2, 0), ("m2", "t2", -5.0, 0), (None, "t2", -99.0, 0), ("m2", "t1", None, 3)],
        "name string, tool string, affinity double, ord int",
    )
    scores = best.best_by_tool(poses, "name", "tool", ["t1", "t2", "none"], "affinity", "ord")
    final = spark.createDataFrame([("m1",), ("m2",), ("m3",)], "name string")
    assert rows(best.with_tool_scores(final, scores, "name")) == [
        ("m1", -8.4, -9.2, None), ("m2", None, -5.0, None), ("m3", None, None, None),
    ]
    assert rows(best.best_scored(poses, "name", "affinity", "ord", ["affinity"])) == [("m1", -9.2), ("m2", -5.0)]


def test_fragment_model(spark, rows):
    df = spark.createDataFrame(
        [(0, ["a", "a", "b"], 1), (1, ["a"], 1), (2, ["b", "c"], 0), (3, ["a", "z"], None)], "id int, f array<string>, y int"
    )
    model = fragments.fit_fragments(df, "f", "y")
    got = {r.fragment: r for r in model.collect()}
    assert (got["a"].n_pos, got["a"].n_neg, got["c"].n_neg) == (2, 0, 1) and "z" not in got
    assert math.isclose(got["a"].present, math.log(3 / 1)) and math.isclose(got["a"].absent, math.log(1 / 2))
    assert math.isclose(got["a"].prior, math.log(3 / 4))
    base = sum(r.prior + r.absent for r in got.values())
    scored = {r.id: r for r in fragments.score_fragments(df, "id", "f", model).collect()}
    assert math.isclose(scored[3].score, base + got["a"].present - got["a"].absent) and scored[3].n_known == 1
    none = spark.createDataFrame([(9, [])], "id int, f array<string>")
    assert math.isclose(fragments.score_fragments(none, "id", "f", model).first().score, base)
    pos = spark.createDataFrame([(0, 0, "a"), (0, 0, "b"), (0, 1, "z")], "id int, p int, f string")
    c = {r.p: r.contribution for r in fragments.position_scores(pos, "id", "p", "f", model).collect()}
    assert math.isclose(c[0], got["a"].present + got["b"].present) and c[1] == 0.0


def test_count_term_and_fold(spark, rows):
    scores = {0: (1.0, -1.0), 1: (2.0, -2.0)}
    df = spark.createDataFrame([(0,), (1,), (7,)], "n int")
    assert rows(df.select(fragments.count_term(F.col("n"), scores))) == [(-1.0,), (1.0,), (1.0,)]
    ids = spark.createDataFrame([(0, -7, 2), (0, 1, 3), (0, 5, 1)], "id int, f long, c int")
    folded = fragments.fold_counts(ids, ["id"], "f", "c", 4)
    assert rows(folded) == [(0, 1, 6)]
    assert fragments.dense_counts(folded, "id", 4).first().counts == [0, 6, 0, 0]


def test_describe_single_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 3.0), ("b", None)], "g string, x double")
    got = {r.g: r for r in stats.describe(df, ["x"], "g", single_std=0.0).collect()}
    assert got["a"].median == 2.5 and got["b"].std == 0.0 and got["(all)"].n == 3 and got["(all)"].median == 3.0


def test_histograms(spark, rows):
    df = spark.createDataFrame([(0.0,), (0.0,), (9.0,), (10.0,), (None,)], "x double")
    assert [r["count"] for r in stats.histogram(df, "x", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 2]
    assert stats.discrete_histogram(df, "x").count() == 16
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert stats.histogram(same, "x", 3).orderBy("bin").first()["count"] == 2
    assert stats.histogram(df.limit(0), "x").isEmpty()


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([("a", 50.0 + math.sin(i) * 10) for i in range(200)], "g string, x double")
    pts = stats.density(df, "x", "g", 80).orderBy("point").collect()
    area = sum((q.x - p.x) * (p.density + q.density) / 2 for p, q in zip(pts, pts[1:]))
    assert abs(area - 1) < 0.01


def cascade():
    return Cascade(
        [Stage("one", F.col("x") > 1), Stage("two", F.col("x") > 3), Stage("skip", F.lit(False), enabled=False), Stage("score", filters=False)]
    )


def cascade_rows(spark):
    return spark.createDataFrame([(i, "ab"[i % 2], float(i)) for i in range(6)] + [(6, "a", None)], "id int, g string, x double")


def test_cascade_reports(spark, rows):
    done = cascade().annotate(cascade_rows(spark))
    assert rows(done, "id", "failed_stage") == [
        (0, "one"), (1, "one"), (2, "two"), (3, "two"), (4, None), (5, None), (6, "one"),
    ]
    stages = ["one", "two"]
    f = report.funnel(done, stages, "g")
    total = [r["count"] for r in f.filter("g = '(all)'").orderBy("position").collect()]
    assert total == [7, 4, 2] and total == sorted(total, reverse=True)
    links = {(r.source, r.target): r.value for r in report.flow_links(report.funnel(done, stages)).collect()}
    assert links == {("Initial", "one"): 4, ("Initial", "Lost (one)"): 3, ("one", "two"): 2, ("one", "Lost (two)"): 2}
    card = report.scorecard(done, stages, "g").collect()
    assert all(r.initial == r.final + r.lost_one + r.lost_two for r in card)
    r = report.retention(done).first()
    assert (r.initial, r.final, r.rate_text) == (7, 2, "28.6%")
    assert rows(report.stage_stats(done, stages)) == [("one", 4, 3, 7), ("two", 2, 2, 4)]
    empty = report.retention(done.limit(0)).first()
    assert (empty.initial, empty.rate) == (0, 0.0)


def test_cascade_through_the_stage_table(spark, rows, tmp_path):
    path = str(tmp_path / "stages")
    out = cascade().run_to_table(cascade_rows(spark), path, "r1", ["id"])
    assert rows(out, "id") == [(4,), (5,)] == rows(cascade().survivors(cascade_rows(spark)), "id")
    table = read_runs(spark, path)
    assert table.filter("outcome = 'failed'").count() == 5
    last = latest_stage(table.filter("outcome = 'survivor'"), skip=["score"])
    assert last.select("stage").distinct().first()[0] == "two" and last.count() == 2
    nobody = Cascade([Stage("none", F.lit(False), ends_run=True), Stage("later", F.lit(True))])
    nobody.run_to_table(cascade_rows(spark), path, "r2", ["id"])
    order = ["input", "none", "later"]
    assert existing(spark, path, "r2", order).isEmpty()
    assert existing(spark, path, "r2", order, fallback=True).count() == 7
    assert existing(spark, path, "r3", order) is None


def test_an_interrupted_run_is_taken_up_again(spark, rows, tmp_path, monkeypatch):
    path, made = str(tmp_path / "stages"), []

    def second(df):
        made.append("second")
        return df.filter("x > 1")

    def chain(limit=0):
        return Cascade([Stage("first", F.col("x") > limit), Stage("second", apply=second), Stage("third", F.col("x") < 9)])

    df = spark.createDataFrame([(i, i % 10) for i in range(40)], "id int, x int")
    plain = stages.commit_stage

    def dies(spark, path, run_id, stage, rank, digest):
        if stage == "second":
            raise KeyboardInterrupt  # after the rows of the stage, before its commit
        plain(spark, path, run_id, stage, rank, digest)

    monkeypatch.setattr("winnow.plans.cascade.commit_stage", dies)
    with pytest.raises(KeyboardInterrupt):
        chain().run_to_table(df, path, "r", ["id"])
    order = ["input", "first", "second", "third"]
    # rows of the second stage lie there, but no reader sees them
    assert read_stage(spark, path, "r", "second").count() == 32
    assert existing(spark, path, "r", order).count() == 36
    assert rows(read_runs(spark, path).select("stage").distinct()) == [("first",), ("input",)]
    monkeypatch.setattr("winnow.plans.cascade.commit_stage", plain)
    written = []
    keep = stages.write_stage
    monkeypatch.setattr("winnow.plans.cascade.write_stage", lambda d, p, r, s, k, o: written.append((s, o)) or keep(d, p, r, s, k, o))
    out = chain().run_to_table(df, path, "r", ["id"], resume=True)
    assert written == [("second", "survivor"), ("second", "failed"), ("third", "survivor"), ("third", "failed")]
    assert rows(out, "id") == rows(chain().survivors(df), "id")
    done = manifest(spark, path)
    assert rows(done, "stage", "stage_rank", "rows", "failed_rows") == [("first", 1, 36, 4), ("input", 0, 40, 0), ("second", 2, 32, 4), ("third", 3, 28, 4)]
    written.clear()
    chain().run_to_table(df, path, "r", ["id"], resume=True)
    assert written == []
    # another condition makes its stage and all later ones anew; another input everything
    chain(limit=2).run_to_table(df, path, "r", ["id"], resume=True)
    assert [s for s, o in written if o == "survivor"] == ["first", "second", "third"]
    written.clear()
    chain(limit=2).run_to_table(df, path, "r", ["id"], resume=True, input_version="2")
    assert [s for s, o in written if o == "survivor"] == ["input", "first", "second", "third"]
    # a stage that is written again is not seen until it is committed
    keep(df, path, "r", "third", 3, "survivor")
    assert existing(spark, path, "r", order).count() == read_stage(spark, path, "r", "second").count()
    assert manifest(spark, str(tmp_path / "none")).count() == 0


def test_plugins(spark, rows):
    def fragile(state, batch):
        if (batch["x"] == 3).any():
            raise ValueError("bad row")
        return (batch[["x"]] * state).rename(columns={"x": "y"})

    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    out = with_calculator(df, fragile, "y double", start=lambda: 2.0)
    assert [(r.x, r.y) for r in out.orderBy("x").collect()] == [(1.0, 2.0), (3.0, None), (5.0, 10.0)]
    vectors = spark.createDataFrame([(1, [1, 2]), (2, None)], "id int, counts array<int>")
    assert rows(with_model_score(vectors, "counts", lambda m: m.sum(axis=1))) == [(1, [1, 2], 3.0), (2, None, None)]
    assert with_model_score(vectors, "counts", None).filter("model_score is null").count() == 2
    register("all", lambda d, conf: d)
    assert filter_named("all")(df, {}).count() == 3
    with pytest.raises(ValueError):
        filter_named("unknown")


def test_frequent_fragments_are_looked_up_where_rows_lie(spark):
    """The scores do not depend on how many fragments are sent; only entries of the others are shuffled by fragment."""
    data = [(i, ["and", "the", f"w{i % 7}", *(["and"] if i % 2 else [])], [1, 0, None][i % 3]) for i in range(60)]
    df = spark.createDataFrame([*data, (60, [], 1), (61, None, 0), (62, ["none"], None)], "id int, f array<string>, y int")
    model = fragments.fit_fragments(df, "f", "y")
    places = df.select("id", F.posexplode("f").alias("p", "t"))

    def close(a, b):
        return len(a) == len(b) and all(x[:-1] == y[:-1] and math.isclose(x[-1], y[-1], abs_tol=1e-9) for x, y in zip(a, b, strict=True))

    def scored(sent, **how):
        return sorted((r.id, r.n_known, r.score) for r in fragments.score_fragments(df, "id", "f", model, sent=sent, **how).collect())

    def placed(sent):
        return sorted((r.id, r.p, r.contribution) for r in fragments.position_scores(places, "id", "p", "t", model, sent=sent).collect())

    for sent in (0, 2, 5):
        assert close(scored(sent), scored(100)) and close(scored(sent, only_present=True), scored(100, only_present=True)) and close(placed(sent), placed(100))
    known = {r.fragment: r for r in model.collect()}
    base = sum(r.prior + r.absent for r in known.values())
    for i, n, score in scored(2):
        own = [known[t] for t in set((df.collect()[i].f or [])) if t in known]
        assert n == len(own) and math.isclose(score, base + sum(r.present - r.absent for r in own), abs_tol=1e-9)
    assert all(math.isclose(c, known["and"].present) for i, p, c in placed(2) if p == 0 and i < 60)
