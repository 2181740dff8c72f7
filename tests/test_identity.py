import random

import pytest

from pyspark.sql import functions as F

from winnow.operators import identity, ranks


def test_index_by_first_appearance(spark, rows):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None)], "ord int, model_name string")
    out = identity.assign_index(df, "model_name", "ord")
    assert rows(out, "ord", "candidate_idx") == [
        (0, "LP-0001-00001"), (1, "LP-0002-00001"), (2, "LP-0001-00002"), (3, "LP-0003-00001"),
    ]
    alone = identity.assign_index(df.drop("model_name"), None, "ord")
    assert rows(alone, "candidate_idx")[-1] == ("LP-0001-00004",)
    mapped = identity.group_map(out, "model_name", "candidate_idx", "ord")
    assert ("a", "LP-0002-00001", 2) in rows(mapped)


def test_cut_ranks_equal_plain_ranks(spark):
    rng = random.Random(5)
    data = [(i, "hot" if i % 3 else f"g{i % 7}", rng.choice([None, rng.random(), 0.5]), f"k{rng.random()}") for i in range(4000)]
    df = spark.createDataFrame(data, "id int, g string, x double, s string")
    for order in (["x", "id"], ["s"], ["id"]):
        a = ranks.row_numbers(df, ["g"], order, "rank", in_task=10**9).select("id", "rank")
        b = ranks.row_numbers(df, ["g"], order, "rank", in_task=0).select("id", "rank")
        assert a.exceptAll(b).isEmpty() and b.count() == 4000


def test_cut_quantiles_equal_percentile(spark):
    rng = random.Random(6)
    data = [("hot" if i % 3 else f"g{i % 5}", rng.choice([rng.gauss(0, 9), 1.0, float("nan")]), i % 11) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x double, y int")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    for overall in (False, True):
        plain = ranks.quantiles(df, ["x", "y"], probs, "g", overall, in_task=10**9).toPandas()
        cut = ranks.quantiles(df, ["x", "y"], probs, "g", overall, in_task=0).toPandas()
        key = ["g", "metric"]
        plain, cut = (d.sort_values(key).reset_index(drop=True)[[*key, *probs]] for d in (plain, cut))
        assert len(plain) == 2 * (6 + overall)
        assert ((plain[list(probs)] - cut[list(probs)]).abs() < 1e-9).all().all()
    exact = df.filter(~F.isnan("x")).agg(F.percentile("x", F.lit(0.1))).first()[0]
    got = ranks.quantiles(df, ["x"], probs, in_task=0).first()["b"]
    assert abs(exact - got) < 1e-9


def test_dedup_within_group(spark, rows):
    df = spark.createDataFrame(
        [(0, "CCO", "a"), (1, "CCO", "a"), (2, "CCO", "b"), (3, "CCN", "a")], "ord int, smiles string, model_name string"
    )
    kept, removed = identity.dedup(df, ["smiles", "model_name"], "ord", digest="smiles")
    assert rows(kept, "ord") == [(0,), (2,), (3,)]
    assert rows(removed, "ord") == [(1,)]
    last, _ = identity.dedup(df, ["smiles", "model_name"], "ord", keep="last")
    assert rows(last, "ord") == [(1,), (2,), (3,)]


def test_sampling_edges(spark, rows):
    df = spark.createDataFrame([(i, "a" if i < 5 else "b") for i in range(8)], "id int, g string")
    sample, short = identity.sample_per_group(df, ["g"], "id", 3)
    assert sample.count() == 6 and short.isEmpty()
    again, _ = identity.sample_per_group(df, ["g"], "id", 3)
    assert rows(sample) == rows(again)
    sample, short = identity.sample_per_group(df, ["g"], "id", 4)
    assert sample.count() == 7 and rows(short) == [("b", 4, 3)]
    everything, _ = identity.sample_per_group(df, ["g"], "id", None)
    assert everything.count() == 8
    large, _ = identity.sample_per_group(df, ["g"], "id", 2000)
    assert large.count() == 8


def test_first_n(spark, rows):
    df = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)], "id int, g string")
    assert rows(identity.head_per_group(df, ["g"], ["id"], 2), "id") == [(0,), (1,), (2,), (3,)]
    assert identity.head_per_group(df, [], ["id"], 3).count() == 3
    assert identity.head_per_group(df, ["g"], ["id"], 0).count() == 10
    assert identity.head_per_group(df, ["g"], ["id"], None).count() == 10


def test_columns(spark):
    df = spark.createDataFrame([("CCO", "m", 1.0, True)], "SMILES string, Name string, b double, b_pass boolean")
    named = identity.resolve_columns(df, {"smiles": ["smiles"], "model_name": ["model_name", "name"]})
    assert named.columns[:2] == ["smiles", "model_name"]
    wide = named.withColumn("a", F.lit(1)).withColumn("z_pass", F.lit(True))
    assert identity.order_columns(wide, ["smiles", "model_name"]).columns == ["smiles", "model_name", "a", "b", "b_pass", "z_pass"]
    assert not identity.has_many_groups(named, "model_name")


@pytest.mark.parametrize("margins", [(3.0, 12.0), (-4.0, -2.0), ()])
def test_sample_is_cut_below_a_threshold(spark, rows, margins, monkeypatch):
    import hashlib

    data = [(g, i, "x") for g, n in (("a", 900), ("b", 40), (None, 300), ("c", 3)) for i in range(n)]
    data = [(g, 10_000 * k + i, x) for k, (g, i, x) in enumerate(data)]
    df = spark.createDataFrame(data, "g string, id long, available string").repartition(4)
    sample, short = identity.sample_per_group(df, ["g"], "id", 30, seed=5, margins=margins)
    want = []
    for g in ("a", "b", None, "c"):
        own = sorted((hashlib.md5(f"5:{i}".encode()).hexdigest(), i) for h, i, _ in data if h == g)
        want += [(g, i, "x") for _, i in own[:30]]
    assert rows(sample) == sorted(want, key=repr)
    assert rows(short) == [("c", 30, 3)]
    everywhere, _ = identity.sample_per_group(df, [], "id", 100, seed=5, margins=margins)
    own = sorted((hashlib.md5(f"5:{i}".encode()).hexdigest(), i, g) for g, i, _ in data)
    assert rows(everywhere) == sorted(((g, i, "x") for _, i, g in own[:100]), key=repr)


def test_sample_shuffles_little_more_than_it_takes(spark, monkeypatch):
    taken = []
    plain = identity.written
    monkeypatch.setattr(identity, "written", lambda d, name: taken.append((name, t := plain(d, name))) or t)
    df = spark.range(200_000).selectExpr("id", "id % 3 as g")
    sample, _ = identity.sample_per_group(df, ["g"], "id", 2_000)
    assert sample.count() == 6_000
    assert sum(t.count() for name, t in taken if name == "sample") < 1.2 * 6_000
