from winnow.operators import stats


def test_every_value_is_listed_whatever_the_largest(spark):
    df = spark.createDataFrame([(150_000.0,), (-3.0,), (7.0,), (7.0,), (0.5,), (float("nan"),), (None,)], "x double")
    found = stats.discrete_histogram(df, "x")
    assert found.where("value >= 0").count() == 150_006
    assert {r.value: r["count"] for r in found.where("count > 0").collect()} == {-3: 1, 7: 2, 150_000: 1}
    assert stats.discrete_histogram(df.limit(0), "x").isEmpty()
