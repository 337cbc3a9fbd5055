import pytest
from pyspark.sql import functions as F

from panelkit.functions.columns import hash_uniform
from panelkit.operators import sampling


def _targets(spark, negatives, positives=5, unknown=3):
    values = [0] * negatives + [1] * positives + [None] * unknown
    return spark.createDataFrame([(i, 1, v) for i, v in enumerate(values)], "id int, ym int, target int")


@pytest.mark.parametrize("negatives,share", [(10, 0.25), (1000, 0.1), (777, 0.333), (10, 0.0), (10, 1.0), (0, 0.5)])
def test_exact_count(spark, negatives, share):
    df = _targets(spark, negatives)
    got = sampling.undersample_exact(df, share, 17)
    kept = got.filter("target = 0")
    assert kept.count() == int(negatives * share) and got.filter("target = 1").count() == 5
    assert got.filter("target is null").count() == 0
    ranked = df.filter("target = 0").orderBy(hash_uniform(17, "id", "ym"), "id").limit(int(negatives * share))
    assert {r["id"] for r in ranked.collect()} == {r["id"] for r in kept.collect()}


def test_exact_sample_depends_on_seed_only(spark):
    df = _targets(spark, 200)
    one = {r["id"] for r in sampling.undersample_exact(df, 0.2, 1).collect()}
    again = {r["id"] for r in sampling.undersample_exact(df.repartition(5), 0.2, 1).collect()}
    other = {r["id"] for r in sampling.undersample_exact(df, 0.2, 2).collect()}
    assert one == again and one != other


def test_bernoulli_keeps_leavers(spark):
    df = spark.createDataFrame(
        [(i, 1, ["BAJA+1", "BAJA+2", "CONTINUA", None][i % 4]) for i in range(400)], "id int, ym int, label string"
    )
    got = sampling.undersample_bernoulli(df, 0.1, 5)
    counts = {r["label"]: r["count"] for r in got.groupBy("label").count().collect()}
    assert counts["BAJA+1"] == counts["BAJA+2"] == 100
    assert 0 < counts["CONTINUA"] < 40 and 0 < counts[None] < 40


def test_canaries_come_first(spark):
    df = spark.createDataFrame([(i, 1, "x", 1.0, 2.0, 3.0, 4.0) for i in range(2000)], "id int, ym int, label string, a double, b double, c double, d double")
    got = sampling.add_canaries(df)
    assert got.columns == ["canarito_000", "canarito_001", *df.columns]
    stats = got.agg(F.avg("canarito_000"), F.stddev("canarito_000"), F.corr("canarito_000", "canarito_001")).first()
    assert abs(stats[0]) < 0.1 and abs(stats[1] - 1) < 0.1 and abs(stats[2]) < 0.1
    uniform = sampling.add_canaries(df, n=2, kind="uniform", reproducible=False)
    assert uniform.columns[:2] == ["canarito_1", "canarito_2"]
    assert uniform.filter("canarito_1 < 0 or canarito_1 >= 1").count() == 0


def test_canary_count():
    assert sampling.canary_count(10, 0.5) == 5 and sampling.canary_count(1, 0.1) == 1
    assert sampling.canary_count(77, 5 / 77) == 4 and sampling.canary_count(100, 5 / 100) == 5


def test_shuffled_keeps_all_rows(spark):
    df = _targets(spark, 50)
    ids = [r["id"] for r in sampling.shuffled(df, 3).collect()]
    assert sorted(ids) == list(range(58)) and ids != sorted(ids)


def test_class_weights(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "label string")
    got = sorted((r["label"] or "", r["weight"]) for r in sampling.class_weights(df).collect() if r["label"])
    assert got == [("a", 0.5), ("a", 0.5), ("b", 1.0)]
