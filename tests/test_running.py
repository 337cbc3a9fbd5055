import random

import pytest
from pyspark.sql import functions as F

from panelkit.functions.running import at_ranks, down, running


def _check(spark, rows, group):
    df = spark.createDataFrame(rows, "g int, id int, score double, v int")
    out = running(df, [down("score"), F.col("id")], group, {"acc": F.col("v").cast("bigint")})
    cut = running(df, [down("score"), F.col("id")], group, {"acc": F.col("v").cast("bigint")}, bucket_rows=20, steps=8)
    got = {(r["g"], r["id"]): (r["rank"], r["acc"]) for r in out.collect()}
    assert got == {(r["g"], r["id"]): (r["rank"], r["acc"]) for r in cut.collect()}
    want = {}
    for g in {r[0] for r in rows} if group else {None}:
        acc = 0
        mine = sorted((r for r in rows if g is None or r[0] == g), key=lambda r: (-r[2], r[1]))
        for k, r in enumerate(mine, 1):
            acc += r[3]
            want[r[0], r[1]] = (k, acc)
    assert got == want


@pytest.fixture(autouse=True, params=["one range", "many ranges", "coalesced ranges"])
def ranges(spark, request):
    """Small data would all land in one range; keep the shuffle's partitions apart as well."""
    settings = {
        "one range": {},
        "many ranges": {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
        "coalesced ranges": {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    }[request.param]
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_several_ranges_are_used(spark, ranges):
    df = spark.range(5000).select(F.col("id"), F.lit(1).alias("score"))
    placed = df.repartitionByRange("score", "id").select(F.spark_partition_id().alias("p")).groupBy("p").count()
    n = placed.count()
    assert n == 1 if ranges == "one range" else n > 1


def test_groups(spark):
    rng = random.Random(1)
    _check(spark, [(g, i, rng.random(), rng.randint(-2, 78)) for g in range(4) for i in range(300)], ["g"])


def test_most_rows_share_one_score(spark):
    rows = [(0, i, 0.5 if i % 3 else i / 1000, 1) for i in range(900)]
    _check(spark, rows, [])


def test_one_group_holds_most_rows(spark):
    rows = [(0 if i < 800 else i, i, (i * 7919 % 1000) / 1000, 2) for i in range(820)]
    _check(spark, rows, ["g"])


def test_no_single_partition_over_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("score"))
    out = running(df, [F.col("score"), F.col("id")])
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_null_is_a_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 7), (1, 1, 1), (1, 2, 2)], "g int, id int, v int")
    out = running(df, [F.col("id")], ["g"], {"s": F.col("v")}).collect()
    assert sorted((str(r["g"]), r["id"], r["rank"], r["s"]) for r in out) == [("1", 1, 1, 1), ("1", 2, 2, 3), ("None", 1, 1, 5), ("None", 2, 2, 12)]


VALUES = {
    "double": [None, float("nan"), float("-inf"), float("inf"), -1.7e308, 1.7e308, 5e-324, 0.0, -0.25, 1e-9, 3.5, 3.5, 1e17],
    "long": [None, -(2**63), 2**63 - 1, 2**63 - 2, 0, 1, 2, 2, 2**53, 2**53 + 1, -5],
    "string": [None, "", "a", "ab", "abcdefgh", "abcdefgi", "z", "ü", "\U0001f600", "a"],
    "date": ["1900-01-01", None, "2024-02-29", "2024-02-29"],
    "timestamp": ["1900-01-01 00:00:00", None, "2024-02-29 01:02:03", "2024-02-29 01:02:04"],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("falling", [False, True])
def test_buckets_keep_the_order_of_any_type(spark, kind, falling, ranges):
    if ranges != "one range":
        pytest.skip("the shuffle's partitions don't matter here")
    given = VALUES[kind] * 3
    text = spark.createDataFrame(list(enumerate(given)), f"id int, v {kind if kind in ('double', 'long') else 'string'}")
    df = text.select("id", F.col("v").cast(kind).alias("v"))
    expected = [r.id for r in df.orderBy(F.col("v").desc() if falling else F.col("v"), "id").collect()]
    out = running(df, [down("v") if falling else F.col("v"), F.col("id")], bucket_rows=2, steps=64)
    assert [r.id for r in out.orderBy("rank").collect()] == expected


def test_rows_move_once(spark):
    """One exchange of the rows after they were settled; offsets come from a small table."""
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("score"), F.lit(1).alias("v"))
    plan = running(df, [down("score"), F.col("id")], sums={"s": F.col("v")}, bucket_rows=500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan and "SinglePartition" not in plan


def test_wanted_ranks(spark):
    rng = random.Random(4)
    rows = [(g, i, rng.choice([0.5, rng.random()]), rng.randint(-2, 78)) for g in range(3) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, id int, score double, v int")
    every = running(df, [down("score"), F.col("id")], ["g"], {"acc": F.col("v")}).collect()
    wanted = [0, 1, 77, 200, 399, 400, 401]
    some = at_ranks(df, [down("score"), F.col("id")], wanted, ["g"], {"acc": F.col("v")}, bucket_rows=10, steps=16)
    assert sorted(some.collect()) == sorted(r for r in every if r["rank"] in wanted)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert running(df, [F.col("id")], sums={"s": F.col("v")}).collect() == []
    assert at_ranks(df, [F.col("id")], [1]).collect() == []
