import math
import random

import numpy as np
import pytest

from panelkit.functions import quantiles
from panelkit.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.5, 0.95, 1.0]


def _rows(n=9000, seed=3):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randint(0, 3)), lambda: rng.paretovariate(0.5), lambda: 7.0]
    return [(i % 3, 1 + i % 5, kinds[i % 4](), None if i % 11 == 0 else rng.random()) for i in range(n)]


def _nearest(values, p):
    return sorted(values)[max(1, math.ceil(round(p * len(values), 9))) - 1]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g int, ym int, a double, b double")


@pytest.mark.parametrize("method", ["cont", "disc"])
@pytest.mark.parametrize("options", [{}, {"margin": 0.0001}, {"margin": 0.4}])
def test_groups(spark, method, options):
    rows = _rows()
    out = exact_quantiles(_frame(spark, rows), ["a", "b"], PROBS, ["g"], method, **options).collect()
    got = {(r["g"], r["column"], r["prob"]): r["value"] for r in out}
    assert len(got) == 3 * 2 * len(PROBS)
    for (g, c, p), v in got.items():
        values = [r[2 if c == "a" else 3] for r in rows if r[0] == g]
        values = [x for x in values if x is not None]
        want = np.quantile(values, p) if method == "cont" else _nearest(values, p)
        assert v == pytest.approx(want, rel=1e-12)


def test_sketch_larger_than_its_size(spark):
    rng = random.Random(5)
    rows = [(0, 1, rng.lognormvariate(0, 3), None) for _ in range(20000)]
    out = exact_quantiles(_frame(spark, rows), ["a", "b"], [0.5, 0.9], ["g"]).collect()
    assert {r["column"] for r in out} == {"a"}
    for r in out:
        assert r["value"] == pytest.approx(np.quantile([x[2] for x in rows], r["prob"]), rel=1e-12)


def test_missed_brackets_are_redone(spark):
    """With no margin at all most sketch brackets miss; the result must not change."""
    rng = random.Random(6)
    rows = [(i % 2, 1, rng.random(), None) for i in range(30000)]
    out = exact_quantiles(_frame(spark, rows), ["a"], [0.25, 0.75], ["g"], margin=0.0).collect()
    assert len(out) == 4
    for r in out:
        want = np.quantile([x[2] for x in rows if x[0] == r["g"]], r["prob"])
        assert r["value"] == pytest.approx(want, rel=1e-12)


def test_earlier_periods(spark):
    rows = _rows(600)
    out = exact_quantiles(_frame(spark, rows), ["a"], [0.2, 0.8], ["g"], before="ym").collect()
    got = {(r["g"], r["ym"], r["prob"]): r["value"] for r in out}
    assert {k[1] for k in got} == {2, 3, 4, 5}
    for (g, m, p), v in got.items():
        assert v == pytest.approx(np.quantile([r[2] for r in rows if r[0] == g and r[1] < m], p), rel=1e-12)


def test_whole_table(spark):
    rows = _rows(100)
    out = exact_quantiles(_frame(spark, rows), ["a"], [0.5]).collect()
    assert [r["value"] for r in out] == [pytest.approx(np.median([r[2] for r in rows]))]


def test_not_a_number_is_ignored(spark):
    values = [float(x) for x in range(10)] + [float("nan")] * 3
    out = exact_quantiles(_frame(spark, [(0, 1, v, None) for v in values]), ["a"], [0.5, 0.95], ["g"]).collect()
    assert {r["prob"]: r["value"] for r in out} == {0.5: pytest.approx(4.5), 0.95: pytest.approx(8.55)}


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        exact_quantiles(_frame(spark, _rows(10)), ["a"], [0.5], method="x")


def test_rows_meet_one_array_per_group_and_column(spark):
    """Values are looked up in an array; no row is joined with later periods, with probabilities or by an inequality."""
    df = _frame(spark, _rows(300))
    wanted = quantiles._brackets(quantiles._merge_earlier(quantiles._sketches(df, ["a", "b"], ["g", "ym"]), ["g"], "ym"),
                                 ["g", "ym", "column"], [0.2, 0.5, 0.8], "cont", 0.01)
    cuts = quantiles.settle(quantiles._cuts(wanted, ["g", "column"]))
    assert cuts.count() == 6
    tally = quantiles._tally(df, ["a", "b"], cuts, ["g", "ym"], ["g", "column"])
    plan = tally._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert tally.agg({"rows": "sum"}).first()[0] == sum(r[2] is not None for r in _rows(300)) + sum(r[3] is not None for r in _rows(300))


def test_interval_search(spark):
    from pyspark.sql import functions as F

    cuts = [1.0, 2.0, 4.0, 8.0, 16.0]
    values = [0.0, 1.0, 1.5, 2.0, 3.0, 4.0, 7.9, 8.0, 15.0, 16.0, 17.0]
    for n in range(len(cuts) + 1):
        df = spark.createDataFrame([(v, cuts[:n]) for v in values], "v double, cuts array<double>")
        for r in df.withColumn("at", quantiles._interval(F.col("v"), F.col("cuts"))).collect():
            below = sum(c < r.v for c in cuts[:n])
            assert r["at"] == 2 * below + (r.v in cuts[:n])
