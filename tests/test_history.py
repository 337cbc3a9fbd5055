import pytest
from pyspark.sql import functions as F

from panelkit.operators import history, snapshot


def _panel(spark, values, months=None):
    months = months or range(1, len(values) + 1)
    return spark.createDataFrame([(1, m, v) for m, v in zip(months, values)], "id int, ym int, c double")


def _column(df, name):
    return [r[name] for r in df.orderBy("ym").collect()]


def test_chained_and_anchored(spark):
    df = history.add_history(_panel(spark, [1.0, 4.0, 9.0]), ["c"], lags=(1, 2), chained=2, anchored=(1, 2))
    last = df.filter("ym = 3").first()
    assert (last["c_lag_1"], last["c_lag_2"]) == (4.0, 1.0)
    assert (last["c_delta_lag_1"], last["c_delta_lag_2"], last["c_delta1"], last["c_delta2"]) == (5.0, 3.0, 5.0, 8.0)


def test_chained_sum_is_anchored(spark, sf):
    from panelkit.plans.panels import supplier_month

    df = history.add_history(supplier_month(spark, sf), ["cl"], chained=2, anchored=(2,))
    assert df.filter("cl_delta_lag_1 + cl_delta_lag_2 <> cl_delta2").count() == 0


def test_trend_skips_nulls_but_keeps_their_place(spark):
    df = history.add_history(_panel(spark, [3.0, None, 5.0, 1.0]), ["c"], slope=True)
    assert _column(df, "c_tend6")[:3] == [None, None, 1.0]
    assert _column(df, "c_tend6")[3] == pytest.approx(-3 / 7)


def test_window_needs_two_values(spark):
    df = history.add_history(_panel(spark, [2.0, 4.0]), ["c"], extremes=True, ratios=True)
    assert _column(df, "c_min6") == [None, 2.0] and _column(df, "c_avg6") == [None, 3.0]
    assert _column(df, "c_ratiomax6") == [None, 1.0]


def test_zero_divisor(spark):
    df = history.add_history(_panel(spark, [0.0, 0.0]), ["c"], ratios=True)
    assert _column(df, "c_ratioavg6") == [None, None]
    row = spark.createDataFrame([(5.0, 0.0)], "a double, b double").select(snapshot.ratio("a", "b").alias("r")).first()
    assert row["r"] is None


def test_calendar_lag(spark):
    df = _panel(spark, [1.0, 2.0], [202011, 202101])
    by_row = history.add_history(df, ["c"], lags=(1, 2))
    by_month = history.add_history(df, ["c"], lags=(1, 2), calendar=True)
    assert _column(by_row, "c_lag_1") == [None, 1.0]
    assert _column(by_month, "c_lag_1") == [None, None] and _column(by_month, "c_lag_2") == [None, 1.0]


def test_unknown_and_text_columns(spark):
    df = _panel(spark, [1.0]).withColumn("t", F.lit("x"))
    assert history.add_history(df, ["nope"], lags=(1,)).columns == df.columns
    assert history.add_history(df, ["t"], lags=(1,), chained=1).columns == [*df.columns, "t_lag_1"]


def test_own_p95_sees_no_future(spark):
    df = history.scale_by_own_p95(_panel(spark, [-2.0, 1.0, 100.0]), ["c"])
    got = _column(df, "c")
    assert got[0] == -1.0 and got[1] == pytest.approx(1 / 2)
    assert got[2] == pytest.approx(100 / (2 + 0.9 * 98))


def test_all_null_row_sum(spark):
    df = spark.createDataFrame([(None, None)], "m1 double, m2 double")
    assert snapshot.add_row_sum(df, ["m1", "m2"]).first()["suma_m_visa_master"] == 0.0


def _operators(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "Exchange" in line and "Reused" not in line]


def test_one_shuffle_for_label_and_features(spark):
    from panelkit.operators.labels import label_attrition

    df = spark.createDataFrame([(1, 1, 1.0)], "id int, ym int, c double")
    out = history.add_history(label_attrition(df), ["c"], lags=(1, 2), chained=2, slope=True, ratios=True)
    shuffles = [x for x in _operators(out) if "hashpartitioning" in x]
    assert len(shuffles) == 1
