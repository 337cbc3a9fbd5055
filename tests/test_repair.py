import pytest

from panelkit.operators import repair

ROWS = [
    (1, 202011, 10.0, 1.0), (1, 202012, 0.0, 2.0), (1, 202101, 30.0, 3.0),
    (2, 202011, 5.0, 1.0), (2, 202012, 0.0, 0.0), (2, 202102, 9.0, 1.0),
    (3, 202011, 7.0, -1.0), (3, 202012, None, -2.0), (3, 202101, 8.0, 1.0),
]


def _panel(spark):
    return spark.createDataFrame(ROWS, "id int, ym int, a double, b double")


def _cells(df, name):
    return {(r["id"], r["ym"]): r[name] for r in df.collect()}


def test_all_zero_blocks_become_null(spark):
    df = repair.blank_dead_columns(_panel(spark), ["a", "b"])
    a, b = _cells(df, "a"), _cells(df, "b")
    assert a[1, 202012] is None and a[2, 202012] is None and a[1, 202011] == 10.0
    assert b[1, 202012] == 2.0 and b[2, 202012] == 0.0


def test_zero_sum_blocks_lose_their_zeros_only(spark):
    df = repair.blank_dead_columns(_panel(spark), ["a", "b"], rule="zero_sum")
    b = _cells(df, "b")
    assert b[1, 202012] == 2.0 and b[3, 202012] == -2.0 and b[2, 202012] is None


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        repair.dead_flags(_panel(spark), ["a"], rule="x")


def test_dead_period_is_the_mean_of_its_neighbours(spark):
    a = _cells(repair.interpolate_dead_periods(_panel(spark), ["a"]), "a")
    assert a[1, 202012] == 20.0 and a[3, 202012] == 7.5
    assert a[2, 202012] is None  # missing in 202101
    assert a[1, 202011] == 10.0


def test_linear_interpolation_over_time(spark):
    a = _cells(repair.interpolate_zeros(_panel(spark), ["a"]), "a")
    assert a[1, 202012] == 20.0
    assert a[2, 202012] == pytest.approx(5 + 4 / 3)
    assert a[3, 202012] is None


def test_zeros_outside_stay(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 4.0), (1, 3, 0.0)], "id int, ym int, a double")
    assert set(_cells(repair.interpolate_zeros(df, ["a"], yyyymm=False), "a").values()) == {0.0, 4.0}


def test_median_drift_modes(spark):
    rows = [(1, 202010, 1.0), (1, 202011, 3.0), (1, 202012, 5.0), (1, 202101, 10.0), (2, 202101, 30.0)]
    df = spark.createDataFrame(rows, "id int, ym int, a double")
    got = _cells(repair.correct_median_drift(df, ["a"], 202101, back=2), "a")
    assert got[1, 202101] == 10 * (4 / 20) and got[2, 202101] == 30 * (4 / 20) and got[1, 202012] == 5.0
    # plain subtraction finds no month between 202099 and 202101
    same = _cells(repair.correct_median_drift(df, ["a"], 202101, back=2, mode="reference"), "a")
    assert same[1, 202101] == 10.0


def test_zero_target_median_is_left_alone(spark):
    df = spark.createDataFrame([(1, 1, 4.0), (1, 2, 0.0), (2, 2, 0.0), (3, 2, 6.0)], "id int, ym int, a double")
    got = _cells(repair.correct_median_drift(df, ["a"], 2, yyyymm=False), "a")
    assert got[3, 2] == 6.0
