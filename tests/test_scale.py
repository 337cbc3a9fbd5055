import pytest

from panelkit.operators import scale


def test_limit_mean_needs_both(spark):
    rows = [(1, 1, 2.0, 100.0, 300.0), (2, 1, 3.0, None, 500.0), (3, 2, 4.0, None, None)]
    df = spark.createDataFrame(rows, "id int, ym int, m1 double, Master_l double, Visa_l double")
    got = {r["id"]: r["m1"] for r in scale.scale_by_limit(df, ["m1", "Visa_l"], ("Master_l", "Visa_l")).collect()}
    assert got == {1: 100.0, 2: 150.0, 3: None}


def test_deflate_without_index_is_null(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 10)], "id int, ym int, m1 int")
    index = spark.createDataFrame([(1, 2.0)], "ym int, index double")
    assert {r["ym"]: r["m1"] for r in scale.deflate(df, ["m1"], index).collect()} == {1: 5.0, 2: None}


@pytest.mark.parametrize("method,mark", [("disc", 19.0), ("cont", 19.05), ("approx", 19.0)])
def test_p95_methods(spark, method, mark):
    df = spark.createDataFrame([(i, 1, float(-i if i % 2 else i)) for i in range(1, 21)], "id int, ym int, m1 double")
    got = {r["id"]: r["m1"] for r in scale.scale_by_p95(df, ["m1"], method=method).collect()}
    assert got[20] == pytest.approx(20 / mark) and got[1] == pytest.approx(-1 / mark)


def test_p95_zero_and_no_columns(spark):
    df = spark.createDataFrame([(1, 1, 0.0)], "id int, ym int, m1 double")
    assert scale.scale_by_p95(df, ["m1"]).first()["m1"] is None
    with pytest.raises(ValueError):
        scale.scale_by_p95(df, [])


def test_projection_nulls_propagate(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 5.0), (2, 1, 3.0, None), (3, 1, 5.0, 7.0)], "id int, ym int, a double, b double")
    got = {r["id"]: (r["ppr_term_1"], r["ppr_term_2"]) for r in scale.projection_terms(df, {"a": (1.0, 0.0), "b": (0.0, 2.0)}).collect()}
    assert got[2] == (None, None) and got[1][0] == pytest.approx(-1.0) and got[3][1] == pytest.approx(2 / 2**0.5)


def test_class_distances(spark):
    rows = [(1, 1, "CONTINUA", 10.0), (2, 1, "BAJA+1", 4.0), (1, 2, "CONTINUA", 20.0), (3, 3, None, 7.0)]
    df = spark.createDataFrame(rows, "id int, ym int, label string, a double")
    got = {(r["id"], r["ym"]): r for r in scale.class_distance(df, ["a"], [1, 2], [0.5]).collect()}
    assert got[3, 3]["dist_CONTINUA_q50_a"] == 7 - 15 and got[3, 3]["dist_BAJA+1_q50_a"] == 3.0
    assert got[3, 3]["dist_BAJA+2_q50_a"] is None
    got = {(r["id"], r["ym"]): r for r in scale.class_distance_rolling(df, ["a"], [0.5]).collect()}
    assert got[1, 1]["dist_CONTINUA_q50_a"] is None
    assert got[1, 2]["dist_CONTINUA_q50_a"] == 10.0 and got[3, 3]["dist_CONTINUA_q50_a"] == -8.0
