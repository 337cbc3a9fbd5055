import pytest

from panelkit.operators import labels

END = (99, 13)


def _labels(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id int, period int")
    out = labels.label_attrition(df, period="period", yyyymm=False, **kw)
    return {(r["id"], r["period"]): r["label"] for r in out.collect()}


def test_continuing(spark):
    got = _labels(spark, [(1, 10), (1, 11), (1, 12), (1, 13)])
    assert [got[1, p] for p in (10, 11, 12, 13)] == ["CONTINUA", "CONTINUA", None, None]


def test_leaves_in_one(spark):
    assert _labels(spark, [(2, 10), END])[2, 10] == "BAJA+1"


def test_leaves_in_two(spark):
    got = _labels(spark, [(3, 10), (3, 11), END])
    assert (got[3, 10], got[3, 11]) == ("BAJA+2", "BAJA+1")


def test_gap(spark):
    got = _labels(spark, [(4, 10), (4, 12), END])
    assert (got[4, 10], got[4, 12]) == ("BAJA+1", "BAJA+1")


def test_three_periods_ahead(spark):
    got = _labels(spark, [(5, 8), (5, 9), (5, 10), END], horizon=3)
    assert (got[5, 8], got[5, 9], got[5, 10]) == ("BAJA+3", "BAJA+2", "BAJA+1")


def test_year_border(spark):
    df = spark.createDataFrame([(1, 202011), (1, 202012), (1, 202101), (1, 202102)], "id int, ym int")
    got = [r["label"] for r in labels.label_attrition(df).orderBy("ym").collect()]
    assert got == ["CONTINUA", "CONTINUA", None, None]


def test_target_modes(spark):
    df = spark.createDataFrame([("CONTINUA",), ("BAJA+1",), ("BAJA+2",), (None,)], "label string")
    rows = df.select(
        "label",
        labels.binary_target().alias("a"),
        labels.binary_target_filled().alias("b"),
        labels.strict_target().alias("c"),
    ).collect()
    got = {r["label"]: (r["a"], r["b"], r["c"]) for r in rows}
    assert got == {"CONTINUA": (0, 0, 0), "BAJA+1": (1, 1, 0), "BAJA+2": (1, 1, 1), None: (None, 0, 0)}


def test_tenure_modes(spark):
    df = spark.createDataFrame([(1, 202011), (1, 202101)], "id int, ym int")
    months = [r["tenure"] for r in labels.with_tenure(df).orderBy("ym").collect()]
    raw = [r["tenure"] for r in labels.with_tenure(df, mode="reference").orderBy("ym").collect()]
    assert months == [0, 2] and raw == [10, 12]
    with pytest.raises(ValueError):
        labels.with_tenure(df, mode="x")


def test_unaffected_by_order_and_partitions(spark):
    rows = [(i, p) for i in range(30) for p in range(1, 12) if (i * p) % 5]
    want = _labels(spark, rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert _labels(spark, rows[::-1]) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
