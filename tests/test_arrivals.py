import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators import history, labels
from panelkit.sources import arrivals, panel

SETTINGS = {"lags": (1, 2), "chained": 2, "slope": True, "ratios": True}


def _panel(spark, months, seed=1):
    rng = random.Random(seed)
    rows = [(i, m, rng.random() * 9, rng.choice([None, 1.0, 4.0])) for i in range(30) for m in months if rng.random() < 0.75]
    return spark.createDataFrame(rows, "id int, ym int, mx double, ctrx double")


MONTHS = [202009, 202010, 202011, 202012, 202101, 202102, 202103, 202104, 202105, 202106]


def _whole(rows):
    rows = labels.label_attrition(rows)
    return history.add_history(rows, ["mx", "ctrx"], **SETTINGS)


def _same(a, b):
    def key(df):
        return sorted(str(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.select(*sorted(df.columns)).collect())

    assert key(a) == key(b)


def test_arrivals_equal_a_whole_computation(spark, tmp_path):
    rows = _panel(spark, MONTHS).cache()
    store = arrivals.Arrivals(str(tmp_path / "s"), ["mx", "ctrx"], SETTINGS)
    store.begin(rows.filter("ym <= 202012"))
    _same(store.read(spark), _whole(rows.filter("ym <= 202012")))
    for m in (202101, 202102, 202104):  # a month in which nobody was seen
        store.arrive(rows.filter(F.col("ym") == m))
    _same(store.read(spark), _whole(rows.filter("ym <= 202104 and ym <> 202103")))
    other = _panel(spark, [202104], 7)
    store.arrive(other)  # corrected rows of the latest month
    _same(store.read(spark), _whole(rows.filter("ym < 202103").unionByName(other)))
    with pytest.raises(ValueError):
        store.arrive(rows.filter("ym = 202102"))
    with pytest.raises(ValueError):
        store.arrive(rows.filter("ym >= 202105"))
    with pytest.raises(ValueError):
        store.arrive(rows.filter("ym > 300000"))


def test_an_arrival_cut_short_is_repeated(spark, tmp_path, monkeypatch):
    rows = _panel(spark, MONTHS).cache()
    store = arrivals.Arrivals(str(tmp_path / "s"), ["mx", "ctrx"], SETTINGS)
    store.begin(rows.filter("ym <= 202104"))
    whole = arrivals.Arrivals._write

    def cut(self, df, name, by):
        if name == "labels":
            raise RuntimeError("lost")
        whole(self, df, name, by)

    monkeypatch.setattr(arrivals.Arrivals, "_write", cut)
    with pytest.raises(RuntimeError):
        store.arrive(rows.filter("ym = 202105"))
    monkeypatch.setattr(arrivals.Arrivals, "_write", whole)
    for m in (202105, 202106):
        store.arrive(rows.filter(F.col("ym") == m))
    _same(store.read(spark), _whole(rows))


def test_old_periods_are_not_read(spark, tmp_path):
    rows = _panel(spark, MONTHS)
    store = arrivals.Arrivals(str(tmp_path / "s"), ["mx"], SETTINGS)
    store.begin(rows.filter("ym <= 202105"))
    near = store.near_panel(spark, 202106)
    assert {r.ym for r in near.collect()} == {202104, 202105}
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ym" in plan and "202104" in plan and "202012" not in plan
    assert store._near(202101, 202012) == [202011, 202012, 202101] and store._near(202103, 202101) == [202012, 202101, 202102, 202103]
    assert store.depth == 5
    assert len(near.inputFiles()) >= 1
    tail = store.tail_before(spark, 202106)
    assert tail.groupBy("id").count().agg(F.max("count")).first()[0] <= 5
    assert "PartitionFilters: [isnotnull(_upto" in tail._jdf.queryExecution().executedPlan().toString()


def test_windows_over_a_panel_by_customer_neither_shuffle_nor_sort(spark, tmp_path):
    rows = _panel(spark, MONTHS).cache()
    laid = panel.write_by_customer(rows, "panel_by_customer", str(tmp_path / "p"), buckets=4)
    made = history.add_history(labels.label_attrition(laid, last=202106 // 100 * 12 + 6), ["mx", "ctrx"], **SETTINGS)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort [" not in plan and "Window" in plan
    _same(made, _whole(rows))
    both = laid.join(laid.groupBy("id").agg(F.max("mx").alias("top")).hint("merge"), "id")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    again = panel.attach_by_customer(spark, "panel_again", str(tmp_path / "p"), rows.schema, buckets=4)
    _same(again, rows)
    for name in ("panel_by_customer", "panel_again"):
        spark.sql(f"DROP TABLE {name}")
