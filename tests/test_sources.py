import gzip

import pytest

from panelkit.functions import durable
from panelkit.sources import panel, reports, trials


def test_gzipped_csv(spark, tmp_path):
    path = tmp_path / "p.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("id,ym,m1\n1,202012,1.5\n2,202101,\n")
    typed = panel.read_panel_csv(spark, str(path), "id bigint, ym int, m1 double")
    assert sorted((r["id"], r["ym"], r["m1"]) for r in typed.collect()) == [(1, 202012, 1.5), (2, 202101, None)]
    guessed = panel.read_panel_csv(spark, str(path))
    assert [t for _, t in guessed.dtypes] == ["int", "int", "double"]


def test_bad_csv_raises(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,ym\nx,1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        panel.read_panel_csv(spark, str(path), "id bigint, ym int").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        panel.read_panel_csv(spark, str(tmp_path / "none.csv")).collect()


def test_panel_is_partitioned_by_period(spark, tmp_path):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "id int, ym int, m1 double")
    panel.write_panel(df, str(tmp_path / "p"))
    back = panel.read_panel(spark, str(tmp_path / "p"))
    assert back.filter("ym = 2").first()["m1"] == 3.0
    assert "PartitionFilters: [isnotnull(ym" in back.filter("ym = 2")._jdf.queryExecution().executedPlan().toString()


def test_stack_and_unique_keys(spark):
    a = spark.createDataFrame([(1, 1, 2.0)], "id int, ym int, m1 double")
    b = spark.createDataFrame([(3.0, 2, 1)], "m1 double, ym int, id int")
    both = panel.stack_snapshots(a, b)
    assert panel.require_unique_keys(both).count() == 2
    with pytest.raises(ValueError, match="several rows"):
        panel.require_unique_keys(panel.stack_snapshots(a, a))


def test_importances(spark, tmp_path):
    path = str(tmp_path / "i")
    reports.write_importances(spark.createDataFrame([("a", 1.0), ("b", 3.0)], "feature string, importance double"), path)
    assert [r["feature"] for r in reports.read_importances(spark, path).collect()] == ["b", "a"]
    (tmp_path / "dup.csv").write_text("Feature,Importance\na,1.0\nb,5.0\na,2.0\n")
    by_value = reports.read_importances(spark, str(tmp_path / "dup.csv")).collect()
    assert [(r["feature"], r["importance"]) for r in by_value] == [("b", 5.0), ("a", 1.0)]
    by_line = reports.read_importances(spark, str(tmp_path / "dup.csv"), by_importance=False).collect()
    assert {r["feature"]: r["importance"] for r in by_line} == {"a": 2.0, "b": 5.0}
    (tmp_path / "bad.csv").write_text("Feature,x\na,1\n")
    with pytest.raises(ValueError, match="Importance"):
        reports.read_importances(spark, str(tmp_path / "bad.csv"))


def test_trials(spark, tmp_path):
    path = str(tmp_path / "t")
    assert trials.trial_numbers(spark, path) == set()
    trials.append_trial(spark, path, 0, {"x": 1.0}, 5.0, [1, 2], [202101], [202104])
    trials.append_trial(spark, path, 1, {"x": 2.0}, 5.0)
    assert trials.trial_numbers(spark, path) == {0, 1}
    assert trials.best_params(trials.read_trials(spark, path)) == {"x": 1.0}
    first = trials.read_trials(spark, path).filter("trial_number = 0").first()
    assert first["configuracion"]["mes_train"] == [202101] and first["state"] == "COMPLETE"
    with pytest.raises(ValueError, match="fitted"):
        trials.best_params(trials.read_trials(spark, path).filter("value > 9"))


def test_curve_report(spark, tmp_path):
    curve = spark.createDataFrame([(1, 1, 78), (2, 2, 76), (3, 3, 154), (4, 40000, 999)], "id int, rank int, gain_acum int")
    best = reports.write_curve(curve, str(tmp_path / "c"), high=30000).first()
    assert (best["best_total"], best["best_cutoff"]) == (154, 3)
    assert reports.read_table(spark, str(tmp_path / "c"), "id int, rank int, gain_acum int").count() == 4


def test_submission_and_ledger(spark, tmp_path):
    marked = spark.createDataFrame([(1, 1), (2, 0)], "id bigint, predicted int")
    reports.write_submission(marked, str(tmp_path / "s"))
    lines = sorted(x for p in (tmp_path / "s").glob("part*") for x in p.read_text().split() if "," in x)
    assert set(lines) == {"id,Predicted", "1,1", "2,0"}
    points = spark.createDataFrame([(1, 10, 4), (2, 10, 8)], "replicate int, cutoff int, total int")
    for name in ("x", "y"):
        reports.append_ledger(points, [10], name, str(tmp_path / "l"))
    rows = reports.read_table(spark, str(tmp_path / "l"), "e10 double, experiment string", "\t").collect()
    assert sorted((r["e10"], r["experiment"]) for r in rows) == [(6.0, "x"), (6.0, "y")]


def test_settled_rows(spark):
    df = spark.range(10)
    assert durable.settle(df).count() == 10
    assert durable.shared_folder(spark)
