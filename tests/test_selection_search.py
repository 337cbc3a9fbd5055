import pytest

from panelkit.functions.columns import family, matching, numeric, ordered
from panelkit.operators import search, selection


def test_selectors(spark):
    df = spark.createDataFrame([(1, "x", 1.0, 2.0, 3.0)], "id int, mtext string, m1 double, Visa_m2 double, mes double")
    assert family(df) == ["mtext", "m1", "Visa_m2", "mes"] and family(df, exclude=["mes"]) == ["mtext", "m1", "Visa_m2"]
    assert numeric(df, family(df)) == ["m1", "Visa_m2", "mes"] and numeric(df, ["nope", "id"]) == ["id"]
    assert matching(df, "^(m|Visa_m)", ["mtext"]) == ["m1", "Visa_m2", "mes"]
    assert ordered(df, ["m1", "nope"], sort_rest=True).columns == ["m1", "Visa_m2", "id", "mes", "mtext"]


def _importances(spark):
    rows = [("b", 9.0), ("a", 5.0), ("c", 2.0), ("canarito_000", 2.0), ("canarito_001", 4.0), ("canarito_002", 6.0)]
    return spark.createDataFrame(rows, "feature string, importance double")


def test_selection_threshold(spark):
    df = spark.createDataFrame([(1.0, 1, "x", 1.0, 2.0, 3.0)], "c double, ym int, label string, b double, a double, id double")
    kept = selection.select_by_canaries(df, _importances(spark), share=0.5)
    assert kept.columns == ["id", "ym", "label", "a", "b"]
    assert selection.select_by_canaries(df, _importances(spark), share=0.0).columns == ["id", "ym", "label", "b"]
    # at the fifth percentile the threshold lies between the two lowest canaries
    assert "c" not in selection.select_by_canaries(df, _importances(spark), share=0.95).columns


def test_without_canaries_nothing_changes(spark):
    df = spark.createDataFrame([(1, 1, "x", 1.0)], "id int, ym int, label string, z double")
    none = _importances(spark).filter("feature not like 'canarito%'")
    assert selection.select_by_canaries(df, none).columns == df.columns


def test_mean_importance_counts_all_seeds(spark):
    rows = [(1, "a", 2.0), (2, "a", 4.0), (1, "b", 3.0)]
    got = selection.mean_importance(spark.createDataFrame(rows, "seed int, feature string, importance double"))
    assert {r["feature"]: r["importance"] for r in got.collect()} == {"a": 3.0, "b": 1.5}


def test_search_space_ends(spark):
    low = {p: 0.0 for p in search.SEARCH_RANGES}
    high = {p: 1.0 for p in search.SEARCH_RANGES}
    rows = search.decode_trials(spark.createDataFrame([{"n": 0, **low}, {"n": 1, **high}]), 1000).orderBy("n").collect()
    assert rows[0]["num_iterations"] == 1 and rows[0]["learning_rate"] == 2.0**-8 and rows[0]["num_leaves"] == 2
    assert rows[0]["min_data_in_leaf"] == 1 and rows[0]["feature_fraction"] == 0.05 and not rows[0]["rejected"]
    assert rows[1]["num_iterations"] == round(2**11.1) and rows[1]["learning_rate"] == 0.5
    assert rows[1]["min_data_in_leaf"] == 500 and rows[1]["num_leaves"] == 1024 and rows[1]["rejected"]


def test_draws_do_not_depend_on_their_number():
    assert search.draw_trials(5, 1)[:2] == search.draw_trials(2, 1) != search.draw_trials(2, 9)


def test_trial_ties_go_to_the_first(spark):
    df = spark.createDataFrame([(2, 5.0), (1, 5.0), (0, 1.0)], "trial_number int, value double")
    assert search.best_trial(df).first()["trial_number"] == 1
    assert search.best_trial(df.filter("value > 9")).first() is None
    stats = search.trial_stats(df).first()
    assert (stats["trials"], stats["best"], stats["worst"]) == (3, 5.0, 1.0) and stats["mean"] == pytest.approx(11 / 3)


def test_schedule_leaves_a_gap(spark):
    df = spark.createDataFrame([(m,) for m in (202011, 202012, 202101, 202102, 202103, 202104, 202106)], "ym int")
    got = dict(search.schedule_lists(search.rolling_schedule(df)))
    assert 202011 not in got and 202012 not in got
    assert got[202101] == [202011] and got[202106] == [202012, 202101, 202102, 202103]
    assert search.periods(df) == sorted(r["ym"] for r in df.collect())
