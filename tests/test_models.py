import pytest
from pyspark.sql import functions as F

from panelkit.operators import gain, models, search
from panelkit.operators.sampling import add_canaries
from panelkit.sources import trials

SMALL = models.TreeParams(iterations=3, rate=0.3, leaves=4, rows_per_leaf=5)


@pytest.fixture(scope="module")
def panel(spark):
    """Forty customers over six months; `signal` tells the target, `noise` does not, `gone` is always missing."""
    rows = []
    for m in range(1, 7):
        for i in range(40):
            target = (i * 7 + m) % 3 == 0
            label = "BAJA+2" if target else "CONTINUA"
            rows.append((i, m, label, int(target), float(target) * 5 + i % 4, float((i * 13 + m) % 11) if i % 5 else None, None))
    return spark.createDataFrame(
        rows, "id int, ym int, label string, target int, signal double, noise double, gone double"
    ).cache()


FEATURES = ["signal", "noise", "gone"]


def test_params():
    assert models.TreeParams(leaves=32).depth == 5 and models.TreeParams(leaves=33).depth == 6
    assert models.TreeParams(leaves=2).depth == 1


def test_ensemble_scores(spark, panel):
    def fit():
        return models.score_periods(panel, FEATURES, [1, 2, 3], [5], (1, 2), SMALL, 0.8)

    scored = fit().collect()
    assert len(scored) == 40 and all(0 <= r["score"] <= 1 for r in scored)
    good = [r["score"] for r in scored if r["target"]]
    bad = [r["score"] for r in scored if not r["target"]]
    assert min(good) > max(bad)
    assert {r["id"]: r["score"] for r in fit().collect()} == {r["id"]: r["score"] for r in scored}
    curve = gain.gain_curve(fit())
    assert gain.peak_gain(curve, mode="max").first()["value"] == 78.0 * len(good)


def test_ensemble_mean_is_the_mean_of_the_seeds(spark, panel):
    train = models.training_rows(panel, [1, 2], 1.0, 1)
    ensemble = models.fit_ensemble(train, FEATURES, (1, 2, 3), models.TreeParams(iterations=2, leaves=4, feature_share=0.5, row_share=0.5))
    keys = ["id", "ym"]
    long = gain.ensemble_mean(ensemble.scores_by_seed(panel, keys))
    both = long.join(ensemble.score(panel, "direct"), keys)
    assert both.filter(F.abs(F.col("score") - F.col("direct")) > 1e-12).count() == 0 and both.count() == 240


def test_importance_finds_the_signal(spark, panel):
    rows = add_canaries(panel, n=2)
    features = [*FEATURES, "canarito_000", "canarito_001"]
    got = models.overfit_importance(rows, features, [1, 2, 3], (1, 2), 1.0, SMALL)
    assert got.select("seed").distinct().count() == 2
    top = got.groupBy("feature").agg(F.avg("importance").alias("i")).orderBy(F.desc("i")).first()
    assert top["feature"] == "signal"


def test_leaf_features(spark, panel):
    out = models.forest_leaf_features(panel, FEATURES, [1, 2, 3], trees=3, leaves=4, rows_per_leaf=5, feature_share=1.0)
    made = [c for c in out.columns if c.startswith("rf_")]
    trees = {c.split("_")[1] for c in made}
    assert trees == {"000", "001", "002"} and out.count() == panel.count()
    for t in trees:
        mine = [c for c in made if c.startswith(f"rf_{t}")]
        assert out.filter(sum(F.col(c) for c in mine) != 1).count() == 0


def test_rolling_scores(spark, panel):
    out = models.rolling_scores(panel, FEATURES, (1,), SMALL, context=2)
    counts = {r["ym"]: r["n"] for r in out.groupBy("ym").agg(F.count("score_rolling").alias("n")).collect()}
    assert counts == {1: 0, 2: 0, 3: 40, 4: 40, 5: 40, 6: 40} and out.count() == panel.count()


def test_rolling_scores_are_those_of_models_of_the_periods_before(spark, panel, monkeypatch):
    out = models.rolling_scores(panel, FEATURES, (1, 2), SMALL, context=2, parallelism=3)
    got = {(r.id, r.ym): r.score_rolling for r in out.collect()}
    monkeypatch.setattr(models.tree_tables, "score_by_period", lambda *_: None)
    each = models.rolling_scores(panel, FEATURES, (1, 2), SMALL, context=2)
    assert {(r.id, r.ym): r.score_rolling for r in each.collect()} == {k: v if v is None else pytest.approx(v, abs=1e-12) for k, v in got.items()}
    assert all(got[i, m] is None for i in range(40) for m in (1, 2))
    for m in range(3, 7):
        before = [p for p in (m - 3, m - 2) if p >= 1]
        expected = models.score_periods(panel, FEATURES, before, [m], (1, 2), SMALL)
        assert {(r.id, r.ym): pytest.approx(r.score, abs=1e-12) for r in expected.collect()} == {k: v for k, v in got.items() if k[1] == m}


def test_trials_have_the_gain_of_a_refit(spark, panel, tmp_path):
    log = models.tune_by_gain(panel, FEATURES, [1, 2, 3], [5], (1, 2), 4, str(tmp_path / "log"), ranges=NARROW, half_window=3,
                              patience=None, parallelism=2)
    seen = 0
    for r in log.collect():
        p = r["params"]
        settings = models.TreeParams(max(1, round(2 ** p["num_iterations_exp"])), 2 ** p["learning_rate_exp"], round(2 ** p["num_leaves_exp"]),
                                     round(2 ** p["min_data_exp"]), p["feature_fraction"])
        if r["value"] == search.REJECTED:
            assert settings.rows_per_leaf * settings.leaves > 120
            continue
        scored = models.score_periods(panel, FEATURES, [1, 2, 3], [5], (1, 2), settings)
        curve = gain.gain_curve(scored, label="target", positive=1)
        assert r["value"] == gain.peak_gain(curve, half_window=3).first()["value"]
        seen += 1
    assert seen


def test_trials_use_the_best_number_of_trees(spark, panel, tmp_path):
    def run(name, patience):
        log = models.tune_by_gain(panel, FEATURES, [1, 2, 3], [5], (1,), 3, str(tmp_path / name), ranges=NARROW, half_window=3, patience=patience)
        return {r["trial_number"]: r["value"] for r in log.collect()}

    best, whole = run("best", 50), run("whole", None)
    assert best.keys() == whole.keys() and all(best[k] >= whole[k] for k in whole)


def test_leaf_vector_equals_the_columns(spark, panel):
    forest = models.fit_forest(panel, FEATURES, [1, 2, 3], trees=3, leaves=4, rows_per_leaf=5, feature_share=1.0)
    wide = {(r.id, r.ym): [r[n] for n in forest.names] for r in forest.columns(panel).collect()}
    for r in forest.vector(panel).collect():
        assert r.leaves.toArray().tolist() == wide[r.id, r.ym] and len(r.leaves.indices) == 3


#: short searches whose trials can all be filled
NARROW = {"num_iterations_exp": (0.0, 2.0), "min_data_exp": (0.0, 2.0), "num_leaves_exp": (1.0, 3.0)}


def test_search_resumes(spark, panel, tmp_path):
    log = str(tmp_path / "log")

    def run(n):
        return models.tune_by_gain(panel, FEATURES, [1, 2, 3], [5], (1,), n, log, ranges=NARROW, half_window=3)

    first = {r["trial_number"]: (r["value"], r["datetime"]) for r in run(2).collect()}
    second = {r["trial_number"]: (r["value"], r["datetime"]) for r in run(3).collect()}
    assert set(first) == {0, 1} and set(second) == {0, 1, 2}
    assert all(second[k] == v for k, v in first.items())
    best = search.best_trial(trials.read_trials(spark, log)).first()
    assert trials.best_params(trials.read_trials(spark, log)) == best["params"]
    assert any(v[0] > search.REJECTED for v in second.values())
    for r in trials.read_trials(spark, log).collect():
        assert r["params"]["num_iterations_exp"] <= 2.0


def test_rejected_trials_are_never_best(spark, tmp_path):
    log = str(tmp_path / "log")
    trials.append_trial(spark, log, 0, {"x": 1.0}, search.REJECTED)
    assert search.best_trial(trials.read_trials(spark, log)).count() == 0
    with pytest.raises(ValueError):
        trials.best_params(trials.read_trials(spark, log))
    trials.append_trial(spark, log, 1, {"x": 2.0}, -500.0)
    assert trials.best_params(trials.read_trials(spark, log)) == {"x": 2.0}


def test_depth_is_not_cut(spark):
    assert models.TreeParams(leaves=1024).depth == 10
    with pytest.raises(ValueError):
        models.TreeParams(leaves=2**31).depth
