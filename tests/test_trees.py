import math
import time

import duckdb
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from panelkit.operators import gain, models, selection, trees

PARAMS = models.TreeParams(iterations=6, rate=0.4, leaves=4, rows_per_leaf=3, feature_share=0.7, row_share=0.8)
FEATURES = ["signal", "noise", "gone"]


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for m in range(1, 6):
        for i in range(60):
            target = (i * 7 + m) % 3 == 0
            rows.append((i, m, int(target), float(target) * (i % 5) + i % 4, float((i * 13 + m) % 11) if i % 5 else None, None))
    return spark.createDataFrame(rows, "id int, ym int, target int, signal double, noise double, gone double").cache()


@pytest.fixture(scope="module")
def ensemble(panel, tmp_path_factory):
    return models.fit_ensemble(panel.filter("ym <= 3"), FEATURES, (1, 2), PARAMS, store=str(tmp_path_factory.mktemp("fits")))


def test_node_table_holds_the_trees(ensemble):
    nodes = ensemble.nodes().collect()
    for seed, model in ensemble.models.items():
        for t, tree in enumerate(model.trees):
            mine = [n for n in nodes if (n.seed, n.tree) == (seed, t)]
            assert len(mine) == tree.numNodes and {n.weight for n in mine} == {model.treeWeights[t]}
            root = next(n for n in mine if n.node == 0)
            assert root.rows >= sum(n.rows for n in mine if n.feature is None) > 0


def test_shares_add_up_and_match_sql(ensemble):
    shares = ensemble.split_importances()
    for r in shares.groupBy("seed").agg(*[F.sum(c).alias(c) for c in ("gain", "cover", "frequency")]).collect():
        assert all(r[c] == pytest.approx(1.0) for c in ("gain", "cover", "frequency"))
    nodes = ensemble.nodes().toPandas()  # noqa: F841
    entries = [e.removesuffix("_missing") for e in ensemble.prepared.entries]
    sql = duckdb.sql("""
        WITH s AS (SELECT seed, ($e)[feature::INT + 1] AS feature, gain * rows AS g, rows FROM nodes WHERE feature IS NOT NULL)
        SELECT seed, feature, sum(g) / sum(sum(g)) OVER w, sum(rows) / sum(sum(rows)) OVER w, count(*) / sum(count(*)) OVER w
        FROM s GROUP BY seed, feature WINDOW w AS (PARTITION BY seed)""".replace("$e", str(entries))).fetchall()
    got = {(r.seed, r.feature): (r.gain, r.cover, r.frequency) for r in shares.collect()}
    assert got == {(r[0], r[1]): pytest.approx(r[2:]) for r in sql}
    detail = {r.feature: r for r in selection.importance_detail(shares).collect()}
    assert detail["signal"].models == 2 and detail["signal"].gain == pytest.approx(sum(v[0] for k, v in got.items() if k[1] == "signal") / 2)


def by_hand(ensemble, rows, n):
    """Mean probability of the first n trees, tree by tree."""
    vectors = {(r.id, r.ym): r[models.VECTOR] for r in ensemble.prepared.vectors(rows).collect()}
    out = dict.fromkeys(vectors, 0.0)
    for model in ensemble.models.values():
        for k, v in vectors.items():
            margin = sum(w * t.predict(v) for w, t in list(zip(model.treeWeights, model.trees))[:n])
            out[k] += 1 / (1 + math.exp(-2 * margin)) / len(ensemble.models)
    return out


def test_staged_scores_are_those_of_shorter_models(ensemble, panel):
    valid = panel.filter("ym = 4")
    scored = {(r.id, r.ym): r.scores for r in trees.staged(ensemble, valid, ensemble.stored(), ensemble.key).collect()}
    assert all(len(s) == 6 for s in scored.values())
    for n in (1, 3, 6):
        expected = by_hand(ensemble, valid, n)
        assert {k: s[n - 1] for k, s in scored.items()} == {k: pytest.approx(v, abs=1e-12) for k, v in expected.items()}
    whole = {(r.id, r.ym): r.score for r in ensemble.score(valid).collect()}
    assert {k: s[-1] for k, s in scored.items()} == {k: pytest.approx(v, abs=1e-12) for k, v in whole.items()}


def test_gain_after_every_tree(ensemble, panel):
    valid = panel.filter("ym = 4")
    gains = trees.gains_by_trees(ensemble, valid, ensemble.stored(), ensemble.key, half_window=2)
    target = {(r.id, r.ym): r.target for r in valid.collect()}
    for r in gains.collect():
        scores = by_hand(ensemble, valid, r.iteration)
        order = sorted(scores, key=lambda k: (-round(scores[k], 12), k))
        run, total = [], 0
        for k in order:
            total += gain.HIT if target[k] else gain.COST
            run.append(total)
        peak = run.index(max(run))
        near = run[max(0, peak - 2):peak + 3]
        assert r.gain == pytest.approx(sum(near) / len(near), abs=3)
    assert 1 <= trees.chosen_trees(gains) <= 6


def test_patience(spark):
    gains = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, 6.0), (5, 9.0)], "iteration int, gain double")
    assert trees.chosen_trees(gains) == 5 and trees.chosen_trees(gains, 2) == 2 and trees.chosen_trees(gains, 3) == 5
    assert trees.chosen_trees(gains, None) == 5


def test_scores_of_fewer_trees(ensemble, panel):
    valid = panel.filter("ym = 5")
    got = {(r.id, r.ym): r.score for r in ensemble.score(valid, trees={1: 2, 2: 2}).collect()}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in by_hand(ensemble, valid, 2).items()}


def test_evaluator_in_tuning(panel):
    prepared = models.Prepared.fit(panel, FEATURES)
    rows = prepared.vectors(panel).withColumn("target", F.col("target").cast("double"))
    learner = GBTClassifier(featuresCol=models.VECTOR, labelCol="target", maxDepth=2, seed=1)
    evaluator = trees.GainEvaluator(halfWindow=3)
    grid = ParamGridBuilder().addGrid(learner.maxIter, [1, 3]).build()
    found = TrainValidationSplit(estimator=learner, estimatorParamMaps=grid, evaluator=evaluator, seed=3, trainRatio=0.6, parallelism=2).fit(rows)
    assert len(found.validationMetrics) == 2 and evaluator.isLargerBetter()
    scored = found.bestModel.transform(rows)
    curve = gain.gain_curve(scored.select("id", "ym", "target", models.vector_to_array("probability")[1].alias("score")), label="target", positive=1)
    assert evaluator.evaluate(scored) == gain.peak_gain(curve, half_window=3).first()["value"]


def test_fits_restart_and_run_side_by_side(spark, panel, tmp_path, monkeypatch):
    train, store = panel.filter("ym <= 3"), str(tmp_path / "store")
    one = models.fit_ensemble(train, FEATURES, (1, 2, 3), PARAMS)
    models.fit_ensemble(train, FEATURES, (1,), PARAMS, store=store)
    fits = []
    whole = models.TreeParams.learner

    def counted(self, seed, label):
        fits.append(seed)
        return whole(self, seed, label)

    monkeypatch.setattr(models.TreeParams, "learner", counted)
    again = models.fit_ensemble(train, FEATURES, (1, 2, 3), PARAMS, store=store, parallelism=3)
    assert sorted(fits) == [2, 3]
    last = models.fit_ensemble(train.repartition(5), FEATURES, (1, 2, 3), PARAMS, store=store, parallelism=2)
    assert sorted(fits) == [2, 3]
    scores = [sorted((r.id, r.ym, r.score) for r in e.score(panel).collect()) for e in (one, again, last)]
    assert scores[0] == scores[1] == scores[2]
    models.fit_ensemble(train.filter("id <> 7"), FEATURES, (1,), PARAMS, store=store)
    models.fit_ensemble(train, FEATURES, (1,), models.TreeParams(iterations=2), store=store)
    assert len(fits) == 4


def test_a_model_cut_short_is_fitted_again(spark, panel, tmp_path):
    store = trees.Store(spark, str(tmp_path))
    model = models.fit_ensemble(panel, FEATURES, (1,), PARAMS).models[1]
    model.write().save(store.path("k", 1))
    assert not store.fitted("k", 1)
    store.write("k", 1, model)
    assert store.fitted("k", 1) and store.read("k", 1).treeWeights == model.treeWeights
    began = time.perf_counter()
    assert trees.side_by_side(lambda x: time.sleep(0.2) or x, [1, 2, 3], 3) == [1, 2, 3] and time.perf_counter() - began < 0.55


def test_all_periods_in_one_scan(spark, panel):
    """Scores by period equal those of each period's own ensemble, rows with gaps included."""
    rows = panel.withColumn("signal", F.when(F.col("id") != 3, F.col("signal")))
    fitted = {m: models.fit_ensemble(rows.filter(F.col("ym") == m - 1), FEATURES, (1, 2), PARAMS) for m in (3, 5)}
    once = trees.score_by_period(fitted, rows, "ym", "score")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Union" not in plan
    got = {(r.id, r.ym): r.score for r in once.collect()}
    assert all(got[i, m] is None for i in range(60) for m in (1, 2, 4))
    for m, e in fitted.items():
        expected = {(r.id, r.ym): r.score for r in e.score(rows.filter(F.col("ym") == m)).collect()}
        assert {k: v for k, v in got.items() if k[1] == m} == {k: pytest.approx(v, abs=1e-12) for k, v in expected.items()}
    assert trees.score_by_period(fitted, rows, "ym", "score", told_bytes=500) is None
    assert trees.score_by_period({}, rows, "ym", "score").filter("score is not null").count() == 0
