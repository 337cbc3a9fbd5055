"""Queries whose rows no SQL can give: what must hold for them is checked by SQL over their rows."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from panelkit.plans import queries as catalogue


def rows(spark, sf, name):
    return entry_points.queries()[name](spark, sf).toPandas()


def one(sql, **tables):
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    return con.sql(sql).fetchall()[0]


CURVE = """
WITH c AS (SELECT *, CASE WHEN label = 'BAJA+2' THEN 78 ELSE -2 END AS own FROM t WHERE rank IS NOT NULL)
SELECT bool_and(gain = own) AND bool_and(gain_acum = run) AND bool_and(rank = place) AND bool_and(coalesce(score <= above, true)), count(*)
FROM (SELECT *, sum(own) OVER w AS run, row_number() OVER (ORDER BY score DESC, id, period) AS place, lag(score) OVER w AS above
      FROM c WINDOW w AS (ORDER BY rank))"""


@pytest.mark.parametrize("name, days", [("seed_ensemble", (24, 25, 26)), ("fixed_study", (25, 26)), ("search_study", (25, 26))])
def test_curves(spark, sf, name, days):
    t = rows(spark, sf, name)
    known, n = one(CURVE, t=t)
    assert known and n == catalogue.user_day(spark, sf).filter(f"period in {days}").count()
    if name == "search_study":
        future = t[t["rank"].isna()]
        assert set(future["period"]) == {29} and future["score"].between(0, 1).all() and future["label"].isna().all()


def test_every_tree_marks_one_leaf(spark, sf):
    wide, sparse = rows(spark, sf, "leaf_features"), rows(spark, sf, "leaf_vectors")
    made = [c for c in wide.columns if c.startswith("rf_")]
    per_tree = {t: [c for c in made if c[3:6] == t] for t in {c[3:6] for c in made}}
    assert len(per_tree) == 20 and all((wide[cs].sum(axis=1) == 1).all() for cs in per_tree.values())
    by_key = wide.set_index(["id", "period"])
    for r in sparse.itertuples():
        assert r.size == len(made) and [made[i] for i in r.positions] == [c for c, v in by_key.loc[(r.id, r.period)][made].items() if v == 1]


def test_shares_of_importance(spark, sf):
    deep, shares = rows(spark, sf, "overfit_importance"), rows(spark, sf, "model_importances")
    assert deep["importance"].sum() == pytest.approx(1.0) and (deep["importance"] >= 0).all()
    assert sum(deep["feature"].str.startswith("canarito_")) == 5
    for c in ("gain", "cover", "frequency"):
        # means over the models that used a feature: weighed by these, shares add up to one
        assert (shares[c] * shares["models"]).sum() == pytest.approx(len(catalogue.SEEDS))


def test_gains_by_trees(spark, sf):
    found = rows(spark, sf, "gains_by_trees").sort_values("iteration")
    assert list(found["iteration"]) == [1, 2, 3, 4, 5] and found["chosen"].sum() == 1
    assert found.loc[found["chosen"] == 1, "gain"].item() == found["gain"].max()


def test_replicates(spark, sf):
    study_, submission = rows(spark, sf, "replicate_study"), rows(spark, sf, "replicate_submission")
    means, each = study_[study_["replicate"].isna()], study_[study_["replicate"].notna()]
    for c in ("e10", "e50", "e100"):
        assert means[c].item() == pytest.approx(each[c].mean(), nan_ok=True)
    marked = submission.sort_values("rank")
    assert list(marked["rank"]) == list(range(1, len(marked) + 1))
    assert list(marked["predicted"]) == sorted(marked["predicted"], reverse=True) and marked["predicted"].sum() >= 1


def test_projection(spark, sf):
    import numpy as np

    t = rows(spark, sf, "pca_project").sort_values("vec_id")
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.array(vectors["embedding"].tolist(), dtype=float)
    scale = x.std(axis=0, ddof=1)
    for data in (x, x / np.where(scale > 0, scale, 1)):
        own = np.linalg.svd(data - data.mean(axis=0), full_matrices=False)
        expected = (data - data.mean(axis=0)) @ own[2][:2].T
        found = t[["pc1", "pc2"]].to_numpy() - t[["pc1", "pc2"]].to_numpy().mean(axis=0)
        if np.allclose(np.abs(found), np.abs(expected), atol=1e-6):
            break
    else:
        raise AssertionError("no projection onto the first two components")


def test_projected_clusters(spark, sf):
    t, points = rows(spark, sf, "projected_clusters"), rows(spark, sf, "pca_project")
    name = next(c for c in t.columns if c in ("vec_id", "id"))
    both = points.merge(t[[name, "cluster"]], left_on="vec_id", right_on=name)
    xy, eps, least = both[["pc1", "pc2"]].to_numpy(), 0.8, 20
    assert len(both) == len(t) == len(points)
    near = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2) <= eps * eps
    core = near.sum(axis=1) >= least
    label = both["cluster"].to_numpy()
    assert (label[core] > 0).all() and ((label > 0) == near[:, core].any(axis=1)).all()  # noise reaches no core point
    for i in core.nonzero()[0]:
        assert len(set(label[near[i] & core])) == 1  # core points within reach are one cluster


def test_scores(spark, sf):
    scored, future = rows(spark, sf, "rolling_oof"), rows(spark, sf, "future_scores")
    known = scored["score_rolling"].dropna()
    assert 0 < len(known) < len(scored) and known.between(0, 1).all() and known.nunique() > 2
    assert future["score"].between(0, 1).all() and future["score"].nunique() > 2
    trials = rows(spark, sf, "tuned_gain")
    assert len(trials) == 4 and ((trials["gain"] == -1000000) == (trials["rejected"] == 1)).all()
