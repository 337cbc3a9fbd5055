"""Whole studies: from a raw panel to the customers worth contacting.

Each study labels the panel before it drops any period, because the label looks ahead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import family, numeric
from panelkit.functions.durable import settle
from panelkit.operators import gain, history, labels, models, repair, sampling, scale, search, selection, snapshot
from panelkit.sources import trials


@dataclass(frozen=True)
class Setup:
    """What a study needs to know about its panel and its months."""

    train: Sequence[int]
    valid: Sequence[int]
    test: Sequence[int]
    future: Sequence[int] = ()
    seeds: Sequence[int] = (11, 23, 37, 51, 67)
    share: float = 0.1
    id: str = "id"
    period: str = "ym"
    yyyymm: bool = True
    drop: Sequence[str] = ()
    params: models.TreeParams = field(default_factory=models.TreeParams)
    half_window: int = 500
    #: folder of fitted models, so that a study that was cut short goes on; and models fitted at the same time
    store: str | None = None
    parallelism: int = 1

    @property
    def keys(self) -> tuple[str, str]:
        return (self.id, self.period)

    @property
    def not_features(self) -> tuple[str, ...]:
        return (self.id, "label", "target")

    def features(self, df: DataFrame) -> list[str]:
        return numeric(df, exclude=self.not_features)


def labelled(panel: DataFrame, setup: Setup) -> DataFrame:
    """The panel without its drifting columns, with class and binary target."""
    rows = snapshot.drop_columns(panel, setup.drop)
    rows = labels.label_attrition(settle(rows), setup.id, setup.period, setup.yyyymm)
    return rows.select("*", labels.binary_target().alias("target"))


def _inputs(df: DataFrame, setup: Setup) -> list[str]:
    return numeric(df, exclude=[*setup.not_features, setup.period])


def explored_features(
    panel: DataFrame, setup: Setup, weights: dict[str, tuple[float, ...]] | None = None
) -> DataFrame:
    """Row sum, two lags, two chained deltas, and projection terms where weights are given."""
    rows = labelled(panel, setup)
    rows = snapshot.add_row_sum(rows, family(rows))
    rows = history.add_history(rows, _inputs(rows, setup), setup.id, setup.period, lags=(1, 2), chained=2)
    if weights:
        rows = scale.projection_terms(settle(rows), weights, setup.period)
    return settle(rows)


def pruned_features(rows: DataFrame, setup: Setup, overfit: models.TreeParams, ratio: float = 0.5, share: float = 0.95) -> DataFrame:
    """Keep the features that beat the lowest canaries in models fitted to exhaustion."""
    with_canaries = sampling.add_canaries(
        rows, ratio=ratio, keys=setup.keys, ignore=[*setup.not_features, setup.period]
    )
    found = models.overfit_importance(
        with_canaries, setup.features(with_canaries), setup.train, setup.seeds, 0.5, overfit,
        id=setup.id, period=setup.period, store=setup.store, parallelism=setup.parallelism,
    )
    means = settle(selection.mean_importance(found))
    return selection.select_by_canaries(rows, means, share, [*setup.keys, "label", "target"])


def search_study(
    panel: DataFrame,
    setup: Setup,
    log: str,
    n_trials: int,
    overfit: models.TreeParams = models.OVERFIT,
    weights: dict[str, tuple[float, ...]] | None = None,
    leaf_trees: int = 20,
    ranges: search.Ranges | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Features, leaf features, pruning, parameter search; returns the test curve and the future's scores."""
    rows = explored_features(panel, setup, weights)
    rows = settle(
        models.forest_leaf_features(rows, setup.features(rows), setup.train, leaf_trees, period=setup.period)
    )
    rows = settle(pruned_features(rows, setup, overfit))
    features = setup.features(rows)
    found = models.tune_by_gain(
        rows, features, setup.train, setup.valid, setup.seeds, n_trials, log, setup.share,
        ranges=ranges, half_window=setup.half_window, id=setup.id, period=setup.period, parallelism=setup.parallelism,
    )
    known = search.to_params(rows.sparkSession.createDataFrame([trials.best_params(found)])).first().asDict()
    params = models.params_from_trial(known)
    scored = models.score_periods(
        rows, features, setup.train, [*setup.test, *setup.future], setup.seeds, params, setup.share,
        id=setup.id, period=setup.period, store=setup.store, parallelism=setup.parallelism,
    )
    scored = settle(scored.select(*setup.keys, "label", "score"))
    curve = gain.gain_curve(scored.filter(F.col(setup.period).isin([int(p) for p in setup.test])), keys=setup.keys)
    future = scored.filter(F.col(setup.period).isin([int(p) for p in setup.future])).select(*setup.keys, "score")
    return curve, future


def fixed_study(panel: DataFrame, setup: Setup, n_canaries: int = 5) -> DataFrame:
    """Lags, deltas and a few canaries, one set of parameters: the gain curve of the test periods."""
    rows = labelled(panel, setup)
    rows = history.add_history(rows, _inputs(rows, setup), setup.id, setup.period, lags=(1, 2), chained=2)
    rows = settle(sampling.add_canaries(rows, n=n_canaries, keys=setup.keys))
    scored = models.score_periods(
        rows, setup.features(rows), [*setup.train, *setup.valid], setup.test, setup.seeds, setup.params, setup.share,
        id=setup.id, period=setup.period, store=setup.store, parallelism=setup.parallelism,
    )
    return gain.gain_curve(scored, keys=setup.keys)


def replicate_scores(panel: DataFrame, setup: Setup, replicates: int, n_canaries: int = 5) -> DataFrame:
    """Scores of the test periods by several ensembles with seeds of their own: keys, label, replicate, score.

    Repair, seasonality, lags, anchored deltas and slopes; leavers and a random share of the rest to train on.
    """
    rows = labelled(panel, setup)
    inputs = _inputs(rows, setup)
    rows = repair.blank_dead_columns(settle(rows), inputs, setup.period, "zero_sum")
    rows = rows.select("*", (F.col(setup.period) % 100).alias("kmes"))
    rows = history.add_history(
        rows, inputs, setup.id, setup.period, lags=(1, 2), anchored=(1, 2), slope=True, lag_name="{c}_lag{i}"
    )
    rows = settle(sampling.add_canaries(rows, n=n_canaries, keys=setup.keys, kind="uniform"))
    known = rows.filter(F.col(setup.period).isin([int(p) for p in setup.train]))
    drawn = sampling.undersample_bernoulli(known, setup.share, setup.seeds[0], setup.keys)
    train = settle(drawn.withColumn("target", labels.binary_target_filled()))
    scored = rows.filter(F.col(setup.period).isin([int(p) for p in setup.test]))
    features = setup.features(rows)
    each = len(setup.seeds) // replicates
    if not each:
        raise ValueError("fewer seeds than replicates")
    pairs = []
    for r in range(replicates):
        own = setup.seeds[r * each : (r + 1) * each]
        ensemble = models.fit_ensemble(train, features, own, setup.params, store=setup.store, parallelism=setup.parallelism)
        scored = ensemble.score(scored, f"_score_{r}")
        pairs.append(F.struct(F.lit(r + 1).alias("replicate"), F.col(f"_score_{r}").alias("score")))
    long = scored.select(*setup.keys, "label", F.explode(F.array(*pairs)).alias("e"))
    return long.select(*setup.keys, "label", "e.replicate", "e.score")


def replicate_study(
    panel: DataFrame, setup: Setup, replicates: int, cutoffs: Sequence[int]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gain per replicate and cutoff, mean gain per cutoff, and the submission nearest to the best mean."""
    curve = gain.gain_curve(settle(replicate_scores(panel, setup, replicates)), keys=setup.keys, group=["replicate"])
    points = settle(gain.gain_at(curve, cutoffs, ["replicate"]))
    means = gain.mean_gains(points)
    submission = gain.consensus_submission(curve, means.agg(F.max("total")).scalar(), keys=setup.keys)
    return gain.gain_matrix(points, cutoffs), means, submission
