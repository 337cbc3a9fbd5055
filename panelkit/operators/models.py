"""Tree models on panel features, through pyspark.ml.

Trees there reject missing values, so medians of the training rows stand in for them
and a flag per feature says so. Scores differ by design from those of other learners.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.columns import total
from panelkit.functions.durable import application_folder, settle, shared_folder
from panelkit.operators import gain, search
from panelkit.operators import trees as tree_tables
from panelkit.operators.sampling import undersample_exact
from panelkit.sources import trials as trial_log

VECTOR = "_features"


@dataclass(frozen=True)
class TreeParams:
    """Settings of a boosted ensemble, by what they limit."""

    iterations: int = 20
    rate: float = 0.1
    leaves: int = 32
    rows_per_leaf: int = 20
    feature_share: float = 1.0
    row_share: float = 1.0
    bins: int = 32

    @property
    def depth(self) -> int:
        """Trees grow level by level here: the smallest depth with room for the leaves."""
        levels = max(1, math.ceil(math.log2(self.leaves)))
        if levels > 30:
            raise ValueError(f"{self.leaves} leaves need trees deeper than 30 levels")
        return levels

    def learner(self, seed: int, label: str) -> GBTClassifier:
        return GBTClassifier(
            featuresCol=VECTOR,
            labelCol=label,
            maxIter=self.iterations,
            stepSize=self.rate,
            maxDepth=self.depth,
            minInstancesPerNode=self.rows_per_leaf,
            featureSubsetStrategy="all" if self.feature_share >= 1 else str(self.feature_share),
            subsamplingRate=self.row_share,
            maxBins=self.bins,
            seed=seed,
        )


@dataclass
class Prepared:
    """How to turn rows into vectors: the features, their training medians, and which of them had gaps."""

    features: list[str]
    medians: dict[str, float]
    gaps: list[str]

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str]) -> Prepared:
        """Approximate medians and gap counts, in one pass. A feature without any value gets 0."""
        names = list(features)
        value = {c: F.col(c).cast("double") for c in names}
        middle = train.agg(*[F.percentile_approx(value[c], 0.5, 10000).alias(c) for c in names],
                           *[F.count_if(value[c].isNull()).alias(f"gaps of {c}") for c in names]).first().asDict()
        medians = {c: 0.0 if middle[c] is None else float(middle[c]) for c in names}
        return Prepared(names, medians, [c for c in names if middle[f"gaps of {c}"]])

    @property
    def entries(self) -> list[str]:
        """What each entry of the vector stands for."""
        return [*self.features, *[f"{c}_missing" for c in self.gaps]]

    def vectors(self, df: DataFrame) -> DataFrame:
        """Add the feature vector; the table's own columns stay as they are."""
        value = {c: F.col(c).cast("double") for c in self.features}
        filled = [F.coalesce(value[c], F.lit(self.medians[c])).alias(f"_v_{c}") for c in self.features]
        flags = [value[c].isNull().cast("double").alias(f"_m_{c}") for c in self.gaps]
        inputs = [*[f"_v_{c}" for c in self.features], *[f"_m_{c}" for c in self.gaps]]
        wide = df.select("*", *filled, *flags)
        return VectorAssembler(inputCols=inputs, outputCol=VECTOR).transform(wide).select(*df.columns, VECTOR)


@dataclass
class Ensemble:
    """One boosted model per seed."""

    prepared: Prepared
    models: dict[int, GBTClassificationModel] = field(default_factory=dict)
    store: tree_tables.Store | None = None
    key: str = "nodes"

    def stored(self) -> tree_tables.Store:
        """Where the models are written: the store that they were fitted into, else a folder of the application."""
        if self.store is None:
            spark = SparkSession.active()
            self.store = tree_tables.Store(spark, f"{application_folder(spark)}/models-{uuid.uuid4().hex}")
        return self.store

    def nodes(self) -> DataFrame:
        return tree_tables.node_table(self.models, self.stored(), self.key)

    def split_importances(self) -> DataFrame:
        """Shares of gain, cover and frequency per seed and feature."""
        return tree_tables.split_importances(self.nodes(), self.prepared.entries)

    def score(self, df: DataFrame, name: str = "score", trees: dict[int, int] | None = None) -> DataFrame:
        """Add the mean probability over the seeds, of all trees or of the first `trees[seed]`. One pass, no shuffle."""
        if trees is not None:
            stages = tree_tables.staged(self, df, self.stored(), self.key, "_stages", trees)
            return stages.select(*df.columns, F.element_at("_stages", -1).alias(name))
        rows = self.prepared.vectors(df)
        parts = []
        for seed, model in self.models.items():
            part = f"_p_{seed}"
            model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(part)
            rows = model.transform(rows)
            parts.append(vector_to_array(part)[1])
        return rows.select(*df.columns, (total(parts) / F.lit(float(len(parts)))).alias(name))

    def scores_by_seed(self, df: DataFrame, keys: Sequence[str], name: str = "score") -> DataFrame:
        """Scores in long form: keys, seed, score."""
        rows = self.prepared.vectors(df)
        pairs = []
        for seed, model in self.models.items():
            part = f"_p_{seed}"
            model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol(part)
            rows = model.transform(rows)
            pairs.append(F.struct(F.lit(seed).alias("seed"), vector_to_array(part)[1].alias(name)))
        return rows.select(*keys, F.explode(F.array(*pairs)).alias("e")).select(*keys, "e.seed", f"e.{name}")

    def importances(self) -> DataFrame:
        """Importance per seed and vector entry: seed, feature, importance. A few rows per model."""
        spark = SparkSession.active()
        rows = [
            (seed, entry, float(value))
            for seed, model in self.models.items()
            for entry, value in zip(self.prepared.entries, model.featureImportances.toArray(), strict=True)
        ]
        return spark.createDataFrame(rows, "seed int, feature string, importance double")


def training_rows(
    df: DataFrame,
    periods: Sequence[int],
    share: float,
    seed: object,
    target: str = "target",
    id: str = "id",
    period: str = "ym",
) -> DataFrame:
    """Labelled rows of the periods, negatives undersampled; settled because every tree reads them."""
    known = df.filter(F.col(period).isin([int(p) for p in periods]) & F.col(target).isNotNull())
    chosen = known if share >= 1 else undersample_exact(known, share, seed, [id, period], target)
    return settle(chosen)


def fit_ensemble(
    train: DataFrame,
    features: Sequence[str],
    seeds: Sequence[int],
    params: TreeParams,
    target: str = "target",
    store: str | None = None,
    parallelism: int = 1,
) -> Ensemble:
    """One model per seed on the same rows; the trees of each are grown across the executors.

    With `store`, a folder, every model is written there as soon as it is fitted, and one that is there for the same
    settings and rows is read instead: a study that was cut short goes on where it stopped. Up to `parallelism` models
    are fitted side by side; the result does not depend on it.
    """
    spark = train.sparkSession
    shared_folder(spark)
    prepared = Prepared.fit(train, features)
    kept, key = None, "nodes"
    if store is not None:
        kept = tree_tables.Store(spark, store)
        key = tree_tables.fingerprint(train, [*features, target], asdict(params))
    vectors = prepared.vectors(train).select(VECTOR, F.col(target).cast("double").alias(target)).persist()

    def fit(seed: int) -> GBTClassificationModel:
        if kept is not None and kept.fitted(key, seed):
            return kept.read(key, seed)
        model = params.learner(seed, target).fit(vectors)
        if kept is not None:
            kept.write(key, seed, model)
        return model

    models = dict(zip(seeds, tree_tables.side_by_side(fit, list(seeds), parallelism), strict=True))
    vectors.unpersist()
    return Ensemble(prepared, models, kept, key)


def score_periods(
    df: DataFrame,
    features: Sequence[str],
    train_periods: Sequence[int],
    score_periods: Sequence[int],
    seeds: Sequence[int],
    params: TreeParams,
    share: float = 1.0,
    target: str = "target",
    id: str = "id",
    period: str = "ym",
    store: str | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Fit a seed ensemble on some periods and score others: all columns plus `score`."""
    train = training_rows(df, train_periods, share, seeds[0], target, id, period)
    ensemble = fit_ensemble(train, features, seeds, params, target, store, parallelism)
    return ensemble.score(df.filter(F.col(period).isin([int(p) for p in score_periods])))


# Settings under which trees grow until nothing is left to split.
OVERFIT = TreeParams(iterations=100, rate=0.1, leaves=1024, rows_per_leaf=1)


def overfit_importance(
    df: DataFrame,
    features: Sequence[str],
    periods: Sequence[int],
    seeds: Sequence[int],
    share: float = 0.5,
    params: TreeParams = OVERFIT,
    target: str = "target",
    id: str = "id",
    period: str = "ym",
    store: str | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Importance per seed and feature of models fitted to exhaustion.

    The importance of a feature's missing flag counts for the feature.
    """
    train = training_rows(df, periods, share, seeds[0], target, id, period)
    entries = fit_ensemble(train, features, seeds, params, target, store, parallelism).importances()
    base = F.regexp_replace("feature", "_missing$", "")
    return entries.groupBy("seed", base.alias("feature")).agg(F.sum("importance").alias("importance"))


@dataclass
class Forest:
    """A random forest whose leaves serve as features; a tree's leaves are numbered from 0, in preorder."""

    prepared: Prepared
    model: RandomForestClassificationModel

    @property
    def names(self) -> list[str]:
        """rf_<tree>_<leaf> for every leaf, trees one after the other: what each entry of the leaf vector stands for."""
        # a binary tree with n nodes has (n + 1) / 2 leaves
        return [f"rf_{t:03d}_{k:03d}" for t, tree in enumerate(self.model.trees) for k in range((tree.numNodes + 1) // 2)]

    def _leaves(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepared.vectors(df)).withColumn("_leaf", vector_to_array("_leaf"))

    def columns(self, df: DataFrame) -> DataFrame:
        """Add a 0/1 column per leaf."""

        def flag(name: str) -> Column:
            _, tree, leaf = name.split("_")
            return (F.col("_leaf")[int(tree)] == int(leaf)).cast("int").alias(name)

        return self._leaves(df).select(*df.columns, *[flag(n) for n in self.names])

    def vector(self, df: DataFrame, name: str = "leaves") -> DataFrame:
        """Add one sparse vector with a one for the leaf of each tree, at the tree's offset plus the leaf's number."""
        tokens = F.transform("_leaf", lambda leaf, tree: F.format_string("rf_%03d_%03d", tree, leaf.cast("int")))
        counter = CountVectorizerModel.from_vocabulary(self.names, "_tokens", name, binary=True)
        return counter.transform(self._leaves(df).withColumn("_tokens", tokens)).select(*df.columns, name)


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    periods: Sequence[int],
    trees: int = 20,
    leaves: int = 16,
    rows_per_leaf: int = 100,
    feature_share: float = 0.2,
    seed: int = 1,
    target: str = "target",
    period: str = "ym",
) -> Forest:
    """A forest on the labelled rows of some periods."""
    shared_folder(df.sparkSession)
    train = settle(df.filter(F.col(period).isin([int(p) for p in periods]) & F.col(target).isNotNull()))
    prepared = Prepared.fit(train, features)
    learner = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=target,
        leafCol="_leaf",
        predictionCol="",
        rawPredictionCol="",
        probabilityCol="",
        numTrees=trees,
        maxDepth=max(1, math.ceil(math.log2(leaves))),
        minInstancesPerNode=rows_per_leaf,
        featureSubsetStrategy=str(feature_share),
        subsamplingRate=1.0 - 1.0 / math.e,
        maxBins=32,
        seed=seed,
    )
    return Forest(prepared, learner.fit(prepared.vectors(train).withColumn(target, F.col(target).cast("double"))))


def forest_leaf_features(df: DataFrame, features: Sequence[str], periods: Sequence[int], *args, **settings) -> DataFrame:
    """Add a 0/1 column per tree and leaf of a forest fitted on some periods (see fit_forest): rf_<tree>_<leaf>."""
    return fit_forest(df, features, periods, *args, **settings).columns(df)


def forest_leaf_vector(df: DataFrame, features: Sequence[str], periods: Sequence[int], *args, **settings) -> DataFrame:
    """Add the leaves of a forest fitted on some periods (see fit_forest) as one sparse vector, `leaves`."""
    return fit_forest(df, features, periods, *args, **settings).vector(df)


def rolling_scores(
    df: DataFrame,
    features: Sequence[str],
    seeds: Sequence[int],
    params: TreeParams,
    share: float = 1.0,
    context: int = 4,
    gap: int = 1,
    target: str = "target",
    id: str = "id",
    period: str = "ym",
    name: str = "score_rolling",
    store: str | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Score every period by an ensemble trained on the periods before it, leaving out the `gap` last.

    Periods without a usable past keep their rows with a null score. Up to `parallelism` periods are fitted side by side.
    All periods are scored in one scan if their trees are small enough to be told to every task (trees.TOLD_BYTES), else
    by one scan of each.
    """

    def fitted(turn: tuple[int, list[int]]) -> Ensemble | None:
        train = training_rows(df, turn[1], share, seeds[0], target, id, period)
        classes = train.agg(F.min(target), F.max(target)).first()
        if classes[0] is None or classes[0] == classes[1]:
            return None
        return fit_ensemble(train, features, seeds, params, target, store)

    turns = search.schedule_lists(search.rolling_schedule(df, period, context, gap))
    ensembles = tree_tables.side_by_side(fitted, turns, parallelism)
    usable = [(scored, e) for (scored, _), e in zip(turns, ensembles, strict=True) if e is not None]
    at_once = tree_tables.score_by_period(dict(usable), df, period, name)
    if at_once is not None:
        return at_once
    done = [scored for scored, _ in usable]
    parts = [e.score(df.filter(F.col(period) == scored), name) for scored, e in usable]
    rest = df.filter(~F.col(period).isin(done)) if done else df
    out = rest.withColumn(name, F.lit(None).cast("double"))
    for part in parts:
        out = out.unionByName(part)
    return out


def params_from_trial(decoded: dict) -> TreeParams:
    return TreeParams(
        iterations=max(1, int(decoded["num_iterations"])),
        rate=float(decoded["learning_rate"]),
        leaves=int(decoded["num_leaves"]),
        rows_per_leaf=int(decoded["min_data_in_leaf"]),
        feature_share=float(decoded["feature_fraction"]),
    )


def best_trees(
    ensemble: Ensemble, valid: DataFrame, target: str = "target", keys: Sequence[str] = ("id", "ym"),
    half_window: int = 500, patience: int | None = 50,
) -> dict[int, int]:
    """For every seed the number of its model's trees that give the highest gain on the rows."""
    store = ensemble.stored()
    return {
        seed: tree_tables.chosen_trees(
            tree_tables.gains_by_trees(Ensemble(ensemble.prepared, {seed: model}), valid, store, ensemble.key, target, keys, half_window=half_window),
            patience,
        )
        for seed, model in ensemble.models.items()
    }


def tune_by_gain(
    df: DataFrame,
    features: Sequence[str],
    train_periods: Sequence[int],
    valid_periods: Sequence[int],
    seeds: Sequence[int],
    trials: int,
    log: str,
    share: float = 1.0,
    search_seed: int = 1,
    ranges: search.Ranges | None = None,
    half_window: int = 500,
    target: str = "target",
    id: str = "id",
    period: str = "ym",
    patience: int | None = 50,
    parallelism: int = 1,
) -> DataFrame:
    """Random search for the parameters with the highest peak gain in the validation periods.

    Each model is scored by as many of its trees as give the highest gain, looked for until `patience` trees bring none
    higher (None: by all of its trees). Up to `parallelism` trials run side by side.

    `ranges` narrows the search; what is logged is what was fitted. Trials whose leaves can't all be filled are logged
    as rejected without a fit.
    Every trial is appended to the table at `log`; trials already there are not repeated,
    so an interrupted search goes on where it stopped. Returns the log.
    """
    spark = df.sparkSession
    done = trial_log.trial_numbers(spark, log)
    draws = [{"trial_number": i, **d} for i, d in enumerate(search.draw_trials(trials, search_seed)) if i not in done]
    if draws:
        valid = settle(df.filter(F.col(period).isin([int(p) for p in valid_periods])))
        keys = [id, period]

        def tried(draw: dict) -> tuple[int, dict, float]:
            number = draw["trial_number"]
            train = training_rows(df, train_periods, share, seeds[0] + number, target, id, period)
            rows, unit = train.count(), spark.createDataFrame([draw])
            suggested = search.suggest(unit, rows, ranges).drop("trial_number").first().asDict()
            decoded = search.decode_trials(unit, rows, ranges).first().asDict()
            if decoded["rejected"]:
                return number, suggested, search.REJECTED
            ensemble = fit_ensemble(train, features, seeds, params_from_trial(decoded), target)
            counts = None if patience is None else best_trees(ensemble, valid, target, keys, half_window, patience)
            curve = gain.gain_curve(ensemble.score(valid, trees=counts), "score", target, keys, positive=1)
            return number, suggested, gain.peak_gain(curve, half_window=half_window).first()["value"]

        for at in range(0, len(draws), max(1, parallelism)):
            # the log is written by one at a time
            for number, suggested, value in tree_tables.side_by_side(tried, draws[at:at + max(1, parallelism)], parallelism):
                trial_log.append_trial(
                    spark, log, number, suggested, value, seeds=seeds, train_periods=train_periods, valid_periods=valid_periods
                )
    return trial_log.read_trials(spark, log)
