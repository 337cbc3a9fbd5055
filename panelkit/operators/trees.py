"""What fitted tree ensembles hold: node tables, importances, scores after every tree, and the choice of their number."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasProbabilityCol
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.functions.durable import settle
from panelkit.operators import gain


def side_by_side(work: Callable, items: Sequence, parallelism: int) -> list:
    """work(item) for every item, up to `parallelism` at a time on threads with the caller's local properties."""
    if parallelism <= 1 or len(items) <= 1:
        return [work(i) for i in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(work), items, chunksize=1)


# ------------------------------------------------------------------------------------------------------- the store


class Store:
    """Fitted models under a folder, one per settings and seed. A model counts as there once its mark is written, after
    all else; one that was cut short is fitted again."""

    MARK = "_FITTED"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _file(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def path(self, key: str, seed: int) -> str:
        return f"{self.folder}/{key}/seed={seed}"

    def fitted(self, key: str, seed: int) -> bool:
        files, mark = self._file(f"{self.path(key, seed)}/{self.MARK}")
        return files.exists(mark)

    def read(self, key: str, seed: int) -> GBTClassificationModel:
        return GBTClassificationModel.load(self.path(key, seed))

    def write(self, key: str, seed: int, model: GBTClassificationModel) -> None:
        model.write().overwrite().save(self.path(key, seed))
        files, mark = self._file(f"{self.path(key, seed)}/{self.MARK}")
        files.create(mark, True).close()


def fingerprint(train: DataFrame, columns: Sequence[str], settings: dict) -> str:
    """A key of the settings and of the training rows, whatever their order: their number and the sum of their hashes."""
    row = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    known = train.agg(F.count("*"), F.sum(row).cast("string")).first()
    return hashlib.sha256(json.dumps([*known, list(columns), settings], sort_keys=True, default=str).encode()).hexdigest()[:32]


# ----------------------------------------------------------------------------------------------------- node tables


def node_table(models: dict[int, GBTClassificationModel], store: Store, key: str = "nodes") -> DataFrame:
    """The nodes of all trees as a table, read from the written models: seed, tree, node (in preorder), feature, threshold,
    left, right and gain (null in leaves), training rows, value, and the tree's weight."""
    spark, parts = store.spark, []
    for seed, model in models.items():
        if not store.fitted(key, seed):
            store.write(key, seed, model)
        weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
        n = F.col("nodeData")
        parts.append(spark.read.parquet(f"{store.path(key, seed)}/data").select(
            F.lit(seed).alias("seed"), F.col("treeID").alias("tree"), n["id"].alias("node"),
            F.when(n["leftChild"] >= 0, n["split"]["featureIndex"]).alias("feature"),
            *[F.when(n["leftChild"] >= 0, e).alias(c) for c, e in (
                ("threshold", F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))), ("left", n["leftChild"]),
                ("right", n["rightChild"]), ("gain", n["gain"]))],
            n["rawCount"].alias("rows"),
            n["prediction"].alias("value"), F.element_at(weights, F.col("treeID") + 1).alias("weight"),
        ))
    return reduce(DataFrame.unionByName, parts)


def split_importances(nodes: DataFrame, entries: Sequence[str]) -> DataFrame:
    """Shares per model and feature: gain (what its splits gain, by rows), cover (rows that they split) and frequency
    (splits). Each adds up to one per model; features without a split are left out. A feature's missing flag counts for the
    feature."""
    names = nodes.sparkSession.createDataFrame([(i, e.removesuffix("_missing")) for i, e in enumerate(entries)], "entry int, name string")
    splits = nodes.filter("feature is not null").join(names, F.col("feature") == F.col("entry"))
    used = splits.groupBy("seed", F.col("name").alias("feature")).agg(
        F.sum(F.col("gain") * F.col("rows")).alias("gain"), F.sum("rows").alias("cover"), F.count("*").alias("frequency"))
    # a row per feature and model
    whole = Window.partitionBy("seed")
    return used.select("seed", "feature", *[F.try_divide(F.col(c).cast("double"), F.sum(c).over(whole)).alias(c) for c in ("gain", "cover", "frequency")])


# ----------------------------------------------------------------------------------------------------- staged scores


def _leaf_values(model: GBTClassificationModel, nodes: DataFrame, seed: int) -> np.ndarray:
    """Tree x leaf: what each leaf adds to the margin. Leaves are numbered in preorder; a model's size is bounded by its
    settings."""
    rows = nodes.filter((F.col("seed") == seed) & F.col("feature").isNull()).select("tree", "node", F.col("value") * F.col("weight")).collect()
    per_tree: dict[int, list] = {}
    for tree, node, value in sorted(map(tuple, rows)):
        per_tree.setdefault(tree, []).append(value)
    out = np.zeros((len(per_tree), max(map(len, per_tree.values()))))
    for tree, values in per_tree.items():
        out[tree, :len(values)] = values
    return out


def staged(ensemble, df: DataFrame, store: Store, key: str = "nodes", name: str = "scores", trees: dict[int, int] | None = None) -> DataFrame:
    """Add the ensemble's mean probability after every tree, as an array: one pass over the rows, no shuffle.

    With `trees`, a number per seed, a model's further trees add nothing.
    """
    spark = df.sparkSession
    nodes = settle(node_table(ensemble.models, store, key))
    if trees is not None:
        limit = F.element_at(F.create_map(*[F.lit(x) for pair in trees.items() for x in pair]), F.col("seed"))
        nodes = nodes.withColumn("value", F.when(F.col("tree") < limit, F.col("value")).otherwise(0.0))
    rows, leaves = ensemble.prepared.vectors(df), []
    for seed, model in ensemble.models.items():
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("").setLeafCol(f"_leaf_{seed}")
        rows = model.transform(rows)
        leaves.append(vector_to_array(f"_leaf_{seed}"))
        model.setLeafCol("")
    values = spark.sparkContext.broadcast([_leaf_values(m, nodes, s) for s, m in ensemble.models.items()])

    @F.pandas_udf("array<double>")
    def after_each(*parts: pd.Series) -> pd.Series:
        total = 0.0
        for table, part in zip(values.value, parts):
            if not len(part):
                return pd.Series([], dtype=object)
            leaf = np.stack(part.to_numpy()).astype(np.int64)
            margin = np.cumsum(table[np.arange(len(table)), leaf], axis=1)
            total = total + 1.0 / (1.0 + np.exp(-2.0 * margin))
        return pd.Series(list(total / len(parts)))

    return rows.select(*df.columns, after_each(*leaves).alias(name))


def gains_by_trees(
    ensemble, valid: DataFrame, store: Store, key: str = "nodes", label: str = "target", keys: Sequence[str] = ("id", "ym"),
    positive: object = 1, half_window: int = 500, hit: int = gain.HIT, cost: int = gain.COST,
) -> DataFrame:
    """iteration and gain: the peak gain of the mean scores after that many trees."""
    scored = staged(ensemble, valid, store, key).select(*keys, label, F.posexplode("scores").alias("_at", "score"))
    long = scored.withColumn("iteration", F.col("_at") + 1).drop("_at")
    curve = gain.gain_curve(long, "score", label, keys, ["iteration"], positive, hit, cost)
    return gain.peak_gain(curve, ["iteration"], half_window).select("iteration", F.col("value").alias("gain"))


def chosen_trees(gains: DataFrame, patience: int | None = 50) -> int:
    """The number of trees with the highest gain, the least among equals, before `patience` trees pass without a higher
    one. One row per tree comes to the driver."""
    best, value = 0, float("-inf")
    for row in gains.orderBy("iteration").collect():
        if row["gain"] > value:
            best, value = row["iteration"], row["gain"]
        elif patience is not None and row["iteration"] - best >= patience:
            break
    return best


# ------------------------------------------------------------------------------------------------- models by period

#: trees of all periods told to every task, in bytes of their nodes; beyond it each period is scored by a scan of its own
TOLD_BYTES = 64 << 20
NODE_BYTES = 40


class Forest:
    """The trees of one ensemble as arrays, for many rows at a time."""

    def __init__(self, prepared, rows: list):
        """Rows are (seed, tree, node, feature, threshold, left, right, contribution)."""
        self.medians = np.array([prepared.medians[c] for c in prepared.features])
        self.gaps = [prepared.features.index(c) for c in prepared.gaps]
        rows = sorted(rows, key=lambda r: r[:3])
        roots, place = [], {}
        for n, r in enumerate(rows):
            place[r[:3]] = n
            if r[2] == 0:
                roots.append((r[0], n))
        self.roots = np.array([n for _, n in roots])
        seeds = sorted({s for s, _ in roots})
        self.seed = np.array([seeds.index(s) for s, _ in roots])
        self.leaf = np.array([r[3] is None for r in rows])
        self.feature = np.array([0 if r[3] is None else r[3] for r in rows])
        self.threshold = np.array([0.0 if r[3] is None else r[4] for r in rows])
        child = lambda r, c: place[r[0], r[1], r[c]]
        self.left = np.array([n if r[3] is None else child(r, 5) for n, r in enumerate(rows)])
        self.right = np.array([n if r[3] is None else child(r, 6) for n, r in enumerate(rows)])
        self.value = np.array([r[7] for r in rows])

    def score(self, values: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """Mean probability over the seeds; what is missing has the median, and a flag where the training rows had gaps."""
        x = np.concatenate([np.where(missing, self.medians, values), missing[:, self.gaps].astype(float)], axis=1)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        while not self.leaf[at].all():
            # a leaf is its own child
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        part, seeds = self.value[at], int(self.seed.max()) + 1
        margins = np.stack([part[:, self.seed == s].sum(axis=1) for s in range(seeds)])
        return (1.0 / (1.0 + np.exp(-2.0 * margins))).mean(axis=0)


def score_by_period(ensembles: dict, df: DataFrame, period: str, name: str, told_bytes: int = TOLD_BYTES) -> DataFrame | None:
    """All rows with the score of the ensemble of their period, null without one, in a single scan; None if the nodes of
    all trees measure more than `told_bytes`."""
    spark, tables = df.sparkSession, {}
    for at, e in ensembles.items():
        nodes = e.nodes()
        if nodes.count() * NODE_BYTES > told_bytes - sum(len(t[1]) for t in tables.values()) * NODE_BYTES:
            return None
        known = nodes.select("seed", "tree", "node", "feature", "threshold", "left", "right", F.col("value") * F.col("weight"))
        tables[at] = (e.prepared, [tuple(r) for r in known.collect()])
    told = spark.sparkContext.broadcast({at: Forest(*t) for at, t in tables.items()})
    features = next(iter(ensembles.values())).prepared.features if ensembles else []
    width = len(features)

    @F.pandas_udf("double")
    def scored(periods: pd.Series, values: pd.Series) -> pd.Series:
        out = np.full(len(periods), np.nan)
        if len(periods):
            whole = np.array([[np.nan if v is None else v for v in row] for row in values.to_numpy()], dtype=float).reshape(-1, 2 * width)
            for at in periods.unique():
                forest = told.value.get(at)
                if forest is not None:
                    rows = (periods == at).to_numpy()
                    out[rows] = forest.score(whole[rows, :width], whole[rows, width:] > 0)
        return pd.Series(out, dtype="Float64").mask(np.isnan(out))

    if not ensembles:
        return df.withColumn(name, F.lit(None).cast("double"))
    value = [F.col(f"`{c}`").cast("double") for c in features]
    flat = F.array(*[F.coalesce(v, F.lit(0.0)) for v in value], *[v.isNull().cast("double") for v in value])
    return df.select("*", scored(F.col(period), flat).alias(name))


# -------------------------------------------------------------------------------------------------------- evaluator


class GainEvaluator(Evaluator, HasLabelCol, HasProbabilityCol):
    """Peak gain as the metric of pyspark.ml's tuning, for instance TrainValidationSplit; larger is better.

    Rows of equal probability go by `keyCols`. The label is 1 for customers worth contacting.
    """

    keyCols = Param(Params._dummy(), "keyCols", "columns that name a row", typeConverter=TypeConverters.toListString)
    halfWindow = Param(Params._dummy(), "halfWindow", "ranks around the peak that are averaged", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, labelCol="target", probabilityCol="probability", keyCols=("id", "ym"), halfWindow=500):
        super().__init__()
        self._set(labelCol=labelCol, probabilityCol=probabilityCol, keyCols=list(keyCols), halfWindow=halfWindow)

    def _evaluate(self, dataset: DataFrame) -> float:
        label, keys = self.getLabelCol(), self.getOrDefault(self.keyCols)
        scored = dataset.select(*keys, label, vector_to_array(self.getProbabilityCol())[1].alias("score"))
        curve = gain.gain_curve(scored, "score", label, keys, positive=1)
        row = gain.peak_gain(curve, half_window=self.getOrDefault(self.halfWindow)).first()
        return float("-inf") if row is None else float(row["value"])

    def isLargerBetter(self) -> bool:
        return True
