"""Feature importances and selection against random control columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import ordered
from panelkit.functions.quantiles import exact_quantiles


def mean_importance(importances: DataFrame, seed: str = "seed") -> DataFrame:
    """Importance summed per feature over the seeds, divided by the number of seeds.

    A feature a model never used counts as zero there.
    """
    seeds = importances.agg(F.count_distinct(seed)).scalar()
    return importances.groupBy("feature").agg((F.sum("importance") / seeds).alias("importance"))


def importance_detail(importances: DataFrame, measures: Sequence[str] = ("gain", "cover", "frequency")) -> DataFrame:
    """Mean of each measure over the models that used the feature, and how many did."""
    return importances.groupBy("feature").agg(
        *[F.avg(m).alias(m) for m in measures], F.count(F.lit(1)).alias("models")
    )


def extremes(importances: DataFrame, n: int = 10) -> DataFrame:
    """The n most and the n least important features."""
    top = importances.orderBy(F.desc("importance"), "feature").limit(n).withColumn("part", F.lit("top"))
    bottom = importances.orderBy("importance", "feature").limit(n).withColumn("part", F.lit("bottom"))
    return top.unionByName(bottom)


def selected_features(importances: DataFrame, share: float = 0.05, prefix: str = "canarito") -> DataFrame:
    """Features strictly above the (1 - share) percentile of the canaries' importances.

    Without canaries every feature is kept.
    """
    canary = F.col("feature").startswith(prefix)
    marks = exact_quantiles(importances.filter(canary), ["importance"], [1 - share])
    threshold = marks.select("value").scalar()
    return importances.filter(~canary & F.coalesce(F.col("importance") > threshold, F.lit(True)))


def select_by_canaries(
    df: DataFrame,
    importances: DataFrame,
    share: float = 0.05,
    keys: Sequence[str] = ("id", "ym", "label"),
    prefix: str = "canarito",
) -> DataFrame:
    """Keep the keys and the features that beat the canaries, features in alphabetical order.

    The names of the kept features, one per column of `df` at most, go through the
    driver: they are the schema of the result. Without canaries the table is unchanged.
    """
    if importances.filter(F.col("feature").startswith(prefix)).isEmpty():
        return df
    wanted = selected_features(importances, share, prefix).filter(F.col("feature").isin(*df.columns))
    kept = {r["feature"] for r in wanted.select("feature").collect()}
    narrow = df.select(*[c for c in df.columns if c in kept or c in set(keys)])
    return ordered(narrow, keys, sort_rest=True)

