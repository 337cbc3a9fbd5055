"""Cumulative campaign gain as a function of how many customers are contacted.

All functions that rank work per group, for instance per replicate or per model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import LEAVES_IN_2
from panelkit.functions.durable import settle
from panelkit.functions.running import Down, at_ranks, down, running

# Gain of contacting a customer who would leave, and cost of any other contact.
HIT = 78
COST = -2


def row_gain(label: str = "label", positive: object = LEAVES_IN_2, hit: int = HIT, cost: int = COST) -> Column:
    """Gain of contacting one customer; an undetermined class is a cost."""
    return F.when(F.col(label) == F.lit(positive), F.lit(hit)).otherwise(F.lit(cost))


def gain_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    keys: Sequence[str] = ("id", "ym"),
    group: Sequence[str] = (),
    positive: object = LEAVES_IN_2,
    hit: int = HIT,
    cost: int = COST,
) -> DataFrame:
    """Rows by descending score with their rank, gain and running gain. Equal scores go by key."""
    scored = df.select(*group, *keys, label, score, row_gain(label, positive, hit, cost).alias("gain"))
    return running(scored, _best_first(score, keys), group, {"gain_acum": F.col("gain").cast("bigint")})


def _best_first(score: str, keys: Sequence[str]) -> list[Column | Down]:
    return [down(score), *[F.col(k) for k in keys]]


def gain_points(
    df: DataFrame,
    cutoffs: Sequence[int],
    score: str = "score",
    label: str = "label",
    keys: Sequence[str] = ("id", "ym"),
    group: Sequence[str] = (),
    positive: object = LEAVES_IN_2,
    hit: int = HIT,
    cost: int = COST,
) -> DataFrame:
    """Running gain at the given numbers of contacts, straight from the scored rows: only those near a cutoff are sorted."""
    scored = df.select(*group, *keys, score, row_gain(label, positive, hit, cost).alias("gain"))
    found = at_ranks(scored, _best_first(score, keys), cutoffs, group, {"total": F.col("gain").cast("bigint")}, "cutoff")
    return found.select(*group, "cutoff", "total")


def _peaks(curve: DataFrame, group: Sequence[str]) -> DataFrame:
    """First rank with the highest running gain, per group."""
    best = F.max_by(F.col("rank"), F.struct("gain_acum", -F.col("rank")))
    return curve.groupBy(*group).agg(best.alias("peak_rank"), F.max("gain_acum").alias("peak_gain"))


def peak_gain(curve: DataFrame, group: Sequence[str] = (), half_window: int = 500, mode: str = "mean") -> DataFrame:
    """Mean running gain within `half_window` ranks of its first maximum, or the maximum itself."""
    peaks = _peaks(curve, group)
    if mode == "max":
        return peaks.select(*group, "peak_rank", F.col("peak_gain").cast("double").alias("value"))
    if mode != "mean":
        raise ValueError(f"unknown mode {mode!r}")
    if group:
        around = curve.join(settle(peaks), list(group))
    else:
        around = curve.withColumn("peak_rank", peaks.select("peak_rank").scalar())
    return (
        around.filter(F.abs(F.col("rank") - F.col("peak_rank")) <= half_window)
        .groupBy(*group, "peak_rank")
        .agg(F.avg("gain_acum").alias("value"))
    )


def gain_at(curve: DataFrame, cutoffs: Sequence[int], group: Sequence[str] = ()) -> DataFrame:
    """Running gain at the given numbers of contacts."""
    return curve.filter(F.col("rank").isin([int(c) for c in cutoffs])).select(
        *group, F.col("rank").alias("cutoff"), F.col("gain_acum").alias("total")
    )


def best_cutoff(points: DataFrame, group: Sequence[str] = (), low: int = 0, high: int | None = None) -> DataFrame:
    """Highest total within a range of cutoffs, all of them without `high`, and the smallest cutoff that reaches it."""
    return (
        points.filter((F.col("cutoff") >= low) & (F.lit(True) if high is None else F.col("cutoff") <= high))
        .groupBy(*group)
        .agg(
            F.max("total").alias("best_total"),
            F.max_by(F.col("cutoff"), F.struct("total", -F.col("cutoff"))).alias("best_cutoff"),
        )
    )


def smoothed(points: DataFrame, group: Sequence[str] = (), k: int = 20, value: str = "total") -> DataFrame:
    """Centred moving average over the cutoff grid, null where the window is incomplete.

    An even k reaches one point further ahead than back. A group holds one point per cutoff.
    """
    around = Window.partitionBy(*group).orderBy("cutoff").rowsBetween(-((k - 1) // 2), k // 2)
    return points.select(
        "*", F.when(F.count(value).over(around) == k, F.avg(value).over(around)).alias("smooth")
    )


def gain_matrix(points: DataFrame, cutoffs: Sequence[int], replicate: str = "replicate") -> DataFrame:
    """Replicate x cutoff table of totals, columns named e<cutoff>."""
    wide = points.groupBy(replicate).pivot("cutoff", [int(c) for c in cutoffs]).agg(F.max("total"))
    return wide.select(replicate, *[F.col(str(c)).alias(f"e{c}") for c in cutoffs])


def mean_gains(points: DataFrame) -> DataFrame:
    """Mean total per cutoff over the replicates that reach it."""
    return points.groupBy("cutoff").agg(F.avg("total").alias("total"))


def ledger_row(points: DataFrame, cutoffs: Sequence[int], experiment: str) -> DataFrame:
    """One wide row of mean totals, columns named e<cutoff>."""
    return points.agg(
        *[F.avg(F.when(F.col("cutoff") == c, F.col("total"))).alias(f"e{c}") for c in cutoffs],
        F.lit(experiment).alias("experiment"),
    )


def mark_first(
    df: DataFrame, n: int, score: str = "score", keys: Sequence[str] = ("id", "ym"), group: Sequence[str] = ()
) -> DataFrame:
    """Flag the n rows with the highest score."""
    return running(df, _best_first(score, keys), group).withColumn("predicted", (F.col("rank") <= n).cast("int"))


def consensus_submission(
    curve: DataFrame, target: Column, replicate: str = "replicate", keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Mark the customers up to the rank whose running gain is nearest to `target`.

    The nearest row over all replicates picks the replicate and the rank; ties go to the
    first replicate and the lowest rank.
    """
    nearest = (
        curve.select(replicate, "rank", F.abs(F.col("gain_acum") - target).alias("off"))
        .orderBy("off", replicate, "rank")
        .limit(1)
        .agg(F.struct(F.first(replicate).alias("replicate"), F.first("rank").alias("rank")))
        .scalar()
    )
    return curve.filter(F.col(replicate) == nearest["replicate"]).select(
        *keys, "rank", (F.col("rank") <= nearest["rank"]).cast("int").alias("predicted")
    )


def campaign_gain(
    truth: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str] = ("id", "ym"),
    label: str = "label",
    hit: int = 780000,
    cost: int = -20000,
    group: Sequence[str] = (),
) -> DataFrame:
    """Total gain of the flagged customers, looked up in the truth by key.

    Rows are first counted per (flag, class), so only the counts are weighed.
    """
    flagged = truth.join(predictions.select(*keys, *group, "predicted"), list(keys), "left")
    counts = flagged.groupBy(*group, "predicted", label).agg(F.count(F.lit(1)).alias("qty"))
    worth = F.col("qty") * row_gain(label, LEAVES_IN_2, hit, cost)
    return counts.groupBy(*group).agg(
        F.coalesce(F.sum(F.when(F.col("predicted") == 1, worth)), F.lit(0)).cast("bigint").alias("total")
    )


def ensemble_mean(
    scores: DataFrame, keys: Sequence[str] = ("id", "ym"), score: str = "score", carry: Sequence[str] = ()
) -> DataFrame:
    """Mean score per row over the models; `carry` names columns that are the same for all of them."""
    return scores.groupBy(*keys).agg(F.avg(score).alias(score), *[F.first(c).alias(c) for c in carry])


def score_summary(scores: DataFrame, score: str = "score", digits: int = 4) -> DataFrame:
    """Range of the scores and how many distinct rounded values they take."""
    rounded = scores.groupBy(F.round(score, digits).alias("_r")).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi"))
    return rounded.agg(
        F.min("_lo").alias("min_score"), F.max("_hi").alias("max_score"), F.count("_r").alias("distinct_rounded")
    )


def distinct_scores(scores: DataFrame, score: str = "score", digits: int = 4) -> DataFrame:
    return scores.select(F.round(score, digits).alias(score)).distinct()
