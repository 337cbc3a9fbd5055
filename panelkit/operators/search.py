"""Search space, trial statistics and training schedules."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges of the searched parameters, exponents of two except for the share of features,
# and the score of a rejected trial. The upper end for rows per leaf depends on the training rows.
SEARCH_RANGES = {
    "num_iterations_exp": (0.0, 11.1),
    "learning_rate_exp": (-8.0, -1.0),
    "feature_fraction": (0.05, 1.0),
    "min_data_exp": (0.0, None),
    "num_leaves_exp": (1.0, 10.0),
}
REJECTED = -1000000.0


Ranges = dict[str, tuple[float, float | None]]


def suggest(draws: DataFrame, rows: Column | int, ranges: Ranges | None = None) -> DataFrame:
    """Spread unit draws, one column per searched parameter, over the search ranges; `ranges` replaces some of them."""
    within = SEARCH_RANGES | (ranges or {})
    n = rows if isinstance(rows, Column) else F.lit(rows)

    def at(name: str) -> Column:
        low, high = within[name]
        top = F.log2(n / F.lit(2.0)) if high is None else F.lit(high)
        return F.lit(low) + F.col(name) * (top - F.lit(low))

    return draws.select(*[at(c).alias(c) if c in SEARCH_RANGES else F.col(c) for c in draws.columns])


def to_params(suggested: DataFrame) -> DataFrame:
    """Turn suggested values into the learner's parameters; other columns stay."""

    def power(name: str) -> Column:
        return F.pow(F.lit(2.0), F.col(name))

    return suggested.select(
        *[c for c in suggested.columns if c not in SEARCH_RANGES],
        F.rint(power("num_iterations_exp")).cast("bigint").alias("num_iterations"),
        power("learning_rate_exp").alias("learning_rate"),
        "feature_fraction",
        F.rint(power("min_data_exp")).cast("bigint").alias("min_data_in_leaf"),
        F.rint(power("num_leaves_exp")).cast("bigint").alias("num_leaves"),
    )


def decode_trials(draws: DataFrame, rows: Column | int, ranges: Ranges | None = None) -> DataFrame:
    """Parameters of unit draws for a number of training rows, impossible ones flagged.

    A trial is rejected when its leaves could not all reach their minimum size.
    """
    n = rows if isinstance(rows, Column) else F.lit(rows)
    decoded = to_params(suggest(draws, n, ranges)).withColumn("rows", n.cast("bigint"))
    return decoded.withColumn("rejected", F.col("min_data_in_leaf") * F.col("num_leaves") > F.col("rows"))


def draw_trials(n: int, seed: int) -> list[dict[str, float]]:
    """Seeded random draws in the unit cube; the n-th draw does not depend on how many are asked for."""
    return [{p: random.Random(f"{seed}-{i}-{p}").random() for p in SEARCH_RANGES} for i in range(n)]


def trial_stats(trials: DataFrame) -> DataFrame:
    return trials.agg(
        F.count(F.lit(1)).alias("trials"),
        F.max("value").alias("best"),
        F.min("value").alias("worst"),
        F.avg("value").alias("mean"),
    )


def top_trials(trials: DataFrame, n: int = 5) -> DataFrame:
    """The n best trials; the earlier one wins a tie."""
    return trials.orderBy(F.desc("value"), "trial_number").limit(n)


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the highest value. A table without a trial that was fitted gives no row."""
    return top_trials(trials.filter(F.col("value") > REJECTED), 1)


def rolling_schedule(df: DataFrame, period: str = "ym", context: int = 4, gap: int = 1) -> DataFrame:
    """For each period to be scored, the earlier periods to train on: (score_period, train_period).

    Positions are counted over the periods present. The `gap` periods just before the
    scored one are left out because their labels are not known yet, and at most `context` are used.
    Works on one row per period.
    """
    line = Window.orderBy(period)
    placed = df.select(period).distinct().select(period, F.row_number().over(line).alias("pos"))
    reach = placed.select(
        F.col(period).alias("score_period"),
        F.explode(F.sequence(F.col("pos") - gap - context, F.col("pos") - gap - 1)).alias("pos"),
    )
    return reach.join(placed, "pos").select("score_period", F.col(period).alias("train_period"))


def schedule_lists(schedule: DataFrame) -> list[tuple[int, list[int]]]:
    """The schedule as plain numbers for a training loop; one entry per period."""
    rows = schedule.groupBy("score_period").agg(F.sort_array(F.collect_set("train_period")).alias("train")).collect()
    return sorted((r["score_period"], list(r["train"])) for r in rows)


def periods(df: DataFrame, period: str = "ym") -> Sequence[int]:
    """Distinct periods of the panel in order; one number per period."""
    return [r[0] for r in df.select(period).distinct().orderBy(period).collect()]
