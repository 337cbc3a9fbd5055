"""Repair of columns that went dead in some period, or drifted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import ordinal, replace_columns
from panelkit.functions.durable import settle
from panelkit.functions.quantiles import exact_quantiles

FLAG = "_dead_"


def dead_flags(df: DataFrame, columns: Sequence[str], period: str = "ym", rule: str = "all_zero") -> DataFrame:
    """One row per period and a flag per column that carries no information there.

    rule: "all_zero" - every value is zero or null; "zero_sum" - the values add up to zero.
    """
    if rule == "all_zero":
        flags = [F.max(F.when(F.col(c) != 0, 1)).isNull() for c in columns]
    elif rule == "zero_sum":
        flags = [F.coalesce(F.sum(c), F.lit(0)) == 0 for c in columns]
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return df.groupBy(period).agg(*[f.alias(FLAG + c) for f, c in zip(flags, columns, strict=True)])


def blank_dead_columns(
    df: DataFrame, columns: Sequence[str], period: str = "ym", rule: str = "all_zero"
) -> DataFrame:
    """Null the cells of dead (period, column) blocks; under "zero_sum" only their zeros."""
    flags = settle(dead_flags(df, columns, period, rule))
    flagged = df.join(flags, period, "left")

    def cell(c: str) -> Column:
        gone = F.col(FLAG + c) if rule == "all_zero" else F.col(FLAG + c) & (F.col(c) == 0)
        return F.when(~F.coalesce(gone, F.lit(False)), F.col(c))

    return replace_columns(flagged, {c: cell(c) for c in columns}).select(*df.columns)


def _with_neighbours(flags: DataFrame, period: str) -> DataFrame:
    """Each period of the panel with the one before and the one after it; one row per period."""
    line = Window.orderBy(period)
    return flags.select("*", F.lag(period).over(line).alias("_prev"), F.lead(period).over(line).alias("_next"))


def interpolate_dead_periods(df: DataFrame, columns: Sequence[str], id: str = "id", period: str = "ym") -> DataFrame:
    """Replace dead blocks by the mean of the customer's values one period before and after.

    Null where the customer is missing from either neighbour. The first and the last
    period of the panel are left alone.
    """
    flags = settle(_with_neighbours(settle(dead_flags(df, columns, period)), period))
    flagged = df.join(flags, period, "left")
    history = Window.partitionBy(id).orderBy(period)

    def cell(c: str) -> Column:
        before = F.when(F.lag(period).over(history) == F.col("_prev"), F.lag(c).over(history))
        after = F.when(F.lead(period).over(history) == F.col("_next"), F.lead(c).over(history))
        inner = F.col("_prev").isNotNull() & F.col("_next").isNotNull()
        return F.when(F.col(FLAG + c) & inner, (before + after) / F.lit(2.0)).otherwise(F.col(c))

    return replace_columns(flagged, {c: cell(c) for c in columns}).select(*df.columns)


def interpolate_zeros(
    df: DataFrame,
    columns: Sequence[str],
    id: str = "id",
    period: str = "ym",
    yyyymm: bool = True,
) -> DataFrame:
    """Fill a customer's zeros on the straight line in time between the nearest nonzero values; those outside stay."""
    time = ordinal(period, yyyymm)
    history = Window.partitionBy(id).orderBy(period)
    past = history.rowsBetween(Window.unboundedPreceding, -1)
    future = history.rowsBetween(1, Window.unboundedFollowing)

    def cell(c: str) -> Column:
        known = F.when(F.col(c) != 0, F.struct(time.alias("t"), F.col(c).cast("double").alias("v")))
        a = F.last(known, ignorenulls=True).over(past)
        b = F.first(known, ignorenulls=True).over(future)
        line = a["v"] + (b["v"] - a["v"]) * (time - a["t"]) / (b["t"] - a["t"])
        between = (F.col(c) == 0) & a.isNotNull() & b.isNotNull()
        return F.when(between, line).otherwise(F.col(c).cast("double"))

    return replace_columns(df, {c: cell(c) for c in columns})


def correct_median_drift(
    df: DataFrame,
    columns: Sequence[str],
    target: int,
    back: int = 6,
    period: str = "ym",
    yyyymm: bool = True,
    mode: str = "months",
) -> DataFrame:
    """Rescale one period so that its medians match those of the `back` periods before it.

    A column is left alone when the target median is zero or missing. mode="reference"
    subtracts `back` from the period number itself, which crosses a year wrongly.
    """
    if mode == "reference":
        when, end = F.col(period), target
    elif mode == "months":
        when, end = ordinal(period, yyyymm), (target // 100 * 12 + target % 100) if yyyymm else target
    else:
        raise ValueError(f"unknown mode {mode!r}")
    side = F.when(F.col(period) == target, "target").when((when >= end - back) & (when < end), "history")
    known = df.select(side.alias("_side"), *columns).filter("_side is not null")
    medians = exact_quantiles(known, columns, [0.5], ["_side"])

    def median(c: str, which: str) -> Column:
        return F.max(F.when((F.col("column") == c) & (F.col("_side") == which), F.col("value")))

    # a single row with one factor per column
    factors = medians.agg(
        F.struct(*[F.try_divide(median(c, "history"), median(c, "target")).alias(c) for c in columns])
    ).scalar()
    return replace_columns(
        df,
        {
            c: F.when(F.col(period) == target, F.col(c) * F.coalesce(factors[c], F.lit(1.0))).otherwise(
                F.col(c).cast("double")
            )
            for c in columns
        },
    )
