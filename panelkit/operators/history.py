"""Features from a customer's own history, over one shared window."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import numeric, ordinal, replace_columns

ROW = "_row"


def add_history(
    df: DataFrame,
    columns: Iterable[str],
    id: str = "id",
    period: str = "ym",
    lags: Sequence[int] = (),
    chained: int = 0,
    anchored: Sequence[int] = (),
    slope: bool = False,
    extremes: bool = False,
    ratios: bool = False,
    window: int = 6,
    calendar: bool = False,
    yyyymm: bool = True,
    chained_name: str = "{c}_delta_lag_{i}",
    lag_name: str = "{c}_lag_{i}",
) -> DataFrame:
    """Add lags, deltas, slope, window extremes and ratios for all columns at once.

    lags:      c as of i snapshots ago
    chained:   change between consecutive snapshots, `chained` steps back
    anchored:  change between now and i snapshots ago
    slope:     least-squares slope over the last `window` snapshots
    extremes:  min, max and mean over the same window
    ratios:    c over the window's mean and over its maximum
    Window values need two non-null snapshots. Deltas and window values are made for numeric columns only.

    Lags count the customer's snapshots; with calendar=True they count periods, and a
    missing period gives null. Everything shares one shuffle and one sort.
    """
    present = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not present:
        return df
    numbers = numeric(df, present)
    history = Window.partitionBy(id).orderBy(period)
    if calendar:
        by_ordinal = Window.partitionBy(id).orderBy(ordinal(period, yyyymm))

    def back(c: str, i: int) -> Column:
        if i == 0:
            return F.col(c)
        if calendar:
            return F.max(c).over(by_ordinal.rangeBetween(-i, -i))
        return F.lag(c, i).over(history)

    new: dict[str, Column] = {}
    for c in present:
        for i in lags:
            new[lag_name.format(c=c, i=i)] = back(c, i)
    for c in numbers:
        for i in range(1, chained + 1):
            new[chained_name.format(c=c, i=i)] = back(c, i - 1) - back(c, i)
        for i in anchored:
            new[f"{c}_delta{i}"] = F.col(c) - back(c, i)

    rows = df
    if slope or extremes or ratios:
        recent = history.rowsBetween(1 - window, 0)
        if slope:
            rows = df.select("*", F.row_number().over(history).alias(ROW))
        for c in numbers:
            enough = F.count(c).over(recent) >= 2
            mean = F.when(enough, F.avg(c).over(recent))
            top = F.when(enough, F.max(c).over(recent))
            if slope:
                new[f"{c}_tend{window}"] = F.when(enough, F.regr_slope(F.col(c), F.col(ROW)).over(recent))
            if extremes:
                new[f"{c}_min{window}"] = F.when(enough, F.min(c).over(recent))
                new[f"{c}_max{window}"] = top
                new[f"{c}_avg{window}"] = mean
            if ratios:
                new[f"{c}_ratioavg{window}"] = F.try_divide(F.col(c).cast("double"), mean)
                new[f"{c}_ratiomax{window}"] = F.try_divide(F.col(c).cast("double"), top.cast("double"))
    return rows.select(*[F.col(c) for c in df.columns], *[e.alias(n) for n, e in new.items()])


def scale_by_own_p95(df: DataFrame, columns: Sequence[str], id: str = "id", period: str = "ym") -> DataFrame:
    """Divide by the highest 95th percentile of |c| the customer has reached so far, keeping the sign.

    The percentile sees only the customer's past and present; its frame is as short as
    the customer's history.
    """
    so_far = Window.partitionBy(id).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    marks = {c: f"_p95_{c}" for c in columns}
    marked = df.select("*", *[F.percentile(F.abs(F.col(c)), 0.95).over(so_far).alias(m) for c, m in marks.items()])
    # |c| times its sign is c itself
    scaled = {c: F.try_divide(F.col(c).cast("double"), F.max(m).over(so_far)) for c, m in marks.items()}
    return replace_columns(marked, scaled).select(*df.columns)
