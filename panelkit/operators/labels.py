"""Attrition labels and binary targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.columns import LEAVES, LEAVES_IN_1, LEAVES_IN_2, STAYS, ordinal


def label_attrition(
    df: DataFrame,
    id: str = "id",
    period: str = "ym",
    yyyymm: bool = True,
    horizon: int = 2,
    name: str = "label",
    last: Column | int | None = None,
) -> DataFrame:
    """Label each row by how soon the customer is missing from the panel.

    BAJA+j: present for the next j-1 periods and absent in the j-th. CONTINUA: present
    for the whole horizon. Null where the panel ends too early to tell: `last` is the
    ordinal of the panel's last period, looked up in the panel unless given, so label
    before filtering periods.
    Windows hold one customer's periods, which the (id, period) key keeps short.
    """
    now = ordinal(period, yyyymm)
    if last is None:
        last = df.agg(F.max(now)).scalar()
    last = last if isinstance(last, Column) else F.lit(last)
    history = Window.partitionBy(id).orderBy(period)
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for j in range(1, horizon + 1):
        ahead = F.lead(now, j).over(history)
        absent = ahead.isNull() | (ahead > now + j)
        label = label.when(absent, F.when(now < last - (j - 1), F.lit(f"{LEAVES}{j}")))
    label = label.otherwise(F.when(now < last - (horizon - 1), F.lit(STAYS)))
    return df.select("*", label.alias(name))


def class_counts(df: DataFrame, by: Sequence[str] = ("ym",), label: str = "label") -> DataFrame:
    """Rows per (period, class); the undetermined class is a group of its own."""
    return df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))


def class_counts_wide(df: DataFrame, classes: Sequence[str], by: str = "ym", label: str = "label") -> DataFrame:
    """Period x class table, undetermined rows under "NA", absent combinations 0."""
    named = df.withColumn(label, F.coalesce(label, F.lit("NA")))
    return named.groupBy(by).pivot(label, [*classes, "NA"]).count().na.fill(0)


def binary_target(label: str = "label", positive: Sequence[str] = (LEAVES_IN_1, LEAVES_IN_2)) -> Column:
    """1 for leavers, 0 for stayers, null where the class is undetermined."""
    return F.when(F.col(label) == STAYS, 0).when(F.col(label).isin(*positive), 1)


def binary_target_filled(label: str = "label", positive: Sequence[str] = (LEAVES_IN_1, LEAVES_IN_2)) -> Column:
    """1 for leavers, 0 for everything else, undetermined rows included."""
    return F.when(F.col(label).isin(*positive), 1).otherwise(0)


def strict_target(label: str = "label", positive: str = LEAVES_IN_2) -> Column:
    """1 only for the class a campaign can still act on."""
    return F.coalesce((F.col(label) == positive).cast("int"), F.lit(0))


def training_flag(period: str, periods: Sequence[int]) -> Column:
    return F.col(period).isin(*periods).cast("byte")


def leaver_class(label: str = "label") -> Column:
    """Two-way class used to colour clusters."""
    return F.when(F.col(label).isin(LEAVES_IN_1, LEAVES_IN_2), "BAJA").when(F.col(label) == STAYS, STAYS)


def with_tenure(
    df: DataFrame, id: str = "id", period: str = "ym", yyyymm: bool = True, mode: str = "months", name: str = "tenure"
) -> DataFrame:
    """Months since the customer's first snapshot.

    mode="reference" subtracts the smallest year and the smallest month-of-year separately.
    """
    customer = Window.partitionBy(id)
    if mode == "months":
        now = ordinal(period, yyyymm)
        value = now - F.min(now).over(customer)
    elif mode == "reference":
        year, month = F.expr(f"`{period}` div 100"), F.col(period) % 100
        value = ((year - F.min(year).over(customer)) * 12 + month - F.min(month).over(customer)).cast("int")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.select("*", value.alias(name))


def established_or_leaving(df: DataFrame, tenure: str = "tenure", cls: str = "leaver", months: int = 12) -> DataFrame:
    """Rows with enough history, plus every leaver."""
    return df.filter((F.col(tenure) >= months) | (F.col(cls) == "BAJA"))
