"""Features and filters that need only the row itself."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.columns import replace_columns, total

# How a quarter's activity is scaled up for customers of one, two and three months.
NEW_CUSTOMER_FACTORS = {1: 5.0, 2: 2.0, 3: 1.2}


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop drifting columns; names that are not there are ignored."""
    return df.drop(*columns)


def keep_periods(df: DataFrame, periods: Sequence[int], period: str = "ym") -> DataFrame:
    """Rows of the listed periods; reads only those partitions of a table partitioned by period."""
    return df.filter(F.col(period).isin(*periods))


def tenure_normalised(activity: str, tenure: str) -> Column:
    """Activity of a quarter, scaled up for customers who were there for part of it."""
    value = F.col(activity).cast("double")
    factor = F.lit(1.0)
    for months, by in NEW_CUSTOMER_FACTORS.items():
        factor = F.when(F.col(tenure) == months, F.lit(by)).otherwise(factor)
    return value * factor


def ratio(numerator: str, denominator: str) -> Column:
    return F.try_divide(F.col(numerator).cast("double"), F.col(denominator).cast("double"))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns with nulls as zero."""
    return total(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns)


def add_row_sum(df: DataFrame, columns: Sequence[str], name: str = "suma_m_visa_master") -> DataFrame:
    """Add the sum of a family; without columns the table is unchanged."""
    return df.select("*", row_sum(columns).alias(name)) if columns else df


def zero_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: F.col(c).cast("double") for c in columns})
