"""Panels derived from the base tables: one row per entity and period.

Sums are rounded to four digits, which the inputs' two digits make exact, so that a
panel does not depend on the order in which rows are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.columns import hash_uniform

MONEY_DIGITS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sum(value: Column) -> Column:
    return F.round(F.sum(value), MONEY_DIGITS)


def _day(column: str) -> Column:
    return F.datediff(F.to_date(column), F.lit("2023-12-31").cast("date"))


def last_day(spark: SparkSession, sf_dir: str) -> Column:
    """Last day of the user panel, straight from the events."""
    return table(spark, sf_dir, "events").agg(F.max(_day("ts"))).scalar()


def last_month(spark: SparkSession, sf_dir: str, name: str, column: str) -> Column:
    """Ordinal of the last month of a table, straight from its rows."""
    return table(spark, sf_dir, name).agg(F.max(F.year(column) * 12 + F.month(column))).scalar()


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user and day; the period is a plain day number."""
    kinds = {"mpurchase": "purchase", "Visa_mclick": "click", "Master_mview": "view"}
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").alias("id"),
            _day("ts").alias("period"),
        )
        .agg(
            F.count(F.lit(1)).alias("cevents"),
            _sum(F.col("value")).alias("mvalue"),
            *[_sum(F.when(F.col("event_type") == kind, F.col("value"))).alias(c) for c, kind in kinds.items()],
        )
    )


def _yyyymm(column: str) -> Column:
    return (F.year(column) * 100 + F.month(column)).alias("ym")


def supplier_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("id"), _yyyymm("l_shipdate"))
        .agg(
            F.count(F.lit(1)).alias("cl"),
            _sum(price).alias("mprice"),
            _sum(price * F.col("l_discount")).alias("Visa_mdisc"),
            _sum(price * F.col("l_tax")).alias("Master_mtax"),
            _sum(F.col("l_quantity")).alias("mqty"),
        )
    )


def customer_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("id"), _yyyymm("o_orderdate"))
        .agg(F.count(F.lit(1)).alias("corders"), _sum(F.col("o_totalprice")).alias("mtotal"))
    )


def dead_month(panel: DataFrame, ym: int = 199806, columns: tuple[str, ...] = ("mprice", "Visa_mdisc")) -> DataFrame:
    """The panel with some columns zeroed in one month, as a broken feed would do."""
    return panel.select(
        *[F.when(F.col("ym") == ym, F.lit(0.0)).otherwise(F.col(c)).alias(c) if c in columns else c for c in panel.columns]
    )


def hash_scores(panel: DataFrame, seeds: tuple[int, ...] = (1, 2, 3, 4, 5)) -> DataFrame:
    """One row per panel row and replicate with a reproducible score."""
    pairs = [F.struct(F.lit(s).alias("replicate"), hash_uniform(s, "id", "period").alias("score")) for s in seeds]
    return panel.select("*", F.explode(F.array(*pairs)).alias("_e")).select(*panel.columns, "_e.replicate", "_e.score")


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by account balance and order total, as z-scores rounded to six digits."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"))
    totals = (
        table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(_sum(F.col("o_totalprice")).alias("y"))
    )
    return customers.join(totals, "id", "left").fillna(0.0, ["y"])
