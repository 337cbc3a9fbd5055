"""Importance tables, gain curves, predictions, submissions and the experiment ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.gain import best_cutoff, ledger_row


def write_table(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def read_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def write_importances(importances: DataFrame, path: str) -> None:
    """Feature, Importance by falling importance, in as many files as the sort has ranges."""
    named = importances.select(F.col("feature").alias("Feature"), F.col("importance").alias("Importance"))
    write_table(named.orderBy(F.desc("Importance"), "Feature"), path)


def read_importances(spark: SparkSession, path: str, by_importance: bool = True) -> DataFrame:
    """Importances from CSV. Both columns are required; of a repeated feature the last line counts.

    "Last" is after sorting by falling importance, that is the smallest value, when asked to sort.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = {"Feature", "Importance"} - set(raw.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    file = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    one = raw.select(F.col("Feature").alias("feature"), F.col("Importance").cast("double").alias("importance"), file.alias("_line"))
    if not by_importance:
        # files in the order of their names, as they are written
        return one.groupBy("feature").agg(F.max_by("importance", "_line").alias("importance"))
    return one.groupBy("feature").agg(F.min("importance").alias("importance")).orderBy(F.desc("importance"), "feature")


def write_curve(curve: DataFrame, path: str, low: int = 0, high: int | None = None) -> DataFrame:
    """Write a gain curve as CSV and return its best total and the fewest contacts that reach it."""
    write_table(curve, path)
    points = curve.select(F.col("rank").alias("cutoff"), F.col("gain_acum").alias("total"))
    return best_cutoff(points, low=low, high=high)


def write_scores(scored: DataFrame, path: str, columns: Sequence[str] = ("id", "score")) -> None:
    write_table(scored.select(*columns), path)


PREDICTION_SCHEMA = "id bigint, ym int, score double, gain_acum bigint, replicate int"


def append_predictions(predictions: DataFrame, path: str) -> None:
    """Append one or more replicates as TSV, one folder per replicate."""
    predictions.write.mode("append").option("header", True).option("sep", "\t").partitionBy("replicate").csv(path)


def read_predictions(spark: SparkSession, path: str, schema: str = PREDICTION_SCHEMA) -> DataFrame:
    return read_table(spark, path, schema, "\t")


def write_submission(marked: DataFrame, path: str, id: str = "id") -> None:
    write_table(marked.select(F.col(id), F.col("predicted").alias("Predicted")), path)


def append_ledger(points: DataFrame, cutoffs: Sequence[int], experiment: str, path: str) -> None:
    """Append the mean totals of one experiment as a wide row."""
    write_table(ledger_row(points, cutoffs, experiment), path, "\t", "append")
