"""The log of a parameter search: one JSON record per trial."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.search import REJECTED

# The record layout of an existing log.
TRIAL_SCHEMA = """
trial_number int, params map<string,double>, value double, datetime string, state string,
configuracion struct<semilla: array<int>, mes_train: array<int>, mes_validacion: array<int>>
"""


def append_trials(trials: DataFrame, path: str) -> None:
    """Append records; nothing that is already there is read or rewritten."""
    trials.write.mode("append").json(path)


def append_trial(
    spark: SparkSession,
    path: str,
    number: int,
    params: dict[str, float],
    value: float,
    seeds: Sequence[int] = (),
    train_periods: Sequence[int] = (),
    valid_periods: Sequence[int] = (),
) -> None:
    config = ([int(s) for s in seeds], [int(p) for p in train_periods], [int(p) for p in valid_periods])
    now = datetime.now(timezone.utc).isoformat()
    row = (int(number), params, float(value), now, "COMPLETE", config)
    append_trials(spark.createDataFrame([row], TRIAL_SCHEMA).coalesce(1), path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRIAL_SCHEMA).json(path)


def trial_numbers(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the logged trials; empty if there is no log yet."""
    try:
        return {r[0] for r in read_trials(spark, path).select("trial_number").distinct().collect()}
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return set()
        raise


def fitted(trials: DataFrame) -> DataFrame:
    return trials.filter(F.col("value") > REJECTED)


def best_params(trials: DataFrame) -> dict[str, float]:
    """Parameters of the trial with the highest value, the first one on ties. Rejected trials were never fitted."""
    best = fitted(trials).orderBy(F.desc("value"), "trial_number").select("params").first()
    if best is None:
        raise ValueError("the log has no trial that was fitted")
    return best["params"]
