"""Shared expressions on text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words(text: Column | str) -> Column:
    """The words of a text (runs of anything but blanks) as an array; null and blank texts have none."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def n_words(text: Column | str) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, leaving every other letter alone."""
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]
