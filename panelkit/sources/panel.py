"""Reading and writing panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_panel_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, sep: str = ","
) -> DataFrame:
    """Read a CSV panel, gzipped or not, with header. Without a schema the types are inferred.

    A gzip file is read by one task; land it once as parquet with `write_panel`.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    paths = path if isinstance(path, str) else list(path)
    if schema is None:
        return reader.option("inferSchema", True).csv(paths)
    return reader.schema(schema).csv(paths)


def write_panel(df: DataFrame, path: str, period: str = "ym", mode: str = "overwrite") -> None:
    """Land a panel as parquet, one folder per period so that period filters read only theirs.

    The rows of a period are spread over files by AQE's rebalancing, however large it is.
    """
    df.hint("rebalance", F.col(period)).write.mode(mode).partitionBy(period).parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stack_snapshots(*parts: DataFrame) -> DataFrame:
    """Rows of several panels with the same columns, in any column order."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def require_unique_keys(df: DataFrame, keys: Sequence[str] = ("id", "ym")) -> DataFrame:
    """Raise unless the panel has one row per key; the history windows rely on it."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys).limit(1).collect()
    if twice:
        raise ValueError(f"several rows for key {twice[0].asDict()}")
    return df


def write_by_customer(df: DataFrame, name: str, path: str, id: str = "id", period: str = "ym", buckets: int = 64) -> DataFrame:
    """Lay a panel out by customer: a table of hashed buckets, one sorted file each, and read it back.

    Windows over a customer's periods, and joins by customer with tables of as many buckets, then need neither a shuffle
    nor a sort. `name` is the table's in the session's catalog, see attach_by_customer for others.
    """
    spread = df.repartition(buckets, id)
    spread.write.mode("overwrite").bucketBy(buckets, id).sortBy(id, period).option("path", path).saveAsTable(name)
    return read_by_customer(df.sparkSession, name)


def attach_by_customer(
    spark: SparkSession, name: str, path: str, schema: StructType, id: str = "id", period: str = "ym", buckets: int = 64
) -> DataFrame:
    """Name a panel that write_by_customer laid out, in a catalog that doesn't know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{id}`) SORTED BY (`{id}`, `{period}`) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return read_by_customer(spark, name)


def read_by_customer(spark: SparkSession, name: str) -> DataFrame:
    """A panel laid out by customer. Spark trusts the order of a bucket that is a single file."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(name)
