"""Intermediate tables that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    scratch = tempfile.mkdtemp(prefix="panelkit-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir().rstrip("/")


def application_folder(spark: SparkSession) -> str:
    """The application's folder of tables, removed when it ends."""
    sc = spark.sparkContext
    folder = f"{shared_folder(spark)}/panelkit-tables/{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if files.mkdirs(path):
        files.deleteOnExit(path)
    return folder


def settle(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write the rows once and read them back.

    Cuts the lineage, fixes anything that depends on partition numbers, and lets the
    optimizer see the real size, so that it broadcasts the table only when it is below
    spark.sql.autoBroadcastJoinThreshold and shuffles it otherwise. `by` names a column with
    few values; readers of some of them then read only those. All tables of an application lie
    in one folder, which goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    # files are moved into place when the job is committed: what a lost attempt left behind isn't read
    writer = df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "1")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
