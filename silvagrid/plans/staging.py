"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage, survives the loss of any executor, is computed
once however often it is read, and has a known size.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; made up only in local mode."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; frames read from them end here."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
