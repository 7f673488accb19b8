"""Pixel table at rest: one folder per scene, cells sorted inside each file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.functions.grid import idiv
from silvagrid.sources.schemas import PIXELS


def write_scene_parquet(px: DataFrame, path: str, rows_per_file: int = 1024) -> None:
    """Write partitioned by scene. Large scenes are cut into bands of image rows,
    so no task writes a whole scene, and sorting gives tight row-group ranges for
    later box filters."""
    (
        px.withColumn("_band", idiv("r", rows_per_file))
        .repartition("scene_id", "_band")
        .sortWithinPartitions("scene_id", "r", "c")
        .drop("_band")
        .write.mode("overwrite")
        .partitionBy("scene_id")
        .parquet(path)
    )


def read_scene_parquet(spark: SparkSession, path: str, scenes: list[int] | None = None) -> DataFrame:
    """Read back; ``scenes`` prunes folders before any file is opened."""
    px = spark.read.schema(PIXELS).parquet(path)
    return px if scenes is None else px.filter(F.col("scene_id").isin(scenes))
