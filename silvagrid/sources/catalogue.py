"""Scene catalogue, metadata, clipping and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scene_catalogue(px: DataFrame) -> DataFrame:
    """Extent, cell and valid counts and grey-level summary per scene."""
    return px.groupBy("scene_id").agg(
        F.min("r").alias("r0"),
        F.max("r").alias("r1"),
        F.min("c").alias("c0"),
        F.max("c").alias("c1"),
        F.count("*").alias("n_cells"),
        F.count("dn").alias("n_valid"),
        F.min("dn").alias("dn_min"),
        F.max("dn").alias("dn_max"),
        F.sum("dn").alias("dn_sum"),
        (F.sum("dn") / F.count("dn")).alias("dn_mean"),
    )


def scene_props(arrivals: DataFrame, column: str = "props") -> DataFrame:
    """Parse the JSON metadata of each arrival into ``map<string,string>`` plus key ``k``."""
    parsed = F.from_json(column, T.MapType(T.StringType(), T.StringType()))
    return arrivals.withColumn("props_map", parsed).withColumn("k", F.col("props_map")["k"].cast("int"))


def clip_bbox(px: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    """Cells of the closed box; on a Parquet pixel table the filter reaches the scan."""
    return px.filter(F.col("r").between(r0, r1) & F.col("c").between(c0, c1))


def scene_grid(extent: DataFrame) -> DataFrame:
    """All cells of each scene's box ``r0..r1, c0..c1``.

    Rows are exploded first and spread, then columns, so a very large scene is
    not generated by a single task.
    """
    rows = extent.select("scene_id", "c0", "c1", F.explode(F.sequence("r0", "r1")).alias("r"))
    return rows.repartition("scene_id", "r").select(
        "scene_id", "r", F.explode(F.sequence("c0", "c1")).alias("c")
    )


def densify(px: DataFrame) -> DataFrame:
    """Add a NULL row for each absent cell of a scene's box.

    For steps that take nodata as a NULL row; focal operators do without.
    """
    box = px.groupBy("scene_id").agg(
        F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")
    )
    return scene_grid(box).join(px, ["scene_id", "r", "c"], "left")
