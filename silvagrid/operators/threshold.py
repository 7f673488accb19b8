"""From brightness to a 0/1 class map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators.focal import focal
from silvagrid.operators.radiometry import cumulative, histogram
from silvagrid.plans.blocks import BLOCK
from silvagrid.plans.joins import attach


def is_forest(value: Column, threshold: Column, polarity: str) -> Column:
    """1 forest, 0 other, NULL where either side is NULL. Dark forest lies at or
    below the threshold, bright forest above it."""
    if polarity not in ("dark", "bright"):
        raise ValueError("polarity is 'dark' or 'bright'")
    hit = value <= threshold if polarity == "dark" else value > threshold
    return hit.cast("int")


def threshold_fixed(px: DataFrame, threshold: int, polarity: str = "dark") -> DataFrame:
    return px.withColumn("cls", is_forest(F.col("dn"), F.lit(threshold), polarity))


def otsu_from_histogram(hist: DataFrame) -> DataFrame:
    """Otsu threshold per scene: the grey level that maximises the between-class
    variance when it closes the lower class; lowest level on ties, NULL when the
    scene has a single level."""
    scene = Window.partitionBy("scene_id")
    weighted = (
        cumulative(hist)
        .withColumn("csum", F.sum(F.col("dn") * F.col("n")).over(scene.orderBy("dn")))
        .withColumn("tsum", F.sum(F.col("dn") * F.col("n")).over(scene))
    )
    n0, n1 = F.col("cum").cast("double"), (F.col("tot") - F.col("cum")).cast("double")
    gap = F.col("csum") / n0 - (F.col("tsum") - F.col("csum")) / F.nullif(n1, F.lit(0.0))
    between = weighted.withColumn("between", n0 * n1 * gap * gap)
    order = F.when(F.col("between").isNotNull(), F.struct(F.col("between"), -F.col("dn")))
    return between.groupBy("scene_id").agg(F.max_by("dn", order).alias("threshold"))


def otsu_levels(px: DataFrame, value: str = "dn") -> DataFrame:
    """``scene_id, threshold``."""
    return otsu_from_histogram(histogram(px, value))


def threshold_otsu(px: DataFrame, polarity: str = "dark", value: str = "dn") -> DataFrame:
    """Class map by each scene's own Otsu threshold."""
    cut = attach(px, otsu_levels(px, value), ["scene_id"], "left")
    return cut.withColumn("cls", is_forest(F.col(value), F.col("threshold"), polarity)).drop("threshold")


def threshold_local(
    px: DataFrame, radius: int = 1, offset: int = 0, polarity: str = "dark", block: int = BLOCK
) -> DataFrame:
    """Compare with the local mean less (dark) or plus (bright) ``offset``,
    in whole numbers: ``dn * n`` against ``sum -/+ offset * n``."""
    near = focal(px, radius, block=block, _s="sum", _k="n")
    scaled = F.col("dn") * F.col("_k")
    if polarity == "dark":
        hit = scaled < F.col("_s") - offset * F.col("_k")
    else:
        hit = scaled > F.col("_s") + offset * F.col("_k")
    return near.select(*CELL, hit.cast("int").alias("cls"))
