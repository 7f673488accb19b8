"""Statistics per zone and pixels inside polygons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import clamp, floor_div
from silvagrid.plans.joins import attach

#: Width in cells of the pieces polygon spans are cut into for the equi-join.
SPAN_BIN = 64


def polygon_spans(edges: DataFrame) -> DataFrame:
    """Scan polygons to horizontal spans ``zone_id, r, x_in, x_out`` (even-odd rule).

    An edge meets the centre line of the rows between its ends; the meeting
    points of a zone on a row, taken in order and in pairs, bound its inside.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.when(F.ceil(low - 0.5) < F.ceil(high - 0.5), F.sequence(F.ceil(low - 0.5), F.ceil(high - 0.5) - 1))
    crossings = edges.withColumn("r", F.explode(rows))
    py = F.col("r") + 0.5
    x = (F.col("x2") - F.col("x1")) * (py - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    line = Window.partitionBy("zone_id", "r").orderBy("x")
    return (
        crossings.select("zone_id", F.col("r").cast("int").alias("r"), x.alias("x"))
        .withColumn("_i", F.row_number().over(line))
        .withColumn("x_out", F.lead("x").over(line))
        .filter(F.col("_i") % 2 == 1)
        .select("zone_id", "r", F.col("x").alias("x_in"), "x_out")
    )


def points_in_polygon(px: DataFrame, edges: DataFrame) -> DataFrame:
    """Pixels whose centre ``(c + 0.5, r + 0.5)`` lies in a zone: px columns plus ``zone_id``.

    Spans are cut into bins of ``SPAN_BIN`` columns, so the join is on
    ``(r, bin)`` with only the span ends tested afterwards. Spark broadcasts a small
    set of pieces and joins a large one by shuffle.
    """
    centre = F.col("c") + 0.5
    spans = polygon_spans(edges)
    bins = F.sequence(floor_div(F.col("x_in"), SPAN_BIN), floor_div(F.col("x_out"), SPAN_BIN))
    pieces = spans.withColumn("_bin", F.explode(bins))
    binned = px.withColumn("_bin", floor_div(F.col("c"), SPAN_BIN))
    return (
        attach(binned, pieces, ["r", "_bin"])
        .filter((F.col("x_in") <= centre) & (centre < F.col("x_out")))
        .drop("_bin", "x_in", "x_out")
    )


def zone_sums(px: DataFrame, by: Sequence[str] = ("zone_id",)) -> DataFrame:
    """Mergeable partial statistics: one row per zone, whatever the pixel count."""
    return px.groupBy(*by).agg(
        F.count("dn").alias("n_px"),
        F.sum("dn").alias("dn_sum"),
        F.min("dn").alias("dn_min"),
        F.max("dn").alias("dn_max"),
        F.sum("cls").alias("n_forest"),
        F.count("cls").alias("n_cls"),
    )


def zonal_stats(px: DataFrame, zones: DataFrame) -> DataFrame:
    """Count, mean, range and forest share per named zone."""
    sums = zone_sums(px)
    return sums.join(zones, "zone_id").select(
        "zone_id",
        "zone",
        "region",
        "n_px",
        F.try_divide("dn_sum", "n_px").alias("dn_mean"),
        "dn_min",
        "dn_max",
        F.try_divide("n_forest", "n_cls").alias("forest_share"),
    )


def _merged() -> list:
    n, f = F.sum("n_px"), F.sum("n_forest")
    return [
        n.alias("n_px"),
        F.try_divide(F.sum("dn_sum"), n).alias("dn_mean"),
        F.min("dn_min").alias("dn_min"),
        F.max("dn_max").alias("dn_max"),
        f.alias("n_forest"),
    ]


def zonal_rollup(px: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone, region and grand totals. Pixels are reduced to zone rows before the
    grouping sets multiply them. Zones without a name are one zone NULL of region NULL, so that totals hold
    every pixel; ``level`` tells their row from a total."""
    return (
        zone_sums(px)
        .join(zones, "zone_id", "left")
        .rollup("region", "zone")
        .agg(F.grouping_id().cast("int").alias("level"), *_merged())
    )


def zonal_cube(px: DataFrame, zones: DataFrame) -> DataFrame:
    """All combinations of region and scene; pixels of zones without a name are of region NULL."""
    return (
        zone_sums(px, ("scene_id", "zone_id"))
        .join(zones, "zone_id", "left")
        .cube("region", "scene_id")
        .agg(F.grouping_id().cast("int").alias("level"), *_merged())
    )


def zonal_histogram(px: DataFrame, bins: int = 8) -> DataFrame:
    """Counts of grey levels 0..255 in ``bins`` (1 to 256) equal steps as columns ``b0..``, one row
    per zone; levels outside count for the first or last step."""
    if not 1 <= bins <= 256:
        raise ValueError("bins must lie between 1 and 256")
    step = F.floor(F.col("dn").cast("long") * bins / 256)
    counts = (
        px.filter("dn is not null")
        .groupBy("zone_id", clamp(step, 0, bins - 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    wide = counts.groupBy("zone_id").pivot("bin", list(range(bins))).agg(F.sum("n"))
    return wide.select("zone_id", *[F.coalesce(F.col(f"`{i}`"), F.lit(0)).alias(f"b{i}") for i in range(bins)])


def zone_coverage(px: DataFrame, zones: DataFrame) -> DataFrame:
    """Valid pixels per zone, zero for zones without any."""
    counts = px.groupBy("zone_id").agg(F.count("dn").alias("n_valid"))
    return zones.join(counts, "zone_id", "left").select(
        "zone_id", "zone", F.coalesce("n_valid", F.lit(0)).alias("n_valid")
    )


def distinct_classes(px: DataFrame) -> DataFrame:
    """Exact number of grey levels per zone; duplicates are removed map-side."""
    levels = px.filter("dn is not null").groupBy("zone_id", "dn").agg(F.count("*").alias("n"))
    return levels.groupBy("zone_id").agg(F.count("*").alias("n_levels"), F.sum("n").alias("n_px"))


def distinct_classes_approx(px: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Approximate number of grey levels per zone."""
    return px.groupBy("zone_id").agg(F.approx_count_distinct("dn", rsd).alias("n_levels"))
