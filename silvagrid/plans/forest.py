"""The composed plan: scene pixels in, forest map out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL, idiv
from silvagrid.operators.extend import TILE_COLUMNS
from silvagrid.operators.focal import focal_pass
from silvagrid.operators.morphology import morph_pass
from silvagrid.operators.radiometry import histogram, percentile_stretch, percentiles
from silvagrid.operators.regions import block_runs, sieve_runs, to_pixels
from silvagrid.operators.threshold import is_forest, otsu_from_histogram, otsu_levels
from silvagrid.operators.tileform import stretched_mean, threshold_and_open, tile_runs
from silvagrid.plans.blocks import BLOCK, own_cells, to_blocks
from silvagrid.plans.joins import attach
from silvagrid.plans.staging import stage
from silvagrid.sources.tiles import tiles_to_pixels


def smoothed(stretched: DataFrame, radius: int, block: int) -> DataFrame:
    """``scene_id, r, c, smooth``: focal mean rounded to a whole grey level."""
    blocks = to_blocks(stretched.select(*CELL, "dn"), radius, block)
    sums = own_cells(focal_pass(blocks, radius, _s=("sum", F.col("dn")), _k=("n", F.col("dn"))), block)
    level = F.when(F.col("dn").isNotNull(), idiv(F.col("_s") * 2 + F.col("_k"), F.col("_k") * 2).cast("int"))
    return sums.select(*CELL, level.alias("smooth"))


def forest_extract(
    px: DataFrame,
    polarity: str = "dark",
    radius: int = 1,
    min_px: int = 4,
    connectivity: int = 8,
    block: int = BLOCK,
) -> DataFrame:
    """Percentile stretch, focal mean, Otsu per scene, opening, sieve.

    Output ``scene_id, r, c, cls`` (1 forest, 0 other, NULL nodata), one row per
    input pixel. Pixels are exchanged twice: for the mean, whose result is staged
    because both the threshold and the map read it, and for the opening, on whose
    partitions the runs are cut. After that only runs move.
    """
    stretched = percentile_stretch(px.select(*CELL, "dn"))
    smooth = stage(smoothed(stretched, radius, block), "smooth")
    cut = attach(smooth, otsu_levels(smooth, "smooth"), ["scene_id"], "left")
    mask = cut.select(*CELL, is_forest(F.col("smooth"), F.col("threshold"), polarity).alias("cls"))
    opened = own_cells(morph_pass(to_blocks(mask, 2 * radius, block), radius, "min", "max"), block)
    return to_pixels(sieve_runs(block_runs(opened), min_px, connectivity, block), "cls")


def forest_extract_tiles(
    tiles: DataFrame,
    size: int,
    polarity: str = "dark",
    radius: int = 1,
    min_px: int = 4,
    connectivity: int = 8,
) -> DataFrame:
    """``forest_extract`` for scenes stored as tiles of pitch ``size``; same result.

    Histograms and regions are the same Spark jobs; the two neighbourhood steps
    work on arrays, and only border strips and runs are exchanged as rows.
    """
    tiles = tiles.select(*TILE_COLUMNS)
    bounds = percentiles(tiles_to_pixels(tiles, size))
    smooth = stage(stretched_mean(attach(tiles, bounds, ["scene_id"], "left"), radius, size), "smooth")
    levels = otsu_levels(tiles_to_pixels(smooth, size))
    opened = threshold_and_open(attach(smooth, levels, ["scene_id"], "left"), radius, size, polarity)
    per_block = max(1, BLOCK // size)
    return to_pixels(sieve_runs(tile_runs(opened, size, per_block), min_px, connectivity, size * per_block), "cls")


def forest_per_scene(px: DataFrame, polarity: str = "dark") -> DataFrame:
    """The minimum answer: Otsu threshold and forest share of each scene, all from
    the histogram."""
    hist = histogram(px)
    forest = is_forest(F.col("dn"), F.col("threshold"), polarity)
    return (
        hist.join(otsu_from_histogram(hist), "scene_id")
        .groupBy("scene_id")
        .agg(
            F.max("threshold").alias("threshold"),
            F.sum("n").alias("n_px"),
            F.sum(forest * F.col("n")).alias("n_forest"),
        )
    )
