"""Binary morphology on 0/1 class maps (NULL cells take no part)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators.focal import focal_pass
from silvagrid.plans.blocks import BLOCK, own_cells, to_blocks


def morph_pass(blocks: DataFrame, radius: int, *steps: str) -> DataFrame:
    """Apply ``min`` / ``max`` steps to ``cls`` in a table already in block layout.

    The blocks must carry a halo of at least ``radius * len(steps)``.
    """
    for step in steps:
        done = focal_pass(blocks, radius, _new=(step, F.col("cls")))
        blocks = done.withColumn("cls", F.when(F.col("cls").isNotNull(), F.col("_new"))).drop("_new")
    return blocks


def _morph(mask: DataFrame, radius: int, block: int, *steps: str) -> DataFrame:
    blocks = to_blocks(mask.select(*CELL, "cls"), radius * len(steps), block)
    return own_cells(morph_pass(blocks, radius, *steps), block).select(*CELL, "cls")


def erode(mask: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return _morph(mask, radius, block, "min")


def dilate(mask: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return _morph(mask, radius, block, "max")


def morph_open(mask: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Erode, then dilate; both on one exchange with a doubled halo."""
    return _morph(mask, radius, block, "min", "max")


def morph_close(mask: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Dilate, then erode."""
    return _morph(mask, radius, block, "max", "min")


def boundary_pixels(mask: DataFrame, block: int = BLOCK) -> DataFrame:
    """Forest pixels lost by one erosion, as ``scene_id, r, c``."""
    blocks = to_blocks(mask.select(*CELL, "cls"), 1, block)
    near = focal_pass(blocks, 1, _lo=("min", F.col("cls")))
    return own_cells(near, block).filter("cls = 1 and _lo = 0").select(*CELL)


def perimeter(mask: DataFrame, block: int = BLOCK) -> DataFrame:
    """Number of boundary pixels per scene."""
    return boundary_pixels(mask, block).groupBy("scene_id").agg(F.count("*").alias("n_boundary"))
