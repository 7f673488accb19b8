"""Block layout: square blocks of cells with a copied border.

Each cell goes to its own block and to every block within ``halo`` of it. One
hash exchange on the block key then serves any chain of row windows, column
windows and per-block grouping whose radii sum to at most ``halo``. A block
holds at most ``(block + 2 * halo)**2`` cells, whatever the size of the scene.

A column window reads what the row window left at each row, so every row near a cell needs
an entry in that cell's column. Where a scene lacks the cell, ``to_blocks`` adds one marked ``_gap``,
and ``own_cells`` takes it out again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from silvagrid.functions.grid import floor_div

BLOCK = 256
BLOCK_KEY = ["scene_id", "_br", "_bc"]


def to_blocks(cells: DataFrame, halo: int, block: int = BLOCK, gaps: bool = True) -> DataFrame:
    """Add ``_br, _bc`` and partition by block; border cells are copied. With a halo, and unless ``gaps`` is false,
    also add ``_gap`` and a NULL row for each absent cell within ``halo`` columns of one in its row."""
    if not 0 <= halo < block:
        raise ValueError("halo must be smaller than the block side")

    def ids(axis: str) -> Column:
        x = F.col(axis)
        if halo == 0:
            return floor_div(x, block)
        inner = F.pmod(x, F.lit(block)).between(halo, block - 1 - halo)
        reach = F.sequence(floor_div(x - halo, block), floor_div(x + halo, block))
        return F.explode(F.when(inner, F.array(floor_div(x, block))).otherwise(reach))

    blocks = cells.withColumn("_br", ids("r")).withColumn("_bc", ids("c")).repartition(*BLOCK_KEY)
    return _with_gaps(blocks, halo) if gaps and halo else blocks


def _with_gaps(blocks: DataFrame, reach: int) -> DataFrame:
    """Each gap of a row is filled from its left side, then from its right; a wide one keeps its middle."""
    line = Window.partitionBy(*BLOCK_KEY, "r").orderBy("c")
    c, before, after = F.col("c"), F.lag("c").over(line), F.lead("c").over(line)

    def absent(lo: Column, hi: Column) -> Column:
        places = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda x: F.struct(x.alias("c"), F.lit(True).alias("gap")))

    own = F.array(F.struct(c.alias("c"), F.lit(False).alias("gap")))
    left = absent(F.greatest(c - reach, before + reach + 1), c - 1)
    right = absent(c + 1, F.least(c + reach, after - 1))
    at = blocks.withColumn("c", c.cast("int")).withColumn("_at", F.concat(left, own, right)).withColumn("_at", F.explode("_at"))
    gap = F.col("_at.gap")
    place = {**{x: F.col(x) for x in (*BLOCK_KEY, "r")}, "c": F.col("_at.c")}
    return at.select(*[place.get(x, F.when(~gap, F.col(x))).alias(x) for x in blocks.columns], gap.alias("_gap"))


def own_cells(blocks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Keep each cell in its own block only."""
    if "_gap" in blocks.columns:
        blocks = blocks.filter(~F.col("_gap")).drop("_gap")
    return blocks.filter(
        (F.col("_br") == floor_div(F.col("r"), block)) & (F.col("_bc") == floor_div(F.col("c"), block))
    )


def along_row(lo: int, hi: int) -> WindowSpec:
    return Window.partitionBy(*BLOCK_KEY, "r").orderBy("c").rangeBetween(lo, hi)


def along_col(lo: int, hi: int) -> WindowSpec:
    return Window.partitionBy(*BLOCK_KEY, "c").orderBy("r").rangeBetween(lo, hi)
