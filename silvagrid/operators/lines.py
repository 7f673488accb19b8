"""Sums over rectangles of any size, from running sums along whole image lines.

The block layout of ``focal`` needs a halo smaller than a block. Here a window group is one image row, then
one image column; every frame begins at the line's start and only grows, so that a pixel costs the same
whatever the radius. Pixels are exchanged once for the rows and once for the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL


def _line(across: str, along: str, upto: int) -> WindowSpec:
    """The cells of a row or column from its start to ``upto`` cells behind the current one."""
    return Window.partitionBy("scene_id", across).orderBy(along).rangeBetween(Window.unboundedPreceding, upto)


def summed_area(px: DataFrame) -> DataFrame:
    """The integral image: ``scene_id, r, c, total, n``, sum and count of all cells up to row ``r`` and column ``c``.

    NULL levels count for nothing; absent cells too, and they have no row of their own, so that the sum at a
    cell is right if the scene is dense (see ``densify``).
    """
    row, col = _line("r", "c", 0), _line("c", "r", 0)
    part = px.select(*CELL, F.coalesce(F.sum("dn").over(row), F.lit(0)).alias("_s"), F.count("dn").over(row).alias("_k"))
    return part.select(*CELL, F.sum("_s").over(col).alias("total"), F.sum("_k").over(col).alias("n"))


def box_mean(px: DataFrame, radius: int) -> DataFrame:
    """``scene_id, r, c, b_sum, b_n, b_mean`` over the square of side ``2 * radius + 1``, cut at the scene's edge.

    As ``focal_mean``, for any radius. NULL levels are left out; a square without a valid cell has mean NULL.
    Scenes are dense.
    """
    if radius < 0:
        raise ValueError("radius must not be negative")

    def box(df: DataFrame, across: str, along: str, *names: str) -> DataFrame:
        ahead, behind = _line(across, along, radius), _line(across, along, -radius - 1)
        return df.select(*CELL, *[(F.sum(x).over(ahead) - F.coalesce(F.sum(x).over(behind), F.lit(0))).alias(x) for x in names])

    cells = px.select(*CELL, F.coalesce(F.col("dn"), F.lit(0)).cast("long").alias("b_sum"), F.col("dn").isNotNull().cast("long").alias("b_n"))
    both = box(box(cells, "r", "c", "b_sum", "b_n"), "c", "r", "b_sum", "b_n")
    return both.withColumn("b_mean", F.try_divide("b_sum", "b_n"))
