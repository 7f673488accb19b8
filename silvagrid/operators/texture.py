"""Gradient, local binary patterns and grey-level co-occurrence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators.radiometry import quantize
from silvagrid.plans.blocks import BLOCK, along_col, along_row, own_cells, to_blocks


def _neighbours(px: DataFrame, block: int) -> DataFrame:
    """The eight neighbours as columns ``nw n ne w e sw s se``, NULL where missing."""
    blocks = to_blocks(px.select(*CELL, "dn"), 1, block)
    rows = blocks.select(
        "*", F.max("dn").over(along_row(-1, -1)).alias("w"), F.max("dn").over(along_row(1, 1)).alias("e")
    )

    def fetch(column: str, step: int) -> Column:
        return F.max(column).over(along_col(step, step))

    cells = rows.select(
        "*",
        *[fetch(x, -1).alias(y) for x, y in (("w", "nw"), ("dn", "n"), ("e", "ne"))],
        *[fetch(x, 1).alias(y) for x, y in (("w", "sw"), ("dn", "s"), ("e", "se"))],
    )
    return own_cells(cells, block)


def sobel(px: DataFrame, block: int = BLOCK) -> DataFrame:
    """Gradient ``gx, gy`` and squared magnitude; NULL where a neighbour is missing."""
    x = F.col
    gx = (x("ne") + 2 * x("e") + x("se")) - (x("nw") + 2 * x("w") + x("sw"))
    gy = (x("sw") + 2 * x("s") + x("se")) - (x("nw") + 2 * x("n") + x("ne"))
    return (
        _neighbours(px, block)
        .select(*CELL, gx.alias("gx"), gy.alias("gy"))
        .withColumn("g2", x("gx") * x("gx") + x("gy") * x("gy"))
    )


def lbp(px: DataFrame, block: int = BLOCK) -> DataFrame:
    """Code 0..255: one bit per neighbour at least as bright as the centre.

    Bits run clockwise from the upper left; a missing neighbour sets no bit.
    """
    ring = ["nw", "n", "ne", "e", "se", "s", "sw", "w"]
    bits = [F.coalesce((F.col(x) >= F.col("dn")).cast("int"), F.lit(0)) * (1 << i) for i, x in enumerate(ring)]
    code = F.when(F.col("dn").isNotNull(), sum(bits[1:], bits[0]))
    return _neighbours(px, block).select(*CELL, code.alias("lbp"))


def cooccurrence(px: DataFrame, levels: int = 8, by: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Counts of quantised level pairs (cell, right neighbour) per group."""
    right = Window.partitionBy("scene_id", "r").orderBy("c").rangeBetween(1, 1)
    pairs = quantize(px, levels).select(*by, F.col("q").alias("a"), F.max("q").over(right).alias("b"))
    return pairs.filter("a is not null and b is not null").groupBy(*by, "a", "b").agg(F.count("*").alias("n"))


def glcm_features(px: DataFrame, levels: int = 8, by: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Contrast, energy, homogeneity and entropy of the co-occurrence matrix."""
    n, total = F.col("n"), F.sum("n")
    d2 = (F.col("a") - F.col("b")) * (F.col("a") - F.col("b"))
    nd = n.cast("double")
    return cooccurrence(px, levels, by).groupBy(*by).agg(
        total.alias("n_pairs"),
        F.round(F.sum(n * d2) / total, 6).alias("contrast"),
        F.round(F.sum(nd * nd) / (total.cast("double") * total), 6).alias("energy"),
        F.round(F.sum(n / (1 + d2)) / total, 6).alias("homogeneity"),
        F.round(F.log(total) - F.sum(n * F.log(n)) / total, 6).alias("entropy"),
    )
