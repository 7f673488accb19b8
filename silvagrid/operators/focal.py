"""Neighbourhood operators on the block layout.

A neighbourhood is the square of side ``2*radius + 1``, cut at the scene edge;
missing and NULL neighbours are left out; scenes may lack cells.
A row window followed by a column window gives each square aggregate, both
served by the one exchange of ``to_blocks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.plans.blocks import BLOCK, along_col, along_row, own_cells, to_blocks

#: How a square aggregate splits into a row step and a column step.
STEPS = {
    "sum": (F.sum, F.sum),
    "n": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


def focal_pass(blocks: DataFrame, radius: int, **aggs: tuple[str, Column]) -> DataFrame:
    """Add ``name = (step, expression)`` columns to a table already in block layout."""
    row, col = along_row(-radius, radius), along_col(-radius, radius)
    kept = blocks.columns
    rows = blocks.select(*kept, *[STEPS[s][0](e).over(row).alias(f"_{n}") for n, (s, e) in aggs.items()])
    return rows.select(*kept, *[STEPS[s][1](f"_{n}").over(col).alias(n) for n, (s, _) in aggs.items()])


def focal(px: DataFrame, radius: int = 1, value: str = "dn", block: int = BLOCK, **steps: str) -> DataFrame:
    """Pixels plus one column per ``name=step`` aggregate of ``value``."""
    blocks = to_blocks(px, radius, block)
    out = focal_pass(blocks, radius, **{name: (step, F.col(value)) for name, step in steps.items()})
    return own_cells(out, block).drop("_br", "_bc")


def focal_sum(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return focal(px, radius, block=block, f_sum="sum", f_n="n").select(*CELL, "f_sum", "f_n")


def focal_mean(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return focal_sum(px, radius, block).select(*CELL, F.try_divide("f_sum", "f_n").alias("f_mean"))


def focal_min(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return focal(px, radius, block=block, f_min="min").select(*CELL, "f_min")


def focal_max(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    return focal(px, radius, block=block, f_max="max").select(*CELL, "f_max")


def focal_std(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Population standard deviation; integer sums, one square root at the end."""
    v = F.col("dn").cast("long")
    sums = focal_pass(to_blocks(px, radius, block), radius, s=("sum", v), q=("sum", v * v), n=("n", v))
    spread = F.col("n") * F.col("q") - F.col("s") * F.col("s")
    std = F.round(F.try_divide(F.sqrt(spread), F.col("n")), 6)
    return own_cells(sums, block).select(*CELL, std.alias("f_std"))


def focal_median(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Lower median. The square's values are gathered as an array of at most
    ``(2*radius + 1)**2`` entries by two list windows; nothing is exploded."""
    row, col = along_row(-radius, radius), along_col(-radius, radius)
    blocks = to_blocks(px.select(*CELL, "dn"), radius, block)
    lists = blocks.withColumn("_row", F.collect_list("dn").over(row)).withColumn(
        "_all", F.array_sort(F.flatten(F.collect_list("_row").over(col)))
    )
    n = F.size("_all")
    median = F.when(n > 0, F.try_element_at("_all", F.call_function("div", n + 1, F.lit(2)).cast("int")))
    return own_cells(lists, block).select(*CELL, median.alias("f_median"))


def focal_majority(classes: DataFrame, radius: int = 1, value: str = "cls", block: int = BLOCK) -> DataFrame:
    """Most frequent of two classes 0 and 1; 0 on ties."""
    sums = focal(classes, radius, value, block, _s="sum", _k="n")
    return sums.select(*CELL, F.when(F.col("_k") > 0, (F.col("_s") * 2 > F.col("_k")).cast("int")).alias("f_cls"))


def convolve(px: DataFrame, kernel: Sequence[Sequence[int]], block: int = BLOCK) -> DataFrame:
    """Any odd square kernel, missing neighbours left out.

    Each kernel row is a weighted sum of values fetched along the image row; the
    weighted rows are then fetched along the column and added. Output
    ``f_conv = sum(kernel[i][j] * dn[r+i-k, c+j-k])``.
    """
    side = len(kernel)
    k = side // 2
    if side % 2 == 0 or any(len(line) != side for line in kernel):
        raise ValueError("the kernel must be square with an odd side")
    blocks = to_blocks(px.select(*CELL, "dn"), k, block)
    at = {j: f"_c{j}" for j in range(side)}
    fetched = blocks.select("*", *[F.max("dn").over(along_row(j - k, j - k)).alias(at[j]) for j in at])
    weighted = fetched.select(*blocks.columns, *[
        sum((F.coalesce(F.col(at[j]), F.lit(0)) * F.lit(line[j]) for j in at), F.lit(0)).alias(f"_r{i}")
        for i, line in enumerate(kernel)
    ])
    total = sum(
        (F.coalesce(F.max(f"_r{i}").over(along_col(i - k, i - k)), F.lit(0)) for i in range(side)), F.lit(0)
    )
    return own_cells(weighted.withColumn("f_conv", total), block).select(*CELL, "f_conv")
