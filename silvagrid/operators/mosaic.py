"""Overlapping acquisitions to one value per cell.

Every composite is a combining aggregate: partial results are merged before the
shuffle, so a cell seen by a third of all observations costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def composite_latest(obs: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Latest observation per cell that is not NULL; NULL only where there is no other."""
    order = F.struct(F.col("dn").isNotNull().alias("valid"), "acq_ts", *ties)
    return obs.groupBy("r", "c").agg(F.max_by("dn", order).alias("dn"))


def composite_median(obs: DataFrame) -> DataFrame:
    """Lower median per cell, from the cell's grey-level counts."""
    cell = Window.partitionBy("r", "c")
    counts = obs.filter(F.col("dn").isNotNull()).groupBy("r", "c", "dn").agg(F.count("*").alias("n"))
    return (
        counts.withColumn("cum", F.sum("n").over(cell.orderBy("dn")))
        .withColumn("tot", F.sum("n").over(cell))
        .filter(F.col("cum") * 2 >= F.col("tot"))
        .groupBy("r", "c")
        .agg(F.min("dn").alias("dn"))
    )


def composite_priority(obs: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Lowest strip number wins, then the latest of that strip; observations that are NULL come last."""
    order = F.struct(F.col("dn").isNotNull().alias("valid"), (-F.col("strip")).alias("p"), "acq_ts", *ties)
    best = F.max_by(F.struct("dn", "strip"), order).alias("b")
    return obs.groupBy("r", "c").agg(best).select("r", "c", "b.dn", "b.strip")


def mosaic_union(*scenes: DataFrame) -> DataFrame:
    """Stack tables with different optional columns, aligned by name."""
    out = scenes[0]
    for more in scenes[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def seam_bias(obs: DataFrame) -> DataFrame:
    """Mean grey-level difference over all observation pairs of two strips on a cell.

    Observations are summed per cell and strip first. With sums ``s`` and counts
    ``n`` the differences over all pairs add up to ``s1*n2 - s2*n1``, so pairs of
    observations are never formed. A cell's strips are gathered (one entry each) and paired in place:
    only sums per pair of strips leave a task.
    """
    part = (
        obs.filter(F.col("dn").isNotNull())
        .groupBy("r", "c", "strip")
        .agg(F.sum("dn").alias("s"), F.count("dn").alias("n"))
    )
    strips = part.groupBy("r", "c").agg(F.sort_array(F.collect_list(F.struct("strip", "s", "n"))).alias("x"))

    def with_later(a, i):
        later = F.slice("x", i + 2, F.size("x"))
        return F.transform(
            later,
            lambda b: F.struct(
                a["strip"].alias("s1"),
                b["strip"].alias("s2"),
                (a["s"] * b["n"] - b["s"] * a["n"]).alias("diff"),
                (a["n"] * b["n"]).alias("weight"),
            ),
        )

    pairs = strips.select(F.explode(F.flatten(F.transform("x", with_later))).alias("p")).select("p.*")
    return pairs.groupBy("s1", "s2").agg(
        F.count("*").alias("n_cells"),
        F.sum("weight").alias("n_pairs"),
        (F.sum("diff") / F.sum("weight")).alias("bias"),
    )
