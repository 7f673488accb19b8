"""Joins and rankings that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.plans.staging import stage


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a table of one row per key (scene, zone, grey level) onto ``big``.

    ``small`` is staged, so that its size in bytes is known when the join is planned: Spark
    broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``, otherwise both sides are
    exchanged and adaptive execution splits the partitions of a hot key.
    """
    return big.join(stage(small, "attach"), list(on), how)


def join_in_blocks(rows: DataFrame, table: DataFrame, block: Sequence[str], on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table`` (unique on ``on``) by way of the keys present in each block.

    The join that moves ``rows`` is on block and key, so that no key of it holds more than a block,
    however many rows share ``on``. Only one row per block and key meets ``table``.
    """
    keys = list(dict.fromkeys([*block, *on]))
    present = rows.select(*keys).distinct().join(table, list(on))
    return rows.join(present, keys, how)


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, coarse: Column, rank: str = "rn") -> DataFrame:
    """First ``n`` rows per group, with their place in ``rank``.

    ``coarse`` is an integer that never falls along ``order``. Rows are counted per group and
    ``coarse`` first; only those up to the step at which ``n`` is reached are ranked, whatever ``n``.
    """
    along = Window.partitionBy(*group).orderBy("_step").rowsBetween(Window.unboundedPreceding, -1)
    stepped = df.withColumn("_step", coarse)
    counts = stepped.groupBy(*group, "_step").agg(F.count("*").alias("_n"))
    needed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(along), F.lit(0))).filter(F.col("_before") < n)
    last = needed.groupBy(*group).agg(F.max("_step").alias("_last"))
    near = stage(last.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_last"), "steps")
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    kept = stepped.join(near, [*same, F.col("_step") <= F.col("_last")])
    whole = Window.partitionBy(*group).orderBy(*order)
    return kept.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n).select(*df.columns, rank)
