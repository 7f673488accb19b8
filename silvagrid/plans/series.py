"""Running windows over time for groups of which a few may be very large.

Rows are sorted by key and time over all tasks at once, so that a large key, or one moment of it, lies
in several neighbouring partitions. What a key's earlier partitions hold is summarised in one row per
key and partition and carried into the later ones. There is one path for all keys, NULL included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.plans.staging import stage


def running(
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    last: dict[str, Column],
    sums: dict[str, Column],
    inclusive: bool,
) -> DataFrame:
    """Add running columns per ``key`` along ``order``, which is unique within a key.

    ``last``: latest non-NULL value of the expression so far. ``sums``: total of
    the expression so far, 0 before its first value. ``inclusive`` says whether
    the current row counts for ``last``; it always counts for ``sums``.
    """
    columns = rows.columns
    placed = rows.repartitionByRange(*key, *order).withColumn("_part", F.spark_partition_id())
    placed = stage(placed, "placed")
    per_part = placed.groupBy(*key, "_part").agg(
        *[F.max_by(e, F.when(e.isNotNull(), F.struct(*order))).alias(f"_{n}") for n, e in last.items()],
        *[F.sum(e).alias(f"_{n}") for n, e in sums.items()],
    )
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select(
        *[F.col(k).alias(f"_k_{k}") for k in key],
        F.col("_part").alias("_p"),
        *[F.last(f"_{n}", ignorenulls=True).over(before).alias(f"_{n}") for n in last],
        *[F.sum(f"_{n}").over(before).alias(f"_{n}") for n in sums],
    )
    within = Window.partitionBy("_part", *key).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.withColumns(
        {f"_in_{n}": F.last(e, ignorenulls=True).over(upto) for n, e in last.items()}
        | {f"_in_{n}": F.coalesce(F.sum(e).over(so_far), F.lit(0)) for n, e in sums.items()}
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    return inside.join(carry, [*same, F.col("_part") == F.col("_p")]).select(
        *columns,
        *[F.coalesce(f"_in_{n}", f"_{n}").alias(n) for n in last],
        *[(F.col(f"_in_{n}") + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in sums],
    )
