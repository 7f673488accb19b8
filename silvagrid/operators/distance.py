"""Exact Euclidean distance of every cell to the nearest cell of the other class.

Squared distances split into a column step and a row step. Along a column the nearest cell of a class is a running
value from above and one from below. Along a row, the nearest over all columns is the lower envelope of one
parabola per column. Both steps see whole image lines, which no block cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL

_OUT = "scene_id int, r int, c int, cls int, d2 long"


def _envelope_of():
    """Function for one row, for the workers: squared distances from columns and their heights."""

    def envelope(columns, heights, asked):
        """Lowest ``(x - column)**2 + height`` at each sorted ``asked`` x; in whole numbers, so exact."""
        lower, begins = [], []  # parabolas of the envelope, and the first x at which each is lowest
        for q, f in zip(columns, heights):
            while lower:
                v, g = lower[-1]
                # the first whole x at which the new parabola is below the last: x > (f - g + q*q - v*v) / (2 * (q - v))
                x = (f - g + q * q - v * v) // (2 * (q - v)) + 1
                if x > begins[-1]:
                    break
                lower.pop()
                begins.pop()
            begins.append(x if lower else float("-inf"))
            lower.append((q, f))
        out, k = [], 0
        for x in asked:
            while k + 1 < len(lower) and begins[k + 1] <= x:
                k += 1
            q, f = lower[k]
            out.append((x - q) * (x - q) + f)
        return out

    return envelope


def distance_transform(mask: DataFrame) -> DataFrame:
    """``scene_id, r, c, cls, d2``: squared distance, in cells, to the nearest cell of the scene whose class is another.

    Classes are 0 and 1. A NULL cell is no target and has d2 NULL; so has every cell of a scene of one class.
    Scenes are dense (an absent cell is a NULL row, see ``densify``); they may begin at any row and column.

    Window groups are image columns; rows are read in order of column and need no more memory than one of them.
    """
    cells = mask.select(*CELL, F.col("cls").cast("int").alias("cls"))
    column = Window.partitionBy("scene_id", "c")
    down, up = (column.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in ("r", F.desc("r")))

    def near(k: int) -> Column:
        at = F.when(F.col("cls") == k, F.col("r"))
        before, after = F.last(at, ignorenulls=True).over(down), F.last(at, ignorenulls=True).over(up)
        return F.least(F.col("r") - before, after - F.col("r")).cast("long").alias(f"g{k}")

    heights = cells.select(*CELL, "cls", near(0), near(1))
    rows = heights.repartition("scene_id", "r").sortWithinPartitions("scene_id", "r", "c")
    envelope = _envelope_of()

    def over(batches):
        import pyarrow as pa

        def measure(at, c, cls, *near_):
            d2 = [None] * len(c)
            for k in (0, 1):
                known = [(x, g * g) for x, g in zip(c, near_[k]) if g is not None]
                asked = [i for i, v in enumerate(cls) if v == 1 - k]
                if known and asked:
                    for i, v in zip(asked, envelope(*zip(*known), [c[i] for i in asked])):
                        d2[i] = v
            n = len(c)
            kinds = [pa.int32()] * 4 + [pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(([at[0]] * n, [at[1]] * n, c, cls, d2), kinds)], ["scene_id", "r", "c", "cls", "d2"])

        current, held = None, [[] for _ in range(4)]
        for batch in batches:
            scene, r, *columns = (batch.column(x).to_pylist() for x in ("scene_id", "r", "c", "cls", "g0", "g1"))
            start = 0
            for i, at in enumerate(zip(scene, r)):
                if at != current:
                    for keep, x in zip(held, columns):
                        keep += x[start:i]
                    if held[0]:
                        yield measure(current, *held)
                    current, held, start = at, [[] for _ in range(4)], i
            for keep, x in zip(held, columns):
                keep += x[start:]
        if held[0]:
            yield measure(current, *held)

    return rows.mapInArrow(over, _OUT)
