"""Column expressions on grid coordinates. All stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL = ["scene_id", "r", "c"]

# Multipliers of the two lanes of the portable cell hash, for row, column, scene and
# the second round, and the prime that both are taken by.
HASH_LANES = [(73856093, 19349663, 83492791, 1103515245), (49979687, 67867967, 32452843, 1664525137)]
HASH_PRIME = 2147483647


def idiv(a: Column | str, b: Column | int) -> Column:
    """Integer division of non-negative integers (bigint result)."""
    a = F.col(a) if isinstance(a, str) else a
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def floor_div(a: Column, b: int) -> Column:
    """Division rounding down, right for negative coordinates too."""
    return F.floor(a / F.lit(b)).cast("int")


def cell_hash(r: Column, c: Column, scene: Column) -> Column:
    """Repeatable 62-bit hash of a cell, in integer arithmetic that any SQL has.

    Each lane multiplies, folds its high bits down and multiplies again, so that equal
    or close values form no lattice over the grid.
    """
    lanes = []
    for kr, kc, ks, again in HASH_LANES:
        x = F.pmod(r.cast("long") * kr + c.cast("long") * kc + scene.cast("long") * ks, F.lit(HASH_PRIME))
        x = F.pmod(x.bitwiseXOR(F.shiftright(x, 15)) * again, F.lit(HASH_PRIME))
        lanes.append(x.bitwiseXOR(F.shiftright(x, 13)))
    return lanes[0] * (1 << 31) + lanes[1]


def run_key(r: Column, c: Column) -> Column:
    """Row-major position as one long: sorts by row, then by column."""
    return F.shiftleft(r.cast("long"), 32) + c.cast("long")


def clamp(x: Column, lo: int, hi: int) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def affine(r: Column, c: Column, a: Column, b: Column, k: Column) -> Column:
    """``a*c + b*r + k``: one output axis of a pixel-to-map transform."""
    return a * c + b * r + k
