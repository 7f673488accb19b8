"""Distinct counts and percentiles of tiles as stored sketches, merged upwards without reading pixels again.

A tile keeps a HyperLogLog sketch of its grey levels and a KLL sketch of their distribution, each of bounded size.
Sketches of tiles add up to those of larger tiles and of scenes with the error of a single one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import floor_div

#: Sizes of the sketches: 2 ** 12 registers, standard error 1.6 %; and k = 200, rank error below 2 %.
HLL_BITS, KLL_K = 12, 200
TILE = ["scene_id", "tile_r", "tile_c"]


def tile_sketches(px: DataFrame, side: int, value: str = "dn") -> DataFrame:
    """``scene_id, tile_r, tile_c, n_px, levels, spread`` per square tile of ``side`` cells.

    ``n_px`` counts valid cells exactly, ``levels`` and ``spread`` are binary sketches of them. NULL is left out; a tile of NULL
    alone has empty sketches. Partial sketches are merged before the shuffle.
    """
    at = [floor_div(F.col(x), side).alias(f"tile_{x}") for x in ("r", "c")]
    level = F.col(value).cast("long")
    return px.select("scene_id", *at, level.alias("_v")).groupBy(*TILE).agg(
        F.count("_v").alias("n_px"),
        F.hll_sketch_agg("_v", HLL_BITS).alias("levels"),
        F.kll_sketch_agg_bigint("_v", KLL_K).alias("spread"),
    )


def _merged(sketches: DataFrame, *keys) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("n_px").alias("n_px"), F.hll_union_agg("levels").alias("levels"), F.kll_merge_agg_bigint("spread").alias("spread")
    )


def merge_tiles(sketches: DataFrame, factor: int) -> DataFrame:
    """Sketches of tiles ``factor`` times as wide; same columns."""
    if factor < 1:
        raise ValueError("factor must be at least 1")
    return _merged(sketches, "scene_id", *[floor_div(F.col(x), factor).alias(x) for x in TILE[1:]])


def merge_scenes(sketches: DataFrame) -> DataFrame:
    """One sketch pair per scene: ``scene_id, n_px, levels, spread``."""
    return _merged(sketches, "scene_id")


def sketch_values(sketches: DataFrame, shares: Sequence[float] = (0.02, 0.5, 0.98)) -> DataFrame:
    """The sketches' answers in their place: ``n_levels``, and ``q0, q1, ...``, the levels at ``shares``; NULL without valid cells."""
    kept = [c for c in sketches.columns if c not in ("levels", "spread")]
    filled = F.when(F.col("n_px") > 0, F.col("spread"))
    return sketches.select(
        *kept,
        F.hll_sketch_estimate("levels").alias("n_levels"),
        *[F.kll_sketch_get_quantile_bigint(filled, F.lit(float(s))).alias(f"q{i}") for i, s in enumerate(shares)],
    )
