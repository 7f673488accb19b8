"""Brightness: masking, stretching, quantising, histograms and their matching.

Everything distribution-based goes through the histogram: one row per scene and
grey level, built with map-side combine, so the windows that follow see a few
hundred rows per scene however many pixels the scene has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL, clamp, idiv
from silvagrid.plans.joins import attach
from silvagrid.plans.staging import stage


def nodata_mask(px: DataFrame, lo: int, hi: int) -> DataFrame:
    """Grey levels outside ``lo..hi`` become NULL."""
    return px.withColumn("dn", F.when(F.col("dn").between(lo, hi), F.col("dn")))


def apply_mask(px: DataFrame, mask: DataFrame) -> DataFrame:
    """Keep the pixels listed in ``mask``."""
    return px.join(mask.select(*CELL), CELL, "left_semi")


def drop_masked(px: DataFrame, mask: DataFrame) -> DataFrame:
    """Remove the pixels listed in ``mask``."""
    return px.join(mask.select(*CELL), CELL, "left_anti")


def linear_stretch(px: DataFrame) -> DataFrame:
    """Min-max to 0..255 per scene; a constant scene becomes 0."""
    stats = px.groupBy("scene_id").agg(F.min("dn").alias("_lo"), F.max("dn").alias("_hi"))
    return _rescale(attach(px, stats, ["scene_id"]))


def percentile_stretch(px: DataFrame, low: int = 2, high: int = 98) -> DataFrame:
    """Clip to two percentiles (given in percent) per scene and rescale to 0..255.

    A percentile is the lowest grey level whose cumulative count reaches the share.
    """
    return _rescale(attach(px, percentiles(px, low, high), ["scene_id"], "left"))


def percentiles(px: DataFrame, low: int = 2, high: int = 98) -> DataFrame:
    """Exact percentiles ``_lo, _hi`` per scene from the histogram."""
    cdf = cumulative(histogram(px))
    reached = [F.col("cum") * 100 >= F.col("tot") * q for q in (low, high)]
    return cdf.groupBy("scene_id").agg(
        F.min(F.when(reached[0], F.col("dn"))).alias("_lo"),
        F.min(F.when(reached[1], F.col("dn"))).alias("_hi"),
    )


def _rescale(px: DataFrame) -> DataFrame:
    span = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1))
    over_lo = F.least(F.greatest(F.col("dn"), F.col("_lo")), F.col("_hi")) - F.col("_lo")
    scaled = F.when(F.col("dn").isNotNull(), idiv(over_lo * 255, span).cast("int"))
    return px.withColumn("dn", scaled).drop("_lo", "_hi")


def zscore(px: DataFrame) -> DataFrame:
    """Add ``z``, the standard score within the scene, to 6 places."""
    stats = px.groupBy("scene_id").agg(F.avg("dn").alias("_m"), F.stddev_pop("dn").alias("_s"))
    z = F.round((F.col("dn") - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0)), 6)
    return attach(px, stats, ["scene_id"]).withColumn("z", z).drop("_m", "_s")


def quantize(px: DataFrame, levels: int) -> DataFrame:
    """Add ``q``: grey level 0..255 reduced to ``levels`` equal steps."""
    return px.withColumn("q", clamp(idiv(F.col("dn") * levels, 256).cast("int"), 0, levels - 1))


def histogram(px: DataFrame, value: str = "dn") -> DataFrame:
    """Count per scene and grey level; NULL is not counted."""
    return (
        px.filter(F.col(value).isNotNull())
        .groupBy("scene_id", F.col(value).alias("dn"))
        .agg(F.count("*").alias("n"))
    )


def cumulative(hist: DataFrame) -> DataFrame:
    """Add cumulative count ``cum`` and total ``tot`` to a histogram."""
    scene = Window.partitionBy("scene_id")
    return hist.withColumn("cum", F.sum("n").over(scene.orderBy("dn"))).withColumn("tot", F.sum("n").over(scene))


def hist_equalize(px: DataFrame) -> DataFrame:
    """Remap by the scene's cumulative histogram to a near-flat 0..255."""
    cdf = cumulative(histogram(px)).withColumn("first", F.min("cum").over(Window.partitionBy("scene_id")))
    share = (F.col("cum") - F.col("first")) / F.greatest(F.col("tot") - F.col("first"), F.lit(1))
    lut = cdf.select("scene_id", "dn", F.round(share * 255).cast("int").alias("_to"))
    return _apply_lut(px, lut)


def hist_match(px: DataFrame, reference: int) -> DataFrame:
    """Give every scene the grey-level distribution of scene ``reference``.

    A level maps to the lowest reference level with at least its cumulative share, found by bisection in the
    sorted array of the reference's levels. A reference without valid pixels is an error.
    """
    cdf = stage(cumulative(histogram(px)).select("scene_id", "dn", (F.col("cum") / F.col("tot")).alias("share")), "cdf")
    own = cdf.filter(F.col("scene_id") == reference)
    if own.isEmpty():
        raise ValueError(f"scene {reference} has no valid pixels")
    steps = own.agg(F.sort_array(F.collect_list(F.struct("dn", "share"))).alias("x"))
    levels, shares = (steps.select(f"x.{k}").scalar() for k in ("dn", "share"))
    at = _below(F.col("_shares"), F.col("share"))
    return _apply_lut(px, cdf.withColumn("_shares", shares).withColumn("_dns", levels).select("scene_id", "dn", F.get("_dns", at).alias("_to")))


def _below(sorted_: Column, x: Column) -> Column:
    """How many entries of a sorted array are below ``x``, by bisection; beyond the end there is NULL."""
    halves = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.get(sorted_, at + half - 1) < x, at + half).otherwise(at))


def _apply_lut(px: DataFrame, lut: DataFrame) -> DataFrame:
    """Replace ``dn`` through a table per scene; NULL and levels not in the table become NULL.

    The table is four nested arrays, one for each byte of the distance to the scene's lowest level, cut
    after their last entry. Its size is that of the levels present, whatever their range, and a
    pixel is looked up by four indices in generated code.
    """
    low = F.min("dn").over(Window.partitionBy("scene_id")).cast("long")
    rows = lut.select("scene_id", low.alias("_low"), (F.col("dn") - low).alias("_off"), F.col("_to").alias("_v"))
    for _ in range(4):
        entries = F.map_from_entries(F.collect_list(F.struct(F.col("_off").bitwiseAND(F.lit(255)).cast("int").alias("k"), "_v")))
        rows = rows.groupBy("scene_id", "_low", F.shiftright("_off", 8).alias("_up")).agg(entries.alias("_m"))
        filled = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("_m"))), lambda k: F.try_element_at("_m", k))
        rows = rows.select("scene_id", "_low", F.col("_up").alias("_off"), filled.alias("_v"))
    off = F.col("dn") - F.col("_low")
    value = F.col("_v")
    for shift in (24, 16, 8, 0):
        value = F.get(value, F.shiftright(off, shift).bitwiseAND(F.lit(255)).cast("int"))
    inside = off.between(0, (1 << 32) - 1)
    return attach(px, rows.drop("_off"), ["scene_id"], "left").withColumn("dn", F.when(inside, value)).drop("_low", "_v")
