"""Pixel and map coordinates: affine transforms, their fit, pyramids, resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import affine, idiv
from silvagrid.plans.joins import attach
from silvagrid.sources.catalogue import scene_grid

COEFFS = ["xc", "xr", "x0", "yc", "yr", "y0"]


def apply_affine(px: DataFrame, coeffs: DataFrame) -> DataFrame:
    """Add map coordinates ``x = xc*c + xr*r + x0``, ``y = yc*c + yr*r + y0``; NULL for
    scenes without coefficients."""
    k = {name: F.col(name) for name in COEFFS}
    return (
        attach(px, coeffs.select("scene_id", *COEFFS), ["scene_id"], "left")
        .withColumn("x", affine(F.col("r"), F.col("c"), k["xc"], k["xr"], k["x0"]))
        .withColumn("y", affine(F.col("r"), F.col("c"), k["yc"], k["yr"], k["y0"]))
        .drop(*COEFFS)
    )


def fit_gcp(gcp: DataFrame) -> DataFrame:
    """Least-squares affine per scene from control points, in closed form.

    Central moments only, which combine map-side; NULL where the points are
    collinear.
    """
    moments = gcp.groupBy("scene_id").agg(
        F.count("*").alias("n"),
        *[F.avg(v).alias(f"m{v}") for v in "rcxy"],
        F.var_pop("c").alias("cc"),
        F.var_pop("r").alias("rr"),
        F.covar_pop("c", "r").alias("cr"),
        *[F.covar_pop(a, b).alias(a + b) for a in "cr" for b in "xy"],
    )
    det = F.nullif(F.col("cc") * F.col("rr") - F.col("cr") * F.col("cr"), F.lit(0.0))

    def axis(v: str) -> list:
        on_c = (F.col("c" + v) * F.col("rr") - F.col("r" + v) * F.col("cr")) / det
        on_r = (F.col("r" + v) * F.col("cc") - F.col("c" + v) * F.col("cr")) / det
        return [
            on_c.alias(v + "c"),
            on_r.alias(v + "r"),
            (F.col("m" + v) - on_c * F.col("mc") - on_r * F.col("mr")).alias(v + "0"),
        ]

    return moments.select("scene_id", "n", *axis("x"), *axis("y"))


def fit_line(gcp: DataFrame, y: str = "x", x: str = "c") -> DataFrame:
    """One-variable least squares per scene."""
    return gcp.groupBy("scene_id").agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def gcp_residuals(gcp: DataFrame, coeffs: DataFrame) -> DataFrame:
    """Root mean square error per scene of the control points under ``coeffs``."""
    k = {name: F.col(name) for name in COEFFS}
    dx = F.col("x") - affine(F.col("r"), F.col("c"), k["xc"], k["xr"], k["x0"])
    dy = F.col("y") - affine(F.col("r"), F.col("c"), k["yc"], k["yr"], k["y0"])
    return (
        attach(gcp, coeffs.select("scene_id", *COEFFS), ["scene_id"])
        .groupBy("scene_id")
        .agg(
            F.count("*").alias("n"),
            F.sqrt(F.avg(dx * dx)).alias("rmse_x"),
            F.sqrt(F.avg(dy * dy)).alias("rmse_y"),
            F.sqrt(F.avg(dx * dx + dy * dy)).alias("rmse"),
            F.max(F.sqrt(dx * dx + dy * dy)).alias("worst"),
        )
    )


def downsample_mean(px: DataFrame, k: int) -> DataFrame:
    """Pyramid level: mean of each ``k x k`` block, with the count behind it."""
    return px.groupBy("scene_id", *_coarse(k)).agg(
        (F.sum("dn") / F.count("dn")).alias("dn_mean"), F.count("dn").alias("n")
    )


def downsample_mode(classes: DataFrame, k: int, value: str = "cls") -> DataFrame:
    """Pyramid level of a class map: most frequent class, lowest on ties."""
    counts = (
        classes.filter(F.col(value).isNotNull())
        .groupBy("scene_id", *_coarse(k), value)
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy("scene_id", "r", "c").agg(
        F.max_by(value, F.struct(F.col("n"), -F.col(value))).alias(value)
    )


def _coarse(k: int) -> list:
    return [idiv(axis, k).cast("int").alias(axis) for axis in ("r", "c")]


def resample_nearest(px: DataFrame, coeffs: DataFrame, step: float) -> DataFrame:
    """Target grid of pitch ``step`` over each scene's map box, filled with the
    nearest source pixel: output ``scene_id, i, j, dn``.

    The grid is generated row by row across tasks; target cells whose nearest
    source cell lies outside the scene are left out.
    """
    box = px.groupBy("scene_id").agg(
        F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")
    )
    k = {name: F.col(name) for name in COEFFS}

    def corner_range(a, b, o):
        corners = [affine(F.col(r), F.col(c), a, b, o) for r in ("r0", "r1") for c in ("c0", "c1")]
        return F.least(*corners), F.greatest(*corners)

    spans = box.join(coeffs.select("scene_id", *COEFFS), "scene_id")
    (x_lo, x_hi), (y_lo, y_hi) = corner_range(k["xc"], k["xr"], k["x0"]), corner_range(k["yc"], k["yr"], k["y0"])
    spans = spans.select("scene_id", *COEFFS, x_lo.alias("xlo"), x_hi.alias("xhi"), y_lo.alias("ylo"), y_hi.alias("yhi"))
    extent = spans.select(
        "scene_id",
        F.lit(0).alias("r0"),
        F.floor((F.col("yhi") - F.col("ylo")) / step).cast("int").alias("r1"),
        F.lit(0).alias("c0"),
        F.floor((F.col("xhi") - F.col("xlo")) / step).cast("int").alias("c1"),
    )
    target = scene_grid(extent).select("scene_id", F.col("r").alias("i"), F.col("c").alias("j"))
    at = attach(target, spans.drop("xhi", "yhi"), ["scene_id"])
    dx = F.col("xlo") + F.col("j") * step - k["x0"]
    dy = F.col("ylo") + F.col("i") * step - k["y0"]
    # a singular transform has no source cells
    det = F.nullif(k["xc"] * k["yr"] - k["xr"] * k["yc"], F.lit(0.0))
    source_c = (dx * k["yr"] - dy * k["xr"]) / det
    source_r = (dy * k["xc"] - dx * k["yc"]) / det
    at = at.select(
        "scene_id",
        "i",
        "j",
        F.floor(source_r + 0.5).cast("int").alias("r"),
        F.floor(source_c + 0.5).cast("int").alias("c"),
    )
    return at.join(px.select("scene_id", "r", "c", "dn"), ["scene_id", "r", "c"]).select("scene_id", "i", "j", "dn")
