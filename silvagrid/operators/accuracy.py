"""Reference samples and agreement of a class map with the truth.

All scores come from the confusion matrix or a class histogram, so pixels are
read once and reduced map-side. Tables carry ``cls`` (mapped) and ``truth``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL, cell_hash, idiv
from silvagrid.plans.joins import top_n


def stratified_sample(px: DataFrame, n: int, by: str = "truth", keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``n`` cells per class (all if fewer), the same ones on every run,
    with the columns named in ``keep``."""
    hashed = px.select(*CELL, by, *keep, cell_hash(F.col("r"), F.col("c"), F.col("scene_id")).alias("h"))
    # the top bits of an even hash: a step holds about a 65,000th of a class
    return top_n(hashed, [by], [F.col("h"), *map(F.col, CELL)], n, F.shiftright("h", 46), rank="place")


def block_split(px: DataFrame, side: int = 16, percent: int = 30) -> DataFrame:
    """Add ``part`` ('test' or 'train'): whole spatial blocks go to one side."""
    h = cell_hash(idiv("r", side), idiv("c", side), F.col("scene_id"))
    return px.withColumn("part", F.when(h % 100 < percent, "test").otherwise("train"))


def confusion_matrix(classes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    pairs = classes.filter("cls is not null and truth is not null")
    return pairs.groupBy(*by, "cls", "truth").agg(F.count("*").alias("n"))


def _cell(cls: int, truth: int) -> Column:
    return F.sum(F.when((F.col("cls") == cls) & (F.col("truth") == truth), F.col("n")).otherwise(0))


def accuracy_scores(classes: DataFrame, by: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Overall, producer's and user's accuracy, F1 and intersection over union of forest."""
    counts = confusion_matrix(classes, by).groupBy(*by).agg(
        _cell(1, 1).alias("tp"), _cell(1, 0).alias("fp"), _cell(0, 1).alias("fn"), _cell(0, 0).alias("tn")
    )
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("overall"),
        F.try_divide(tp, tp + fn).alias("producers"),
        F.try_divide(tp, tp + fp).alias("users"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(tp, tp + fp + fn).alias("iou"),
    )


def kappa(classes: DataFrame, by: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Cohen's kappa from the matrix and its marginals."""
    counts = confusion_matrix(classes, by).groupBy(*by).agg(
        F.sum("n").cast("double").alias("tot"),
        F.sum(F.when(F.col("cls") == F.col("truth"), F.col("n")).otherwise(0)).alias("hit"),
        F.collect_list(F.struct("cls", "truth", F.col("n").cast("double").alias("n"))).alias("m"),
    )

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    # row and column sums of a class multiplied: all pairs of entries of the small matrix that share it
    meeting = F.transform("m", lambda a: total(F.transform("m", lambda b: F.when(a["cls"] == b["truth"], a["n"] * b["n"]).otherwise(0.0))))
    po = F.col("hit") / F.col("tot")
    pe = total(meeting) / (F.col("tot") * F.col("tot"))
    return counts.select(
        *by, po.alias("observed"), pe.alias("expected"), F.round(F.try_divide(po - pe, 1 - pe), 6).alias("kappa")
    )


def area_adjusted(sample: DataFrame, mapped: DataFrame) -> DataFrame:
    """Error-adjusted area of the truth classes 0 and 1 with standard errors.

    ``sample`` holds classified cells with truth, ``mapped`` the whole class map;
    strata are the mapped classes, weighted by their share of the map. With a mapped class without
    a sample nothing can be said of the whole: area and error are NULL. With one of a single cell
    the error is NULL, unless the class is a single cell too.
    """
    strata = mapped.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n_map"))
    rows = confusion_matrix(sample).groupBy("cls").agg(
        F.sum("n").alias("n_row"), F.sum(F.when(F.col("truth") == 1, F.col("n")).otherwise(0)).alias("n1")
    )
    share = F.col("n1") / F.col("n_row")
    n_map = F.col("n_map").cast("double")
    # the variance of a share and of its complement are the same
    spread = F.try_divide(n_map * n_map * share * (1 - share), F.col("n_row") - 1)
    spread = F.when(F.col("n_map") == F.col("n_row"), F.coalesce(spread, F.lit(0.0))).otherwise(spread)

    def whole(x: Column) -> Column:
        return F.when(F.count(x) == F.count("*"), F.sum(x))

    sums = strata.join(rows, "cls", "left").agg(
        F.sum("n_map").alias("n_all"),
        whole(n_map * share).alias("a1"),
        whole(n_map * (1 - share)).alias("a0"),
        whole(spread).alias("var"),
    )
    per_class = F.array(*[F.struct(F.lit(k).alias("truth"), F.col(f"a{k}").alias("area")) for k in (0, 1)])
    return sums.select("n_all", "var", F.explode(per_class).alias("k")).select(
        "k.truth",
        F.round(F.col("k.area") / F.col("n_all"), 6).alias("area_share"),
        F.round(F.col("k.area"), 3).alias("area_px"),
        F.round(F.sqrt("var") / F.col("n_all"), 6).alias("std_error"),
    )


def threshold_sweep(px: DataFrame, by: str = "scene_id") -> DataFrame:
    """Scores of 'forest at or below t' for every grey level t present, from
    cumulative counts on the class histogram."""
    levels = (
        px.filter("dn is not null and truth is not null")
        .groupBy(by, "dn")
        .agg(F.sum("truth").alias("f"), F.count("*").alias("n"))
    )
    up, whole = Window.partitionBy(by).orderBy("dn"), Window.partitionBy(by)
    cum = levels.select(
        by,
        F.col("dn").alias("t"),
        F.sum("f").over(up).alias("tp"),
        F.sum(F.col("n") - F.col("f")).over(up).alias("fp"),
        F.sum("f").over(whole).alias("pos"),
        F.sum("n").over(whole).alias("tot"),
    )
    tn = F.col("tot") - F.col("pos") - F.col("fp")
    return cum.select(
        by,
        "t",
        "tp",
        "fp",
        ((F.col("tp") + tn) / F.col("tot")).alias("overall"),
        F.try_divide(F.col("tp"), F.col("pos") + F.col("fp")).alias("iou"),
    )
