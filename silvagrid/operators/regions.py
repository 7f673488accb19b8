"""Runs, connected regions and what follows from them.

Work is done on runs (stretches of equal class along an image row), cut at block
borders. Regions are labelled inside each block first, one small array problem
per block; then squares of blocks are joined along their borders, squares of
squares, and so on, until one square holds the scene: ``block_union``.

A region is named by the row-major position of its first pixel
(``row * 2**32 + column``), which does not depend on the blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL, floor_div, run_key
from silvagrid.plans.blocks import BLOCK, BLOCK_KEY, to_blocks
from silvagrid.plans.joins import attach, join_in_blocks, top_n
from silvagrid.plans.staging import stage

def mask_runs(mask: DataFrame) -> DataFrame:
    """Maximal horizontal runs of forest: ``scene_id, run_id, r, c0, c1``.

    A window group is one image row, bounded by the scene width.
    """
    row = Window.partitionBy("scene_id", "r").orderBy("c")
    return (
        mask.filter(F.col("cls") == 1)
        .select(*CELL, (F.col("c") - F.row_number().over(row)).alias("_g"))
        .groupBy("scene_id", "r", "_g")
        .agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
        .select("scene_id", run_key(F.col("r"), F.col("c0")).alias("run_id"), "r", "c0", "c1")
    )


def block_runs(blocks: DataFrame, **carry: Column) -> DataFrame:
    """Runs of equal class inside each block, for all classes including NULL.

    ``blocks`` is in block layout without halo. ``carry`` are aggregates over the
    run's pixels, e.g. a sum of grey levels, so later steps need no pixel join.
    No exchange: window and grouping both keep the block key.
    """
    row = Window.partitionBy(*BLOCK_KEY, "r").orderBy("c")
    before = F.lag(F.struct("c", "cls")).over(row)
    joined = (before["c"] == F.col("c") - 1) & before["cls"].eqNullSafe(F.col("cls"))
    starts = blocks.withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1))
    return (
        starts.withColumn("_run", F.sum("_new").over(row))
        .groupBy(*BLOCK_KEY, "r", "_run")
        .agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.first("cls").alias("cls"), *[
            e.alias(n) for n, e in carry.items()
        ])
        .drop("_run")
    )


def _lowest_of() -> Callable:
    """Function from pairs of numbers below ``n`` to the lowest number each is connected with; for the workers."""

    def lowest(n, a, b):
        import numpy as np

        first = np.arange(n)
        while True:
            least = np.minimum(first[a], first[b])
            step = first.copy()
            np.minimum.at(step, first[a], least)
            np.minimum.at(step, first[b], least)
            step = step[step]
            if (step == first).all():
                return first
            first = step

    return lowest


def _block_labeller(connectivity: int) -> Callable:
    """Function that labels the runs of one block; self-contained for the workers."""
    lowest = _lowest_of()

    def label(runs):
        import numpy as np

        runs = runs.sort_values(["r", "c0"], ignore_index=True)
        r, c0, c1 = (runs[x].to_numpy() for x in ("r", "c0", "c1"))
        r, shift = r - r.min(), c0.min()
        image = np.full((r.max() + 2, c1.max() - shift + 3), -1, dtype=np.int64)
        lengths = c1 - c0 + 1
        cols = np.repeat(c0 - shift + 1 - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        image[np.repeat(r, lengths), cols] = np.repeat(np.arange(len(runs)), lengths)
        here = image[:-1, 1:-1]
        # runs cut at tile borders also touch along the row
        near = (image[:-1, 2:], image[1:, 1:-1], image[1:, :-2], image[1:, 2:])
        pairs = [
            np.stack([here[hit], other[hit]])
            for other in near[: 2 if connectivity == 4 else 4]
            for hit in [(here >= 0) & (other >= 0) & (here != other)]
        ]
        a, b = np.concatenate(pairs, axis=1)
        position = (runs["r"].to_numpy().astype(np.int64) << 32) + c0
        return runs.assign(node=position[lowest(len(runs), a, b)])

    return label


#: Blocks on a side of the first squares, and squares on a side of each larger one: so that a
#: task of 256-cell blocks gets at most 262,144 border cells at the first two levels.
FIRST_FAN, FAN = 16, 4


def _square_labeller(connectivity: int, side: int, origin: tuple[int, int]) -> Callable:
    """Function that joins the regions of one square of side ``side`` along the borders of what it is made of."""
    lowest = _lowest_of()
    ahead = [(0, 1), (1, 0)] if connectivity == 4 else [(0, 1), (1, 0), (1, 1), (1, -1)]

    def union(cells):
        import numpy as np
        import pyarrow as pa

        scene, r, c, node = (cells.column(x).to_numpy() for x in ("scene_id", "r", "c", "node"))
        r, c = r.astype(np.int64), c.astype(np.int64)
        place = (r << 32) + c
        order = np.argsort(place)
        place, node, r, c = place[order], node[order], r[order], c[order]
        names, at = np.unique(node, return_inverse=True)
        a, b = [], []
        for i, j in ahead:
            asked = place + (i << 32) + j
            k = np.minimum(np.searchsorted(place, asked), len(place) - 1)
            met = (place[k] == asked) & (at[k] != at)
            a.append(at[met])
            b.append(at[k[met]])
        first = lowest(len(names), np.concatenate(a), np.concatenate(b))
        moved = np.flatnonzero(first != np.arange(len(names)))
        outer = np.isin((r - origin[0]) % side, (0, side - 1)) | np.isin((c - origin[1]) % side, (0, side - 1))
        # regions that moved, then border cells of the square with their region
        none = np.zeros(len(moved), np.int32)
        return pa.table({
            "scene_id": pa.array(np.full(len(moved) + outer.sum(), scene[0], np.int32)),
            "moved": pa.array(np.repeat([True, False], [len(moved), outer.sum()])),
            "r": pa.array(np.concatenate([none, r[outer]]).astype(np.int32)),
            "c": pa.array(np.concatenate([none, c[outer]]).astype(np.int32)),
            "node": pa.array(np.concatenate([names[moved], node[outer]])),
            "label": pa.array(np.concatenate([names[first[moved]], names[first[at[outer]]]])),
        })

    return union


_UNITED = "scene_id int, moved boolean, r int, c int, node long, label long"


def _border_cells(runs: DataFrame, block: int) -> DataFrame:
    """Cells on the border of a block (about ``4 / block`` of all) with the region that their block gave them."""
    edge_row = F.pmod("r", F.lit(block)).isin(0, block - 1)
    ends = F.filter(F.array_distinct(F.array("c0", "c1")), lambda x: F.pmod(x, F.lit(block)).isin(0, block - 1))
    at = F.when(edge_row, F.sequence("c0", "c1")).otherwise(ends)
    return runs.select("scene_id", "r", F.explode(at).alias("c"), "node")


def block_union(local: DataFrame, connectivity: int, block: int, first_fan: int = FIRST_FAN, fan: int = FAN) -> DataFrame:
    """``scene_id, node, label`` for every region of a block that is part of a region with an earlier first cell.

    ``local``: runs with the region (``node``) that their block gave them, named by its first cell. Squares of
    ``first_fan`` x ``first_fan`` blocks are united in one task each, from the cells along the blocks' borders; each
    passes up only its own border, for squares ``fan`` times as wide, until one square holds the scene. The number
    of levels grows with the logarithm of the scene's side, not with the shape of its regions. A task gets the
    borders of what its square is made of: at most ``4 * fan ** 2`` times their side.
    """
    span = local.agg(*[f(F.col(x)).alias(f"{x}_{n}") for x in BLOCK_KEY[1:] for n, f in (("lo", F.min), ("hi", F.max))]).first()
    lows = [(span[f"{x}_lo"] or 0) for x in BLOCK_KEY[1:]]
    blocks = max((span[f"{x}_hi"] or 0) - lo + 1 for x, lo in zip(BLOCK_KEY[1:], lows))
    origin = (lows[0] * block, lows[1] * block)
    cells = _border_cells(local, block)
    side, levels = block, []
    while not levels or side < blocks * block:
        side *= fan if levels else first_fan
        square = [floor_div(F.col(x) - start, side).alias(f"_{x}") for x, start in zip(("r", "c"), origin)]
        union = _square_labeller(connectivity, side, origin)
        # the rows of a task are one square; those of the level below come from many
        dealt = cells.select("scene_id", "r", "c", "node", *square).groupBy("scene_id", "_r", "_c")
        united = stage(dealt.applyInArrow(union, _UNITED), "united")
        levels.append(united.where("moved").select("scene_id", "node", "label"))
        cells = united.where("not moved").select("scene_id", "r", "c", F.col("label").alias("node"))

    def through(later: DataFrame, earlier: DataFrame) -> DataFrame:
        onward = later.select("scene_id", F.col("node").alias("label"), F.col("label").alias("_far"))
        far = earlier.join(onward, ["scene_id", "label"], "left")
        return far.select("scene_id", "node", F.coalesce("_far", "label").alias("label")).unionByName(later)

    return reduce(through, reversed(levels))


def label_runs(runs: DataFrame, connectivity: int = 8, block: int = BLOCK) -> DataFrame:
    """Add ``region_id`` to block runs (all rows given are labelled).

    ``runs`` must be partitioned by block, as ``block_runs`` leaves them.
    """
    if connectivity not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema) + ", node long"
    local = stage(runs.groupBy(*BLOCK_KEY).applyInPandas(_block_labeller(connectivity), schema), "runs")
    labels = block_union(local, connectivity, block)
    return (
        local.join(labels, ["scene_id", "node"], "left")
        .withColumn("region_id", F.coalesce("label", "node"))
        .drop("node", "label")
    )


def runs_of(cells: DataFrame, block: int = BLOCK, **carry: Column) -> DataFrame:
    """Block runs of a class map given as pixels."""
    return block_runs(to_blocks(cells, 0, block), **carry)


def to_pixels(runs: DataFrame, *columns: str) -> DataFrame:
    """Back from runs to one row per cell."""
    return runs.select("scene_id", "r", F.explode(F.sequence("c0", "c1")).alias("c"), *columns)


def connected_components(mask: DataFrame, connectivity: int = 8, block: int = BLOCK) -> DataFrame:
    """Forest pixels with their region: ``scene_id, r, c, region_id``."""
    runs = runs_of(mask.filter("cls = 1").select(*CELL, "cls"), block)
    return to_pixels(label_runs(runs, connectivity, block), "region_id")


def _length() -> Column:
    return (F.col("c1") - F.col("c0") + 1).cast("long")


def region_areas(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("scene_id", "region_id").agg(F.sum(_length()).alias("n_px"))


def region_stats(px: DataFrame, connectivity: int = 8, block: int = BLOCK) -> DataFrame:
    """Area, box, mean grey level and share of the box filled, per forest region.

    ``px`` carries ``dn`` and ``cls``; grey-level sums travel with the runs.
    """
    runs = runs_of(px.filter("cls = 1"), block, dn_sum=F.sum("dn"), dn_n=F.count("dn"))
    stats = (
        label_runs(runs, connectivity, block)
        .groupBy("scene_id", "region_id")
        .agg(
            F.sum(_length()).alias("n_px"),
            F.min("r").alias("r0"),
            F.max("r").alias("r1"),
            F.min("c0").alias("c0"),
            F.max("c1").alias("c1"),
            F.try_divide(F.sum("dn_sum"), F.sum("dn_n")).alias("dn_mean"),
        )
    )
    box = (F.col("r1") - F.col("r0") + 1).cast("long") * (F.col("c1") - F.col("c0") + 1)
    return stats.withColumn("fill", F.col("n_px") / box)


def sieve_runs(runs: DataFrame, min_px: int, connectivity: int, block: int) -> DataFrame:
    """Set ``cls`` to 0 on forest runs of regions below ``min_px``; other runs pass."""
    runs = stage(runs, "runs")
    labelled = stage(label_runs(_by_block(runs.filter("cls = 1")), connectivity, block), "labels")
    small = region_areas(labelled).filter(F.col("n_px") < min_px)
    drop = small.select("scene_id", "region_id", F.lit(0).alias("_drop"))
    kept = join_in_blocks(labelled, drop, BLOCK_KEY, ["scene_id", "region_id"], "left").withColumn("cls", F.coalesce("_drop", "cls"))
    rest = runs.filter("cls is null or cls <> 1")
    return kept.select("scene_id", "r", "c0", "c1", "cls").unionByName(rest.select("scene_id", "r", "c0", "c1", "cls"))


def _by_block(runs: DataFrame) -> DataFrame:
    return runs.repartition(*BLOCK_KEY)


def sieve(mask: DataFrame, min_px: int, connectivity: int = 8, block: int = BLOCK) -> DataFrame:
    """Drop forest regions of fewer than ``min_px`` pixels from the class map."""
    runs = runs_of(mask.select(*CELL, "cls"), block)
    return to_pixels(sieve_runs(runs, min_px, connectivity, block), "cls")


def fill_holes(mask: DataFrame, connectivity: int = 4, block: int = BLOCK) -> DataFrame:
    """Background regions that touch neither the scene's edge nor nodata become forest.

    Background and nodata are labelled together; what holds a NULL cell or reaches the edge is open.
    """
    runs = stage(runs_of(mask.select(*CELL, "cls"), block), "runs")
    edge = runs.groupBy("scene_id").agg(
        F.min("r").alias("_r0"), F.max("r").alias("_r1"), F.min("c0").alias("_c0"), F.max("c1").alias("_c1")
    )
    labelled = stage(label_runs(_by_block(runs.filter("cls is null or cls = 0")), connectivity, block), "labels")
    on_edge = (
        F.col("cls").isNull()
        | (F.col("r") == F.col("_r0"))
        | (F.col("r") == F.col("_r1"))
        | (F.col("c0") == F.col("_c0"))
        | (F.col("c1") == F.col("_c1"))
    )
    holes = (
        attach(labelled, edge, ["scene_id"])
        .groupBy("scene_id", "region_id")
        .agg(F.max(on_edge).alias("open"))
        .filter(~F.col("open"))
        .select("scene_id", "region_id", F.lit(1).alias("_fill"))
    )
    filled = join_in_blocks(labelled, holes, BLOCK_KEY, ["scene_id", "region_id"], "left").withColumn("cls", F.coalesce("_fill", "cls"))
    rest = runs.filter("cls <> 0")
    both = filled.select("scene_id", "r", "c0", "c1", "cls").unionByName(rest.select("scene_id", "r", "c0", "c1", "cls"))
    return to_pixels(both, "cls")


def threshold_hysteresis(
    px: DataFrame, weak: int, strong: int, connectivity: int = 8, block: int = BLOCK
) -> DataFrame:
    """Bright pixels (``dn >= weak``) of regions that hold a pixel with
    ``dn >= strong``, as ``scene_id, r, c``."""
    cells = px.filter(F.col("dn") >= weak).select(*CELL, "dn", F.lit(1).alias("cls"))
    runs = runs_of(cells, block, top=F.max("dn"))
    labelled = stage(label_runs(runs, connectivity, block), "labels")
    seeds = labelled.groupBy("scene_id", "region_id").agg(F.max("top").alias("best")).filter(F.col("best") >= strong)
    return to_pixels(join_in_blocks(labelled, seeds, BLOCK_KEY, ["scene_id", "region_id"]))


def top_regions(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest regions per scene, with their place."""
    order = [F.col("n_px").desc(), F.col("region_id")]
    # number of binary digits, falling with the size
    digits = -F.length(F.bin("n_px"))
    return top_n(stats, ["scene_id"], order, k, digits, rank="place")


def largest_regions(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest regions over all scenes; every task sends at most ``k`` rows."""
    order = [F.col("n_px").desc(), F.col("scene_id"), F.col("region_id")]
    return stats.select("scene_id", "region_id", "n_px").orderBy(*order).limit(k)
