"""Offsets between scenes of one ground, and scenes moved onto one another.

Comparing scenes cell by cell needs them aligned. Each tile of one scene is correlated with the other scene
around it, at all shifts at once by Fourier transforms; the tiles then vote, so that clouds, nodata and tiles
without texture do not decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.operators.extend import TILE_COLUMNS, halo_pieces, unpack_tiles
from silvagrid.plans.joins import attach

PAIR = ["scene_a", "scene_b"]
_SHIFTS = "scene_a int, scene_b int, tile_r int, tile_c int, dr int, dc int, score double, n long"


def _correlator(reach: int):
    """Function that finds the best shift of one tile; self-contained for the workers."""

    def summed(layers):
        """Number, sum and sum of squares of the levels of each cell over its layers, NaN where nodata; or None."""
        import numpy as np

        has = [~np.isnan(x) for x in layers]
        total = sum(x.sum() for x in has)
        if not total:
            return None
        # a whole number off every level changes no correlation, but keeps the products small and exact
        off = np.round(sum(x[k].sum() for x, k in zip(layers, has)) / total)
        levels = [np.where(k, x - off, 0.0) for x, k in zip(layers, has)]
        return sum(k.astype(float) for k in has), sum(levels), sum(x * x for x in levels)

    def best(a, b):
        """``a`` layers (h, w) and ``b`` layers (h + 2 reach, w + 2 reach), NaN where nodata: (dr, dc, score, n) or None."""
        import numpy as np

        shape = b[0].shape
        a, b = summed(a), summed(b)
        if a is None or b is None:
            return None
        cells = a[0].sum()
        ones, level, square = (np.conj(np.fft.rfft2(x, shape)) for x in a)
        ones_b, level_b, square_b = (np.fft.rfft2(x, shape) for x in b)

        def sums(x, y):
            return np.rint(np.fft.irfft2(x * y, shape)[: 2 * reach + 1, : 2 * reach + 1])

        n, sa, sb = sums(ones, ones_b), sums(level, ones_b), sums(ones, level_b)
        saa, sbb, sab = sums(square, ones_b), sums(ones, square_b), sums(level, level_b)
        spread = (n * saa - sa * sa) * (n * sbb - sb * sb)
        enough = (2 * n >= cells) & (spread > 0)
        if not enough.any():
            return None
        score = np.where(enough, (n * sab - sa * sb) / np.sqrt(np.where(spread > 0, spread, 1)), -2)
        dr, dc = np.nonzero(score == score.max())
        far = abs(dr - reach) + abs(dc - reach)
        k = np.lexsort((dc, dr, far))[0]
        return int(dr[k]) - reach, int(dc[k]) - reach, float(score.max()), int(n[dr[k], dc[k]])

    return best


def tile_shifts(tiles: DataFrame, pairs: DataFrame, reach: int, size: int) -> DataFrame:
    """Best shift of each tile of ``scene_a`` against ``scene_b``: ``scene_a, scene_b, tile_r, tile_c, dr, dc, score, n``.

    Cell ``(r, c)`` of the tile lies at ``(r + dr, c + dc)`` of the other scene; all shifts up to ``reach`` are
    tried. The score is the correlation coefficient over the ``n`` cells valid in both, at least half of the
    tile's valid cells; of equal scores the smallest shift is taken. Tiles without such a shift, because they
    are nodata or of one level, have no row. Levels are whole numbers. Only the last tile row and column of a
    scene may be smaller than ``size``. A scene seen twice has several rows per tile, its layers: every cell of ``scene_a``
    is compared with every cell of ``scene_b`` that lies there, and the counts are of such pairs.

    A tile and the nine pieces of the other scene around it meet by one exchange and one sort.
    """
    if not 0 < reach <= size:
        raise ValueError("reach must be at most the tile side")
    tiles = tiles.select(*TILE_COLUMNS)
    key = [*PAIR, "tile_r", "tile_c"]
    pairs = pairs.select(*PAIR).where("scene_a is not null and scene_b is not null").distinct()
    row = [*key, "side", "h", "w", "dn"]
    ours = attach(tiles.withColumnRenamed("scene_id", "scene_a"), pairs, ["scene_a"]).withColumn("side", F.lit(9)).select(*row)
    theirs = halo_pieces(_full(tiles, size), reach).withColumnRenamed("scene_id", "scene_b")
    theirs = attach(theirs, pairs, ["scene_b"]).select(*row)
    met = ours.unionByName(theirs).repartition(*key).sortWithinPartitions(*key, "side")
    unpack, correlate = unpack_tiles(), _correlator(reach)

    def over(batches):
        import numpy as np
        import pyarrow as pa

        def judge(at, parts):
            if not parts or parts[-1][0] != 9:  # no tile of ours there
                return None
            mine = [p for p in parts if p[0] == 9]
            h, w = max(p[1] for p in mine), max(p[2] for p in mine)

            def sheet():
                return np.full((h + 2 * reach, w + 2 * reach), np.nan)

            own, around, used = [], [sheet()], {}
            for side, height, width, cells in parts:
                piece = cells.reshape(-1, width)
                if side == 9:
                    own.append(np.full((h, w), np.nan))
                    own[-1][:height, :width] = piece
                    continue
                # ours may be smaller at its scene's edge; what lies beyond it and the border is cut off
                y, x = ((0, reach, reach + size)[k] for k in (side // 3, side % 3))
                piece = piece[: max(0, h + 2 * reach - y), : max(0, w + 2 * reach - x)]
                # a side's next layer goes on the next sheet
                k = used[side] = used.get(side, -1) + 1
                if k == len(around):
                    around.append(sheet())
                around[k][y : y + piece.shape[0], x : x + piece.shape[1]] = piece
            found = correlate(own, around)
            return found and (*at, *found)

        def table(rows):
            kinds = [pa.int32()] * 6 + [pa.float64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], [*key, "dr", "dc", "score", "n"])

        current, parts = None, []
        for batch in batches:
            done = []
            columns = [batch.column(x).to_pylist() for x in (*key, "side", "h", "w")]
            for (*at, side, h, w), cells in zip(zip(*columns), unpack(batch.column("dn"))):
                if at != current:
                    done.append(judge(current, parts))
                    current, parts = at, []
                parts.append((side, h, w, cells))
            if done := [x for x in done if x]:
                yield table(done)
        if last := judge(current, parts):
            yield table([last])

    return met.mapInArrow(over, _SHIFTS)


def _full(tiles: DataFrame, size: int) -> DataFrame:
    """Smaller tiles at a scene's edge filled up with NULL, so that strips lie where the tile's pitch says."""
    along = F.sequence(F.lit(0), F.lit(size - 1))

    def line(y: Column) -> Column:
        return F.transform(along, lambda x: F.when((y < F.col("h")) & (x < F.col("w")), F.get("dn", y * F.col("w") + x)))

    short = (F.col("h") < size) | (F.col("w") < size)
    # first the cells, then the sizes: within one select the new sizes would be taken for the old ones
    filled = tiles.withColumn("dn", F.when(short, F.flatten(F.transform(along, line))).otherwise(F.col("dn")))
    return filled.withColumns({"h": F.lit(size), "w": F.lit(size)})


def register_shift(tiles: DataFrame, pairs: DataFrame, reach: int, size: int, least: float = 0.5) -> DataFrame:
    """One shift per pair of scenes: ``scene_a, scene_b, dr, dc, votes, n_tiles``.

    Every tile whose best score is ``least`` or more votes for its shift; most votes win, of equal ones the
    smallest shift. ``n_tiles`` is the number of votes given. A pair without a vote, and one whose scenes
    share no tile, has NULL shifts and 0 votes.
    """
    votes = tile_shifts(tiles, pairs, reach, size).where(F.col("score") >= least)
    counted = votes.groupBy(*PAIR, "dr", "dc").agg(F.count("*").alias("votes"))
    order = F.struct("votes", (-F.abs("dr") - F.abs("dc")).alias("near"), (-F.col("dr")).alias("y"), (-F.col("dc")).alias("x"))
    won = counted.groupBy(*PAIR).agg(F.max_by(F.struct("dr", "dc", "votes"), order).alias("best"), F.sum("votes").alias("n_tiles"))
    asked = pairs.select(*PAIR).where("scene_a is not null and scene_b is not null").distinct()
    none = F.lit(0).cast("long")
    return asked.join(won, PAIR, "left").select(
        *PAIR, "best.dr", "best.dc", F.coalesce("best.votes", none).alias("votes"), F.coalesce("n_tiles", none).alias("n_tiles")
    )


def align(px: DataFrame, shifts: DataFrame) -> DataFrame:
    """Cells of each ``scene_b`` moved onto its ``scene_a``; cells of other scenes stay where they are.

    A scene may be ``scene_b`` of one pair only. Scenes without a shift stay too. Cells of negative
    row or column, which lie outside of ``scene_a``'s frame, are kept.
    """
    moves = shifts.where("dr is not null").select(F.col("scene_b").alias("scene_id"), F.col("dr").alias("_dr"), F.col("dc").alias("_dc"))
    moved = attach(px, moves, ["scene_id"], "left")
    off = {"r": F.col("r") - F.coalesce("_dr", F.lit(0)), "c": F.col("c") - F.coalesce("_dc", F.lit(0))}
    return moved.withColumns(off).select(*px.columns)
