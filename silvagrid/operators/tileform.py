"""Tile form of the neighbourhood and run steps.

The same definitions as ``focal``, ``morphology`` and ``regions.block_runs``, on
array tiles: borders travel as strips and a task works on whole arrays. Use it
when scenes are stored as tiles; several times less data moves and no cell is
sorted. The tests hold both forms to equal results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame

from silvagrid.operators.extend import TILE_COLUMNS, tile_map_halo


def _square_steps() -> tuple[Callable, Callable]:
    """``count_and_sum(a, k)`` and ``extreme(a, k, largest)`` over squares of side
    ``2*k + 1``, shrinking the array by ``k`` on each side; NaN is left out."""

    def count_and_sum(a, k):
        import numpy as np

        side = 2 * k + 1

        def box(x):
            total = np.pad(x.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
            return total[side:, side:] - total[:-side, side:] - total[side:, :-side] + total[:-side, :-side]

        there = ~np.isnan(a)
        return box(there.astype(np.int64)), box(np.where(there, a, 0).astype(np.int64))

    def extreme(a, k, largest):
        import numpy as np

        pick, empty = (np.max, -np.inf) if largest else (np.min, np.inf)
        out = np.where(np.isnan(a), empty, a)
        for axis in (0, 1):
            out = pick(np.lib.stride_tricks.sliding_window_view(out, 2 * k + 1, axis=axis), axis=-1)
        return np.where(np.isinf(out), np.nan, out)

    return count_and_sum, extreme


def square_function(kind: str, radius: int) -> Callable:
    """Square neighbourhood ``sum``, ``min``, ``max`` or lower ``median``."""
    count_and_sum, extreme = _square_steps()

    def fn(padded):
        import numpy as np

        if kind == "sum":
            n, total = count_and_sum(padded, radius)
            return np.where(n > 0, total, np.nan)
        if kind in ("min", "max"):
            return extreme(padded, radius, kind == "max")
        side = 2 * radius + 1
        views = np.lib.stride_tricks.sliding_window_view(padded, (side, side))
        cells = np.sort(views.reshape(*views.shape[:2], -1), axis=-1)
        # NaN sorts last, so the lower median of n values is at (n - 1) // 2
        n = (~np.isnan(cells)).sum(axis=-1)
        return np.take_along_axis(cells, np.maximum(n - 1, 0)[..., None] // 2, axis=-1)[..., 0]

    return fn


def focal_tiles(tiles: DataFrame, kind: str, radius: int, size: int) -> DataFrame:
    """Square aggregate of each cell, as tiles."""
    return tile_map_halo(tiles, square_function(kind, radius), radius, size)


def stretched_mean(tiles: DataFrame, radius: int, size: int) -> DataFrame:
    """Rescale ``_lo.._hi`` to 0..255 and take the focal mean rounded to a whole level.

    ``tiles`` carry ``_lo`` and ``_hi``.
    """
    count_and_sum, _ = _square_steps()

    def fn(padded, lo, hi):
        import numpy as np

        if lo is None:
            return np.full(np.subtract(padded.shape, 2 * radius), np.nan)
        there = ~np.isnan(padded)
        level = (np.clip(np.where(there, padded, lo), lo, hi) - lo).astype(np.int64) * 255 // max(int(hi - lo), 1)
        n, total = count_and_sum(np.where(there, level, np.nan), radius)
        middle = there[radius:-radius, radius:-radius]
        return np.where(middle, (2 * total + n) // np.maximum(2 * n, 1), np.nan)

    return tile_map_halo(tiles, fn, radius, size, ["_lo", "_hi"])


def threshold_and_open(tiles: DataFrame, radius: int, size: int, polarity: str) -> DataFrame:
    """Class tiles: compare with the tile's ``threshold`` column, then erode and dilate."""
    _, extreme = _square_steps()

    def fn(padded, threshold):
        import numpy as np

        gone = np.isnan(padded)
        if threshold is None:
            return np.full(np.subtract(padded.shape, 4 * radius), np.nan)
        hit = padded <= threshold if polarity == "dark" else padded > threshold
        cls = np.where(gone, np.nan, hit)
        for largest in (False, True):
            gone = gone[radius:-radius, radius:-radius]
            cls = np.where(gone, np.nan, extreme(cls, radius, largest))
        return cls

    return tile_map_halo(tiles, fn, 2 * radius, size, ["threshold"])


def tile_runs(tiles: DataFrame, size: int, per_block: int = 1) -> DataFrame:
    """Runs of equal class in each tile: what ``block_runs`` gives for blocks of
    ``size``. With ``per_block`` the block key names groups of that many tiles along
    each side, so that small tiles are labelled together."""

    def over(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["scene_id", "_br", "_bc", "r", "c0", "c1", "cls"]
        for batch in batches:
            out = [np.empty((0, len(names)))]
            columns = [batch.column(x).to_pylist() for x in ("scene_id", "tile_r", "tile_c", "w")]
            for scene, tile_r, tile_c, w, dn in zip(*columns, batch.column("dn")):
                cells = dn.values.to_numpy(zero_copy_only=False).astype(float)
                code = np.where(np.isnan(cells), -1, cells).reshape(-1, w)
                fresh = np.ones(code.shape, dtype=bool)
                fresh[:, 1:] = code[:, 1:] != code[:, :-1]
                first = np.flatnonzero(fresh)
                last = np.append(first[1:], code.size) - 1
                place = [np.full(len(first), x) for x in (scene, tile_r // per_block, tile_c // per_block)]
                where = [tile_r * size + first // w, tile_c * size + first % w, tile_c * size + last % w]
                out.append(np.stack([*place, *where, cells[first]], axis=1))
            rows = np.concatenate(out)
            gone = np.isnan(rows)
            whole = np.where(gone, 0, rows).astype("int32")
            arrays = [pa.array(whole[:, i], mask=gone[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return tiles.select(*TILE_COLUMNS).mapInArrow(
        over, "scene_id int, _br int, _bc int, r int, c0 int, c1 int, cls int"
    )
