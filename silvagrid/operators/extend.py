"""User functions on tiles. A function sees one tile as a numpy array; Spark
partitions the tiles and moves them as Arrow batches. Keep
``spark.sql.execution.arrow.maxRecordsPerBatch`` low enough for the tile size
(100 for 256 x 256 tiles is 25 MB per batch).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.sources.schemas import TILES
from silvagrid.sources.tiles import pixels_to_tiles

TILE_COLUMNS = [f.name for f in TILES]
TILE_DDL = "scene_id int, tile_r int, tile_c int, h int, w int, dn array<int>"


def _arrays_of() -> tuple[Callable, Callable]:
    """Arrow list column -> one float array per row (NaN for NULL), and back.

    Nested functions, so that they travel to the workers with their callers.
    """

    def unpack(column):
        import numpy as np

        cells = column.flatten().to_numpy(zero_copy_only=False).astype(float)
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(int)
        return np.split(cells, np.cumsum(sizes)[:-1])

    def pack(arrays):
        import numpy as np
        import pyarrow as pa

        flat = np.concatenate(arrays) if arrays else np.empty(0)
        gone = np.isnan(flat)
        ends = np.cumsum([0, *map(len, arrays)]).astype("int32")
        values = pa.array(np.where(gone, 0, flat).astype("int32"), mask=gone)
        return pa.ListArray.from_arrays(pa.array(ends), values)

    return unpack, pack


def unpack_tiles() -> Callable:
    """The function that opens an Arrow column of tiles as float arrays, NaN for NULL."""
    return _arrays_of()[0]


def tile_map(tiles: DataFrame, fn: Callable) -> DataFrame:
    """Apply ``fn(array (h, w) of float, NaN nodata) -> array (h, w)`` to each tile."""
    unpack, pack = _arrays_of()

    def over(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = [batch.column(x) for x in ("scene_id", "tile_r", "tile_c", "h", "w")]
            sizes = zip(kept[3].to_pylist(), kept[4].to_pylist())
            out = [fn(x.reshape(h, w)).ravel() for x, (h, w) in zip(unpack(batch.column("dn")), sizes)]
            yield pa.RecordBatch.from_arrays([*kept, pack(out)], ["scene_id", "tile_r", "tile_c", "h", "w", "dn"])

    return tiles.select(*TILE_COLUMNS).mapInArrow(over, TILE_DDL)


def apply_model_tiles(tiles: DataFrame, model: Callable) -> DataFrame:
    """Class per cell from a user's model ``fn(array (n_cells,)) -> array``, called
    once per Arrow batch on the cells of all its tiles."""
    unpack, pack = _arrays_of()

    def over(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            kept = [batch.column(x) for x in ("scene_id", "tile_r", "tile_c", "h", "w")]
            parts = unpack(batch.column("dn"))
            scores = np.asarray(model(np.concatenate(parts)), dtype=float) if parts else np.empty(0)
            out = np.split(scores, np.cumsum([len(x) for x in parts])[:-1]) if parts else []
            yield pa.RecordBatch.from_arrays([*kept, pack(out)], ["scene_id", "tile_r", "tile_c", "h", "w", "cls"])

    return tiles.select(*TILE_COLUMNS).mapInArrow(over, TILE_DDL.replace("dn array", "cls array"))


def _strip(i: int, j: int, radius: int) -> tuple[Column, Column]:
    """The part of a tile that its neighbour at ``(i, j)`` needs, row-major, and its width."""

    def span(step: int, n: Column) -> tuple[Column, Column]:
        size = n if step == 0 else F.least(n, F.lit(radius))
        return (n - size if step == 1 else F.lit(0)), size

    (r0, rows), (c0, cols) = span(i, F.col("h")), span(j, F.col("w"))
    lines = F.sequence(r0, r0 + rows - 1)
    return F.flatten(F.transform(lines, lambda y: F.slice("dn", y * F.col("w") + c0 + 1, cols))), cols


def halo_pieces(tiles: DataFrame, radius: int, params: Sequence[str] = ()) -> DataFrame:
    """Each tile and its eight edge strips, keyed by the tile that needs them: ``scene_id, tile_r, tile_c, side, h, w, dn``
    and ``params``.

    ``side`` is 3 times the row step plus the column step of where the piece lies, 4 for the tile itself;
    ``h`` and ``params`` are set for the tile itself only.
    """
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]

    # a strip sent in direction (i, j) is the receiver's border on the opposite side
    def send(i: int, j: int) -> Column:
        own = (i, j) == (0, 0)
        cells, width = (F.col("dn"), F.col("w")) if own else _strip(i, j, radius)
        return F.struct(
            (F.col("tile_r") + i).alias("tile_r"),
            (F.col("tile_c") + j).alias("tile_c"),
            F.lit(3 * (1 - i) + (1 - j)).alias("side"),
            (F.col("h") if own else F.lit(None).cast("int")).alias("h"),
            width.alias("w"),
            cells.alias("dn"),
            *[(F.col(x) if own else F.lit(None)).cast("double").alias(x) for x in params],
        )

    sent = F.array(*[send(i, j) for i, j in steps])
    return tiles.select("scene_id", F.explode(sent).alias("p")).select("scene_id", "p.*")


def tile_map_halo(
    tiles: DataFrame, fn: Callable, radius: int, size: int, params: Sequence[str] = ()
) -> DataFrame:
    """Apply ``fn(padded, *params) -> array (h, w)`` where ``padded`` is the tile with a
    border of ``radius`` cells from its neighbours, NaN where there is none, and
    ``params`` names further number columns of the tile.

    Each tile sends itself and eight edge strips. They meet by one exchange and one sort on the
    tile key, at most nine rows per tile, and are put together in Arrow batches. Only the last tile row and column of a
    scene may be smaller than ``size``.
    """
    if not 0 < radius <= size:
        raise ValueError("radius must be at most the tile side")
    pieces = halo_pieces(tiles, radius, params)
    key = ["scene_id", "tile_r", "tile_c"]
    framed = pieces.repartition(*key).sortWithinPartitions(*key)
    unpack, pack = _arrays_of()

    def over(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def frame(at: tuple, parts: list) -> tuple | None:
            own = next((x for x in parts if x[0] == 4), None)
            if own is None:
                return None
            _, h, w, _, given = own
            padded = np.full((h + 2 * radius, w + 2 * radius), np.nan)
            starts = [(0, radius, radius + n) for n in (h, w)]
            for side, _, width, cells, _ in parts:
                piece = cells.reshape(-1, width)
                y, x = starts[0][side // 3], starts[1][side % 3]
                padded[y : y + piece.shape[0], x : x + piece.shape[1]] = piece
            return (*at, h, w, fn(padded, *given).ravel())

        def table(tiles: list) -> pa.RecordBatch:
            *kept, cells = zip(*tiles)
            return pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int32()) for x in kept), pack(list(cells))], ["scene_id", "tile_r", "tile_c", "h", "w", "dn"]
            )

        current, parts = None, []
        for batch in batches:
            done = []
            names = [*key, "side", "h", "w", *params]
            columns = [batch.column(x).to_pylist() for x in names]
            for (scene, i, j, side, h, w, *given), cells in zip(zip(*columns), unpack(batch.column("dn"))):
                if (scene, i, j) != current:
                    done.append(frame(current, parts))
                    current, parts = (scene, i, j), []
                parts.append((side, h, w, cells, given))
            if done := [x for x in done if x]:
                yield table(done)
        if last := frame(current, parts):
            yield table([last])

    return framed.mapInArrow(over, TILE_DDL)


def tile_value(tiles: DataFrame, fn: Callable, name: str = "value") -> DataFrame:
    """One number per tile from ``fn(array (h, w) of float, NaN nodata) -> float``: ``scene_id, tile_r, tile_c`` and ``name``.

    Tiles stay where they are and pass through Python as Arrow batches.
    """
    unpack, _ = _arrays_of()

    def over(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = [batch.column(x) for x in ("scene_id", "tile_r", "tile_c")]
            sizes = zip(batch.column("h").to_pylist(), batch.column("w").to_pylist())
            out = [float(fn(x.reshape(h, w))) for x, (h, w) in zip(unpack(batch.column("dn")), sizes)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.float64())], ["scene_id", "tile_r", "tile_c", name])

    return tiles.select(*TILE_COLUMNS).mapInArrow(over, f"scene_id int, tile_r int, tile_c int, {name} double")


def tile_entropy(px: DataFrame, side: int) -> DataFrame:
    """Shannon entropy of the grey levels of each block of ``side**2`` cells, in nats, by a user function on tiles.

    0 for a block of nodata. For scenes stored as tiles of that side call ``tile_value`` on them, without an exchange.
    """

    def entropy(image) -> float:
        import numpy as np

        _, n = np.unique(image[~np.isnan(image)], return_counts=True)
        p = n / n.sum()
        return abs(-(p * np.log(p)).sum())

    return tile_value(pixels_to_tiles(px.select("scene_id", "r", "c", "dn"), side), entropy, "entropy").withColumn("entropy", F.round("entropy", 6))


def register_tile_px(spark) -> None:
    """Register the user table function ``tile_px(tile_r, tile_c, w, size, dn)`` for SQL."""

    @F.udtf(returnType="r int, c int, dn int")
    class TilePx:
        def eval(self, tile_r: int, tile_c: int, w: int, size: int, dn: list):
            for pos, value in enumerate(dn):
                yield tile_r * size + pos // w, tile_c * size + pos % w, value

    spark.udtf.register("tile_px", TilePx)


def tile_px(tiles: DataFrame, size: int) -> DataFrame:
    """Tile cells through the table function, by a lateral call."""
    spark = tiles.sparkSession
    register_tile_px(spark)
    return spark.sql(
        "SELECT t.scene_id, p.r, p.c, p.dn FROM {tiles} t, LATERAL tile_px(t.tile_r, t.tile_c, t.w, {size}, t.dn) p",
        tiles=tiles.select(*TILE_COLUMNS),
        size=size,
    )
