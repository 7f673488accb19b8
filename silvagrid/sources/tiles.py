"""Tile table <-> pixel table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.functions.grid import idiv
from silvagrid.sources.schemas import TILES


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TILES).parquet(path)


def tiles_to_pixels(tiles: DataFrame, size: int) -> DataFrame:
    """One row per cell of each row-major tile; other tile columns are kept.

    ``size`` is the tile pitch: tile ``(i, j)`` starts at ``(i*size, j*size)``.
    """
    extra = [x for x in tiles.columns if x not in ("scene_id", "tile_r", "tile_c", "h", "w", "dn")]
    cells = tiles.select(
        "scene_id", "tile_r", "tile_c", "w", *extra, F.posexplode("dn").alias("pos", "dn")
    )
    return cells.select(
        "scene_id",
        (F.col("tile_r") * size + idiv("pos", F.col("w"))).cast("int").alias("r"),
        (F.col("tile_c") * size + F.col("pos") % F.col("w")).cast("int").alias("c"),
        "dn",
        *extra,
    )


def pixels_to_tiles(px: DataFrame, size: int) -> DataFrame:
    """Row-major array tiles of any size; edge tiles are smaller.

    Absent cells become NULL entries. A group is one tile: at most
    ``size**2`` cells.
    """
    at = px.select(
        "scene_id",
        idiv("r", size).cast("int").alias("tile_r"),
        idiv("c", size).cast("int").alias("tile_c"),
        (F.col("r") % size).alias("i"),
        (F.col("c") % size).alias("j"),
        "dn",
    )
    packed = at.groupBy("scene_id", "tile_r", "tile_c").agg(
        (F.max("i") + 1).alias("h"),
        (F.max("j") + 1).alias("w"),
        F.collect_list(F.struct("i", "j", "dn")).alias("cells"),
    )
    placed = F.transform("cells", lambda x: F.struct((x.i * F.col("w") + x.j).alias("pos"), x.dn.alias("dn")))
    packed = packed.withColumn("cells", placed)
    every = F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)
    holes = F.transform(
        F.array_except(every, F.col("cells.pos")),
        lambda p: F.struct(p.alias("pos"), F.lit(None).cast("int").alias("dn")),
    )
    full = F.array_sort(F.concat(F.col("cells"), holes))
    return packed.select("scene_id", "tile_r", "tile_c", "h", "w", full["dn"].alias("dn"))
