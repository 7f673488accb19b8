"""Growth of time and shuffle with the number of pixels.

The tiles of the ``embeddings`` table are repeated to fill large square scenes
and written once to the shared folder; the steps below then run on them with the
default block size. One JSON line per size.

BENCH_SF_DIR, BENCH_CPUS as in ``bench.py``; BENCH_TILES: tiles along a scene's
side (default 128, a 1024 x 1024 scene); BENCH_SCENES: comma-separated numbers of
scenes (default 1,4,16).
"""

from __future__ import annotations

import json
import os
import time
import urllib.request

from bench import session
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL, idiv
from silvagrid.operators import focal, morphology, regions, threshold, tileform
from silvagrid.plans.blocks import BLOCK
from silvagrid.plans.forest import forest_extract, forest_extract_tiles
from silvagrid.plans.staging import new_path, stage
from workload import tables
from silvagrid.sources.parquet import read_scene_parquet, write_scene_parquet
from silvagrid.sources.tiles import pixels_to_tiles, tiles_to_pixels


def raster(spark: SparkSession, sf_dir: str, scenes: int, side: int) -> DataFrame:
    """``scenes`` scenes of ``side x side`` tiles, the given tiles in turn."""
    given = tables.tiles(spark, sf_dir).withColumn("id", F.expr("scene_id * 100 + tile_r * 10 + tile_c"))
    n = given.count()
    total = scenes * side * side
    copies = F.sequence(F.lit(0), F.lit(total // n))
    many = given.select("h", "w", "dn", "id", F.explode(copies).alias("copy"))
    placed = many.withColumn("t", F.col("id") + F.col("copy") * n).filter(F.col("t") < total).select(
        idiv("t", side * side).cast("int").alias("scene_id"),
        (idiv("t", side) % side).cast("int").alias("tile_r"),
        (F.col("t") % side).cast("int").alias("tile_c"),
        "h",
        "w",
        "dn",
    )
    path = new_path(spark, "raster")
    write_scene_parquet(tiles_to_pixels(placed.repartition(64), tables.TILE), path, 128)
    return read_scene_parquet(spark, path)


def plain_mean(px: DataFrame) -> DataFrame:
    """The focal mean without block layout, for comparison: two exchanges."""
    row = Window.partitionBy("scene_id", "r").orderBy("c").rangeBetween(-1, 1)
    col = Window.partitionBy("scene_id", "c").orderBy("r").rangeBetween(-1, 1)
    rows = px.withColumn("s", F.sum("dn").over(row)).withColumn("n", F.count("dn").over(row))
    return rows.select(*CELL, F.sum("s").over(col) / F.sum("n").over(col))


def as_tiles(px: DataFrame) -> DataFrame:
    return stage(pixels_to_tiles(px, BLOCK), "tiles")


TILE_STEPS = {
    "focal_sum_tiles": lambda tiles: tileform.focal_tiles(tiles, "sum", 1, BLOCK),
    "forest_extract_tiles": lambda tiles: forest_extract_tiles(tiles, BLOCK),
}

STEPS = {
    "focal_mean": lambda px: focal.focal_mean(px),
    "focal_mean_plain": plain_mean,
    "morph_open": lambda px: morphology.morph_open(threshold.threshold_fixed(px, 128)),
    "connected_components": lambda px: regions.connected_components(threshold.threshold_fixed(px, 150, "bright")),
    "forest_extract": forest_extract,
}


def shuffled(spark: SparkSession) -> int:
    """Shuffle bytes written so far, from the monitoring REST API."""
    context = spark.sparkContext
    url = f"{context.uiWebUrl}/api/v1/applications/{context.applicationId}/executors"
    with urllib.request.urlopen(url) as answer:
        return sum(x["totalShuffleWrite"] for x in json.load(answer))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    side = int(os.environ.get("BENCH_TILES", "128"))
    spark = session(os.environ.get("BENCH_CPUS", "8"), ui="true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    for scenes in map(int, os.environ.get("BENCH_SCENES", "1,4,16").split(",")):
        px = raster(spark, sf_dir, scenes, side)
        line = {"pixels": px.count(), "scenes": scenes}
        for name, step in {**STEPS, **TILE_STEPS}.items():
            given = as_tiles(px) if name in TILE_STEPS else px
            before, start = shuffled(spark), time.perf_counter()
            step(given).write.format("noop").mode("overwrite").save()
            line[name] = {
                "sec": round(time.perf_counter() - start, 2),
                "shuffle_mb": round((shuffled(spark) - before) / 1e6, 1),
            }
        print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
