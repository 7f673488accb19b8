"""Test inputs derived by Spark from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvagrid.functions.grid import clamp, idiv
from silvagrid.sources import schemas
from silvagrid.sources.tiles import pixels_to_tiles, tiles_to_pixels

TILE = 8
ZONES = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = getattr(schemas, name.upper())
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _level(x: Column) -> Column:
    """Grey level 0..255 of a vector entry."""
    return clamp(F.floor((x.cast("double") + 0.5) * 255).cast("int"), 0, 255)


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8x8 tiles of raw entries, 100 per scene, with truth class and zone of the tile."""
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        idiv(v, 100).cast("int").alias("scene_id"),
        idiv(v % 100, 10).cast("int").alias("tile_r"),
        (v % 10).cast("int").alias("tile_c"),
        F.lit(TILE).alias("h"),
        F.lit(TILE).alias("w"),
        F.col("embedding").alias("dn"),
        (F.col("label") >= 5).cast("int").alias("truth"),
        (v % ZONES).cast("int").alias("zone_id"),
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tile table: ``scene_id, tile_r, tile_c, h, w, dn, truth, zone_id``."""
    return _placed(spark, sf_dir).withColumn("dn", F.transform("dn", _level))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scene_id, r, c, dn, truth, zone_id``; levels are computed after the arrays
    are opened, inside generated code."""
    return tiles_to_pixels(_placed(spark, sf_dir), TILE).withColumn("dn", _level(F.col("dn")))


def with_date(df: DataFrame) -> DataFrame:
    """Acquisition date: one scene every 90 days from 1962-06-01."""
    return df.withColumn("acq_date", F.expr("date_add(DATE '1962-06-01', scene_id * 90)"))


def twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scene and, as scene 1000 + s, the same ground on other film: moved by ``s % 5 - 2`` rows and ``s % 3 - 1``
    columns, of other gain and offset, dark cells nodata. From 1,000 scenes on, such a number stands for both."""
    px = pixels(spark, sf_dir).select("scene_id", "r", "c", "dn")
    return px.unionByName(moved_scenes(px, 1000))


def moved_scenes(px: DataFrame, plus: int) -> DataFrame:
    """The other film of every scene, as scene ``plus + s``."""
    s, dn = F.col("scene_id"), F.col("dn")
    level = F.when(dn >= 40, idiv(dn * 3, 4).cast("int") + 20)
    moved = px.select((s + plus).cast("int").alias("scene_id"), (F.col("r") + s % 5 - 2).alias("r"), (F.col("c") + s % 3 - 1).alias("c"), level.alias("dn"))
    return moved.where("r >= 0 and c >= 0")


def twin_tiles(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """``twins`` as tiles; where a number stands for two scenes, each has its own rows."""
    px = pixels(spark, sf_dir).select("scene_id", "r", "c", "dn")
    return pixels_to_tiles(px, size).unionByName(pixels_to_tiles(moved_scenes(px, 1000), size))


def twin_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each scene with its twin, and with the next scene, which shows other ground."""
    scenes = pixels(spark, sf_dir).select("scene_id").distinct()
    other = F.array(F.col("scene_id") + 1000, F.col("scene_id") + 1)
    return scenes.select(F.col("scene_id").alias("scene_a"), F.explode(other).alias("scene_b"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping acquisitions on a 128x128 grid."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 128).cast("int").alias("r"),
        (F.col("l_partkey") % 128).cast("int").alias("c"),
        (F.col("l_quantity") * 5).cast("int").alias("dn"),
        F.col("l_shipdate").alias("acq_ts"),
        (F.col("l_suppkey") % 10).cast("int").alias("strip"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ground seen by ten strips, each of other gain and offset; every seventh cell of a strip is nodata."""
    obs = observations(spark, sf_dir)
    ground = (F.col("r") * 37 + F.col("c") * 53) % 160
    seen = idiv(ground * (100 + F.col("strip") * 4), 100).cast("int") + F.col("strip") * 3 + 5
    return obs.withColumn("dn", F.when((F.col("r") + F.col("c") + F.col("strip")) % 7 > 0, seen))


def arrivals_of(events: DataFrame) -> DataFrame:
    """Tile arrivals; works on a batch or a streaming ``events`` table."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("source_id"),
        F.col("event_type").alias("kind"),
        (F.col("user_id") % ZONES).cast("int").alias("zone_id"),
        "value",
        "props",
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrivals_of(table(spark, sf_dir, "events"))


def control_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control points of a known affine transform plus noise."""
    k = F.col("c_custkey")
    c, r, noise = (k % 80).cast("double"), ((k * 7) % 80).cast("double"), F.col("c_acctbal") / 1000
    return table(spark, sf_dir, "customer").select(
        (k % 5).cast("int").alias("scene_id"),
        r.alias("r"),
        c.alias("c"),
        (2.0 * c - 0.5 * r + 100 + noise).alias("x"),
        (0.5 * c + 2.0 * r + 200 - noise).alias("y"),
    )


def zone_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone, its name and the region it belongs to."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone"), F.col("r_name").alias("region")
    )


def zone_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One triangle per nation as three directed edges in pixel coordinates."""
    n = F.col("n_nationkey")
    y0, x0 = (n * 7 % 80).cast("double"), (n * 11 % 80).cast("double")
    corners = [(y0, x0), (y0 + 30, x0 + 5), (y0 + 10, x0 + 40)]
    edges = F.array(*[
        F.struct(a[1].alias("x1"), a[0].alias("y1"), b[1].alias("x2"), b[0].alias("y2"))
        for a, b in zip(corners, corners[1:] + corners[:1])
    ])
    return (
        table(spark, sf_dir, "nation")
        .select(n.alias("zone_id"), F.explode(edges).alias("e"))
        .select("zone_id", "e.*")
    )
