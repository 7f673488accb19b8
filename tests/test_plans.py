"""What the plans must look like at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators import focal, morphology, radiometry, regions, texture, threshold, tileform, zonal
from silvagrid.plans import staging
from silvagrid.sources import catalogue, parquet
from workload import tables
from tests.conftest import SF_DIR
from workload.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange\b", plan(df).split("Initial Plan")[0]))


@pytest.fixture(scope="module")
def px(spark):
    return tables.pixels(spark, SF_DIR)


@pytest.mark.parametrize(
    "step",
    [
        lambda px: focal.focal_sum(px),
        lambda px: focal.focal_std(px),
        lambda px: focal.focal_median(px),
        lambda px: focal.convolve(px, [[1, 2, 1], [2, 4, 2], [1, 2, 1]]),
        lambda px: texture.sobel(px),
        lambda px: morphology.morph_open(threshold.threshold_fixed(px, 128)),
        lambda px: regions.runs_of(threshold.threshold_fixed(px, 128)),
    ],
)
def test_one_exchange(px, step):
    assert exchanges(step(px)) == 1


def test_opening_and_runs_share_the_exchange(px):
    from silvagrid.plans.blocks import own_cells, to_blocks

    mask = threshold.threshold_fixed(px, 128).select(*CELL, "cls")
    opened = own_cells(morphology.morph_pass(to_blocks(mask, 2), 1, "min", "max"))
    assert exchanges(regions.block_runs(opened)) == 1


def test_stretch_does_not_move_pixels(px):
    assert exchanges(radiometry.percentile_stretch(px)) == 0


def test_halo_takes_one_exchange_and_one_sort(spark):
    text = plan(tileform.focal_tiles(tables.tiles(spark, SF_DIR), "sum", 1, tables.TILE))
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text and text.count("Sort [") == 1


#: Queries whose small sides Spark may join by nested loop would show here.
@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream", "kmeans", "predict", "train"))])
def test_no_cross_or_nested_loop_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "SinglePartition" not in text or name in GLOBAL_TOTALS


#: One output row per whole input: the last step of a total over a few rows.
GLOBAL_TOTALS = {"area_adjusted"}


def test_columns_are_pruned_and_filters_pushed(spark, px, tmp_path):
    scanned = plan(px.select("dn"))
    assert "label" not in re.search(r"ReadSchema: (\S+)", scanned).group(1)
    path = str(tmp_path / "scenes")
    parquet.write_scene_parquet(px.select(*CELL, "dn"), path, rows_per_file=16)
    some = catalogue.clip_bbox(parquet.read_scene_parquet(spark, path, [1, 2]), 10, 20, 5, 9)
    text = plan(some)
    assert "scene_id" in re.search(r"PartitionFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(r,10)" in text
    assert some.count() == 2 * 11 * 5
    assert parquet.read_scene_parquet(spark, path).count() == px.count()


def test_sort_order_inside_files(spark, px, tmp_path):
    path = str(tmp_path / "scenes")
    parquet.write_scene_parquet(px.select(*CELL, "dn"), path)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files == px.select("scene_id").distinct().count()


def test_zones_are_summed_before_grouping_sets(px, spark):
    text = plan(zonal.zonal_cube(threshold.threshold_fixed(px, 128), tables.zone_names(spark, SF_DIR)))
    assert text.count("Expand") == 1
    assert "HashAggregate" in text[text.index("Expand") : text.index("Generate")]


def test_staging_folder_is_the_one_named(spark):
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staging.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_staged_tables_can_be_cleared(spark, monkeypatch):
    folder = staging.shared_dir(spark) + "/clear"
    monkeypatch.setattr(staging, "shared_dir", lambda _: folder)
    kept = staging.stage(spark.range(3), "x")
    assert kept.count() == 3
    path = f"{folder}/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert os.path.exists(path)
    staging.clear_staged(spark)
    assert not os.path.exists(path)
