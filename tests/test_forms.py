"""Pixel form against tile form, skewed paths against plain ones, properties on noise."""

import random

import pytest
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators import accuracy, change, extend, focal, morphology, radiometry, regions, threshold, tileform, zonal
from silvagrid.plans.staging import stage
from silvagrid.plans import joins
from silvagrid.plans.forest import forest_extract, forest_extract_tiles
from silvagrid.plans.series import running
from silvagrid.sources import tiles
from workload import tables
from tests.conftest import SF_DIR


def noise(seed, h=24, w=31, levels=256, nulls=0.05):
    rnd = random.Random(seed)
    return [[None if rnd.random() < nulls else rnd.randrange(levels) for _ in range(w)] for _ in range(h)]


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("kind,radius", [("sum", 1), ("min", 2), ("max", 3), ("median", 1), ("median", 2)])
def test_pixel_form_equals_tile_form(grid, kind, radius):
    px = grid(noise(1), noise(2, 17, 9))
    if kind == "median":
        pixel_form = focal.focal_median(px, radius, 7).withColumnRenamed("f_median", "v")
    else:
        pixel_form = focal.focal(px, radius, block=7, v=kind)
    tiled = tileform.focal_tiles(tiles.pixels_to_tiles(px, 5), kind, radius, 5)
    assert rows(tiles.tiles_to_pixels(tiled, 5), *CELL, "dn") == rows(pixel_form, *CELL, "v")


@pytest.mark.parametrize("polarity,radius,size", [("dark", 1, 7), ("bright", 2, 8)])
def test_flagship_forms_agree(grid, polarity, radius, size):
    """Ragged edge tiles, nodata, a constant scene and a scene without data."""
    px = grid(noise(11, 40, 33), noise(12, 23, 50, 90), [[5] * 9] * 9, [[None] * 9] * 9)
    want = forest_extract(px, polarity, radius, 3, block=16)
    got = forest_extract_tiles(tiles.pixels_to_tiles(px, size), size, polarity, radius, 3)
    assert rows(got, *CELL, "cls") == rows(want, *CELL, "cls")
    assert {r["cls"] for r in want.select("cls").distinct().collect()} == {0, 1, None}


def test_runs_forms_agree(grid):
    mask = threshold.threshold_fixed(grid(noise(13, 19, 23)), 120).select(*CELL, "cls")
    made = tiles.pixels_to_tiles(mask.withColumnRenamed("cls", "dn"), 6)
    columns = ["scene_id", "_br", "_bc", "r", "c0", "c1", "cls"]
    assert rows(tileform.tile_runs(made, 6), *columns) == rows(regions.runs_of(mask, 6), *columns)


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("per_block", [1, 2, 9])
def test_tiles_labelled_together(grid, connectivity, per_block):
    """Runs cut at tile borders join up again, inside a block and across blocks."""
    mask = threshold.threshold_fixed(grid(noise(14, 19, 23)), 140).select(*CELL, "cls")
    made = tiles.pixels_to_tiles(mask.withColumnRenamed("cls", "dn"), 4)
    runs = tileform.tile_runs(made, 4, per_block).filter("cls = 1")
    got = regions.to_pixels(regions.label_runs(runs, connectivity, 4 * per_block), "region_id")
    want = regions.connected_components(mask, connectivity)
    assert rows(got, *CELL, "region_id") == rows(want, *CELL, "region_id")


@pytest.mark.parametrize("block", [3, 8, 256])
def test_blocks_do_not_show(grid, block):
    px = grid(noise(3))
    want = rows(focal.focal_sum(px, 2, 64), *CELL, "f_sum", "f_n")
    assert rows(focal.focal_sum(px, 2, block), *CELL, "f_sum", "f_n") == want
    mask = threshold.threshold_fixed(px, 120)
    if block > 4:
        assert rows(morphology.morph_open(mask, 2, block), *CELL, "cls") == rows(
            morphology.dilate(morphology.erode(mask, 2, 64), 2, 64), *CELL, "cls"
        )


def test_morphology_order_and_idempotence(grid):
    mask = threshold.threshold_fixed(grid(noise(4, nulls=0.0)), 170)
    both = morphology.erode(mask).withColumnRenamed("cls", "lo").join(
        morphology.dilate(mask).withColumnRenamed("cls", "hi"), CELL
    ).join(mask, CELL)
    assert both.filter("lo > cls or cls > hi").count() == 0
    for step in (morphology.morph_open, morphology.morph_close):
        once = step(mask)
        assert rows(step(once), *CELL, "cls") == rows(once, *CELL, "cls")


def flood(picture, connectivity):
    """Brute-force regions of cells equal to 1."""
    cells = {(r, c) for r, line in enumerate(picture) for c, x in enumerate(line) if x == 1}
    steps = [(0, 1), (1, 0), (0, -1), (-1, 0)]
    if connectivity == 8:
        steps += [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    label = {}
    for cell in sorted(cells):
        todo = [] if cell in label else [cell]
        while todo:
            r, c = todo.pop()
            if (r, c) in cells and (r, c) not in label:
                label[(r, c)] = (cell[0] << 32) + cell[1]
                todo += [(r + i, c + j) for i, j in steps]
    return label


def spiral(n):
    picture = [[0] * n for _ in range(n)]
    r = c = 0
    dr, dc = 0, 1
    picture[0][0] = 1
    while True:
        moved = 0
        while 0 <= r + dr < n and 0 <= c + dc < n and not (
            0 <= r + 2 * dr < n and 0 <= c + 2 * dc < n and picture[r + 2 * dr][c + 2 * dc]
        ):
            r, c = r + dr, c + dc
            picture[r][c] = 1
            moved += 1
        if moved == 0:
            return picture
        dr, dc = dc, -dr


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_match_flood_fill(grid, connectivity):
    """Noise, one region that winds through all blocks, and one region of everything."""
    pictures = [
        [[int(x is not None and x < 120) for x in line] for line in noise(5, 20, 20)],
        spiral(21),
        [[1] * 20 for _ in range(20)],
    ]
    out = regions.connected_components(grid(*pictures, value="cls"), connectivity, 4)
    got = {(r["scene_id"], r["r"], r["c"]): r["region_id"] for r in out.collect()}
    want = {(s, *cell): k for s, p in enumerate(pictures) for cell, k in flood(p, connectivity).items()}
    assert got == want


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("block,first,fan", [(2, 2, 2), (3, 2, 3), (1, 2, 2), (4, 16, 4), (2, 3, 2)])
def test_squares_of_squares(spark, grid, connectivity, block, first, fan):
    """Several levels, scenes of several sizes, one of them at negative rows and columns."""
    pictures = [[[int(x is not None and x < 130) for x in line] for line in noise(6, 27, 31)], spiral(25), [[1] * 17 for _ in range(19)], [[1]]]
    mask = grid(*pictures, value="cls").filter("cls = 1").withColumns({
        "r": F.when(F.col("scene_id") == 1, F.col("r") - 9).otherwise(F.col("r")),
        "c": F.when(F.col("scene_id") == 1, F.col("c") - 14).otherwise(F.col("c")),
    })
    local = regions.runs_of(mask.select(*CELL, "cls"), block)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in local.schema) + ", node long"
    local = stage(local.groupBy(*regions.BLOCK_KEY).applyInPandas(regions._block_labeller(connectivity), schema))
    labels = regions.block_union(local, connectivity, block, first, fan)
    assert labels.groupBy("scene_id", "node").count().filter("count > 1").isEmpty()
    out = regions.to_pixels(local.join(labels, ["scene_id", "node"], "left").withColumn("id", F.coalesce("label", "node")), "id")
    want = {(s, *cell): k for s, p in enumerate(pictures) for cell, k in flood(p, connectivity).items()}
    got, names = {}, {}
    for r in out.collect():
        off = (9, 14) if r["scene_id"] == 1 else (0, 0)
        got[r["scene_id"], r["r"] + off[0], r["c"] + off[1]] = r["id"]
    assert set(got) == set(want)
    for cell, k in want.items():  # the same regions; the same names where the scene was not moved
        assert names.setdefault((cell[0], k), got[cell]) == got[cell]
        assert cell[0] == 1 or got[cell] == k
    assert len(set(names.values())) == len(names) or len({(s, v) for (s, _), v in names.items()}) == len(names)


def test_few_jobs_whatever_the_shape(spark, grid):
    mask = grid(spiral(65), value="cls")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spiral", "spiral")
    try:
        regions.connected_components(mask, 8, 8).count()
        assert len(tracker.getJobIdsForGroup("spiral")) <= 20
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_is_the_same_exchanged(spark, how):
    px = tables.pixels(spark, SF_DIR).select(*CELL, "dn")
    stats = px.filter("scene_id <> 3").groupBy("scene_id").agg(F.max("dn").alias("top"))
    plain = rows(joins.attach(px, stats, ["scene_id"], how), *CELL, "dn", "top")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows(joins.attach(px, stats, ["scene_id"], how), *CELL, "dn", "top") == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_join_in_blocks_equals_join(spark):
    data = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 40).alias("k"), (F.col("id") % 9).alias("b"), "id")
    table = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    for how in ("inner", "left"):
        want = rows(data.join(table, "k", how), "k", "id", "x")
        assert rows(joins.join_in_blocks(data, table, ["b"], ["k"], how), "k", "id", "x") == want


@pytest.mark.parametrize("n", [1, 7, 500, 5000])
def test_top_n_ranks_whole_groups(spark, n):
    data = spark.range(4000).select((F.col("id") % 3 == 0).alias("g"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("h"), "id")
    order = [F.col("h"), F.col("id")]
    got = {(r["g"], r["rn"]): r["id"] for r in joins.top_n(data, ["g"], order, n, F.shiftright("h", 3)).collect()}
    want = {}
    for g in (True, False):
        own = sorted((r["h"], r["id"]) for r in data.where(F.col("g") == g).collect())
        want |= {(g, i + 1): x for i, (_, x) in enumerate(own[:n])}
    assert got == want


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_over_one_hot_key(spark, inclusive):
    """A third of all rows under one key, and a NULL key; partitions cut keys."""
    rnd = random.Random(6)
    data = [
        (0 if i < 400 else None if i % 50 == 9 else i % 50, i, rnd.randrange(900), None if rnd.random() < 0.2 else rnd.randrange(100))
        for i in range(1200)
    ]
    df = spark.createDataFrame(data, "k int, id int, day int, v int").withColumn(
        "ts", F.expr("timestampadd(DAY, day, TIMESTAMP '2001-03-04 05:06:07')")
    )
    out = running(
        df, ["k"], ["ts", "id"], {"latest": F.col("v")}, {"total": F.col("v")}, inclusive
    )
    got = {r["id"]: (r["latest"], r["total"]) for r in out.collect()}
    want, last, total = {}, {}, {}
    for k, i, day, v in sorted(data, key=lambda x: (x[0] is None, x[0] or 0, x[2], x[1])):
        total[k] = total.get(k, 0) + (v or 0)
        before, last[k] = last.get(k), v if v is not None else last.get(k)
        want[i] = (last[k] if inclusive else before, total[k])
    assert got == want


def test_asof_keeps_requests_without_scene(spark):
    scenes = spark.sql("SELECT 1 AS zone_id, TIMESTAMP '2024-01-05 00:00:00' AS ts, 100L AS event_id")
    asks = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '2024-01-04 00:00:00', 1L), (1, TIMESTAMP '2024-01-05 00:00:00', 2L), "
        "(1, TIMESTAMP '2024-03-01 00:00:00', 3L), (2, TIMESTAMP '2024-03-01 00:00:00', 4L) AS t(zone_id, ts, event_id)"
    )
    out = {r["event_id"]: r["scene_event"] for r in change.asof_scene(asks, scenes).collect()}
    assert out == {1: None, 2: 100, 3: 100, 4: None}


def test_matching_to_itself_is_identity(spark):
    px = tables.pixels(spark, SF_DIR).select(*CELL, "dn").filter("scene_id = 0")
    assert rows(radiometry.hist_match(px, 0), *CELL, "dn") == rows(px, *CELL, "dn")


def test_sample_is_exact_and_repeatable(spark):
    px = tables.pixels(spark, SF_DIR)
    one = accuracy.stratified_sample(px, 37)
    assert {r["truth"]: r["count"] for r in one.groupBy("truth").count().collect()} == {0: 37, 1: 37}
    assert rows(one, *CELL) == rows(accuracy.stratified_sample(px.repartition(5), 37), *CELL)
    assert accuracy.stratified_sample(px.filter("r < 2"), 10_000).count() == px.filter("r < 2").count()


def test_confusion_adds_up(spark):
    px = threshold.threshold_fixed(tables.pixels(spark, SF_DIR), 128)
    assert accuracy.confusion_matrix(px).agg(F.sum("n")).first()[0] == px.count()


def test_split_keeps_blocks_whole(spark):
    px = accuracy.block_split(tables.pixels(spark, SF_DIR), 16)
    blocks = px.groupBy("scene_id", F.expr("r div 16"), F.expr("c div 16")).agg(F.countDistinct("part").alias("n"))
    assert blocks.filter("n > 1").count() == 0
    assert px.select("part").distinct().count() == 2


def test_user_model_and_map_with_nulls(grid, picture):
    px = grid(noise(8, 6, 7))
    made = tiles.pixels_to_tiles(px, 4)
    out = extend.tile_map(made, lambda image: image + 1)
    assert rows(tiles.tiles_to_pixels(out, 4), *CELL, "dn") == rows(px.withColumn("dn", F.col("dn") + 1), *CELL, "dn")
