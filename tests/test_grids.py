"""Small pictures with answers worked by hand."""

import pytest

from silvagrid.operators import focal, geometry, morphology, mosaic, radiometry, regions, texture, threshold, zonal
from silvagrid.plans.forest import forest_extract
from silvagrid.sources import catalogue, tiles

ONES = [[1] * 5 for _ in range(5)]
ZEROS = [[0] * 5 for _ in range(5)]
RING = [[0, 0, 0, 0, 0], [0, 1, 1, 1, 0], [0, 1, 0, 1, 0], [0, 1, 1, 1, 0], [0, 0, 0, 0, 0]]
CORNERS = [[1, 1, 0, 0, 0], [1, 1, 0, 0, 0], [0, 0, 1, 1, 0], [0, 0, 1, 1, 0], [0, 0, 0, 0, 0]]
COUNT = [[r * 5 + c for c in range(5)] for r in range(5)]


def test_focal_corner_edge_middle(grid, picture):
    out = focal.focal_sum(grid(COUNT), 1)
    sums, n = picture(out, "f_sum"), picture(out, "f_n")
    assert (sums[0][0], n[0][0]) == (0 + 1 + 5 + 6, 4)
    assert (sums[0][2], n[0][2]) == (1 + 2 + 3 + 6 + 7 + 8, 6)
    assert (sums[2][2], n[2][2]) == (12 * 9, 9)


def test_focal_leaves_out_null(grid, picture):
    holed = [row[:] for row in COUNT]
    holed[2][2] = None
    out = focal.focal(grid(holed), 1, f_sum="sum", f_n="n", f_min="min", f_max="max")
    assert picture(out, "f_sum")[2][2] == 12 * 8
    assert picture(out, "f_n")[1][1] == 8
    assert picture(out, "f_max")[1][1] == 11
    assert picture(focal.focal_median(grid(holed), 1), "f_median")[2][2] == 11


def test_focal_all_null(grid, picture):
    out = focal.focal_mean(grid([[None, None], [None, None]]), 1)
    assert picture(out, "f_mean") == [[None, None], [None, None]]
    assert picture(focal.focal_median(grid([[None]]), 1), "f_median") == [[None]]


@pytest.mark.parametrize("shape", [[[3, 1, 2]], [[3], [1], [2]]])
def test_single_row_and_column(grid, picture, shape):
    flat = [x for line in picture(focal.focal_sum(grid(shape), 1), "f_sum") for x in line]
    assert flat == [4, 6, 3]
    flat = [x for line in picture(focal.focal_median(grid(shape), 1), "f_median") for x in line]
    assert flat == [1, 2, 1]


def test_median_even_count_takes_lower(grid, picture):
    assert picture(focal.focal_median(grid([[1, 4], [9, 2]]), 1), "f_median") == [[2, 2], [2, 2]]


def test_convolve(grid, picture):
    out = picture(focal.convolve(grid(COUNT), [[0, 1, 0], [1, -4, 1], [0, 1, 0]]), "f_conv")
    assert out[2][2] == 0
    assert out[0][0] == 1 + 5 - 0
    with pytest.raises(ValueError):
        focal.convolve(grid(COUNT), [[1, 1], [1, 1]])


def test_sobel_and_lbp(grid, picture):
    out = texture.sobel(grid(COUNT))
    assert picture(out, "gx")[2][2] == 8
    assert picture(out, "gy")[2][2] == 40
    assert picture(out, "g2")[0][0] is None
    codes = picture(texture.lbp(grid(COUNT)), "lbp")
    assert codes[2][2] == 8 + 16 + 32 + 64
    assert codes[4][4] == 0
    assert picture(texture.lbp(grid(ONES)), "lbp")[2][2] == 255


def test_morphology(grid, picture):
    mask = grid(ONES, RING, value="cls")
    assert picture(morphology.erode(mask), "cls") == ONES
    assert picture(morphology.erode(mask), "cls", 1) == ZEROS
    assert picture(morphology.dilate(mask), "cls", 1) == ONES
    assert picture(morphology.morph_close(mask), "cls", 1) == ONES
    assert picture(morphology.morph_open(mask), "cls", 1) == ZEROS
    assert morphology.boundary_pixels(mask).filter("scene_id = 0").count() == 0
    assert morphology.boundary_pixels(mask).filter("scene_id = 1").count() == 8


def test_morphology_null_stays_null(grid, picture):
    assert picture(morphology.dilate(grid([[1, None, 0]], value="cls")), "cls") == [[1, None, 0]]


def test_diagonal_regions(grid):
    mask = grid(CORNERS, value="cls")
    assert regions.connected_components(mask, 8).select("region_id").distinct().count() == 1
    four = {r["region_id"] for r in regions.connected_components(mask, 4).collect()}
    assert four == {0, (2 << 32) + 2}


@pytest.mark.parametrize("block", [2, 3, 256])
def test_regions_do_not_depend_on_blocks(grid, block):
    mask = grid(CORNERS, RING, ONES, ZEROS, value="cls")
    for connectivity, want in ((8, {(0, 1), (1, 1), (2, 1)}), (4, {(0, 2), (1, 1), (2, 1)})):
        labels = regions.connected_components(mask, connectivity, block).select("scene_id", "region_id").distinct()
        assert {(r["scene_id"], r["count"]) for r in labels.groupBy("scene_id").count().collect()} == want


def test_region_stats(grid):
    px = grid(COUNT).join(grid(CORNERS, value="cls"), ["scene_id", "r", "c"])
    one = regions.region_stats(px, 8, 2).collect()
    assert len(one) == 1
    row = one[0]
    assert (row["n_px"], row["r0"], row["r1"], row["c0"], row["c1"]) == (8, 0, 3, 0, 3)
    assert row["dn_mean"] == (0 + 1 + 5 + 6 + 12 + 13 + 17 + 18) / 8
    assert row["fill"] == 0.5


def test_sieve_and_holes(grid, picture):
    assert picture(regions.sieve(grid(CORNERS, value="cls"), 5, 8, 2), "cls") == CORNERS
    assert picture(regions.sieve(grid(CORNERS, value="cls"), 5, 4, 2), "cls") == ZEROS
    filled = [row[:] for row in RING]
    filled[2][2] = 1
    assert picture(regions.fill_holes(grid(RING, value="cls"), 4, 2), "cls") == filled
    assert picture(regions.sieve(grid([[1, None, 0]], value="cls"), 2), "cls") == [[0, None, 0]]


def test_hysteresis(grid):
    px = grid([[150, 200, 10, 150, 150]])
    out = regions.threshold_hysteresis(px, 140, 190, 8, 2).collect()
    assert sorted(r["c"] for r in out) == [0, 1]


def test_runs(grid):
    out = regions.mask_runs(grid([[1, 1, 0, 1]], value="cls")).collect()
    assert sorted((r["c0"], r["c1"], r["run_id"]) for r in out) == [(0, 1, 0), (3, 3, 3)]


def test_otsu(grid):
    px = grid([[10, 10, 11, 200, 201, 200]], [[7, 7, 7]], [[None, 5, 6]])
    assert {r["scene_id"]: r["threshold"] for r in threshold.otsu_levels(px).collect()} == {0: 11, 1: None, 2: 5}
    cls = threshold.threshold_otsu(px, "dark").collect()
    assert sum(r["cls"] for r in cls if r["scene_id"] == 0) == 3
    assert all(r["cls"] is None for r in cls if r["scene_id"] == 1)
    assert [r["cls"] for r in sorted(cls) if r["scene_id"] == 2] == [None, 1, 0]
    with pytest.raises(ValueError):
        threshold.threshold_fixed(px, 3, "blue")


def test_stretch(grid, picture):
    assert picture(radiometry.linear_stretch(grid([[10, 20, 30], [None, 15, 10]])), "dn") == [
        [0, 127, 255],
        [None, 63, 0],
    ]
    assert picture(radiometry.linear_stretch(grid([[9, 9]])), "dn") == [[0, 0]]
    assert picture(radiometry.hist_equalize(grid([[9, 9, None]])), "dn") == [[0, 0, None]]


def test_match_to_self_and_reference(grid, picture):
    px = grid([[1, 2, 3, 4]], [[10, 10, 20, 30]])
    assert picture(radiometry.hist_match(px, 0), "dn") == [[1, 2, 3, 4]]
    assert picture(radiometry.hist_match(px, 0), "dn", 1) == [[2, 2, 3, 4]]


def test_tiles_round_trip_and_holes(grid, picture):
    px = grid(COUNT)
    made = tiles.pixels_to_tiles(px, 2)
    sizes = {(r["tile_r"], r["tile_c"]): (r["h"], r["w"]) for r in made.collect()}
    assert sizes[(0, 0)] == (2, 2) and sizes[(2, 2)] == (1, 1) and sizes[(0, 2)] == (2, 1)
    assert picture(tiles.tiles_to_pixels(made, 2), "dn") == COUNT
    holed = tiles.pixels_to_tiles(px.filter("not (r = 0 and c = 1)"), 5).collect()[0]["dn"]
    assert holed[:3] == [0, None, 2] and len(holed) == 25


def test_densify(grid, picture):
    px = grid(COUNT).filter("r <> 2 or c <> 2")
    assert picture(catalogue.densify(px), "dn")[2] == [10, 11, None, 13, 14]


def test_downsample(grid, picture):
    out = geometry.downsample_mean(grid(COUNT), 2)
    assert picture(out, "dn_mean")[0][0] == 3.0 and picture(out, "n")[2][2] == 1
    assert picture(geometry.downsample_mode(grid([[1, 0], [0, 1]], value="cls"), 2), "cls") == [[0]]


def test_affine_fit_is_exact_without_noise(spark):
    points = [(0, float(r), float(c), 3.0 * c - r + 7, c + 4.0 * r - 2) for r in range(3) for c in range(4)]
    gcp = spark.createDataFrame(points, "scene_id int, r double, c double, x double, y double")
    fit = geometry.fit_gcp(gcp)
    row = fit.collect()[0]
    want = {"xc": 3, "xr": -1, "x0": 7, "yc": 1, "yr": 4, "y0": -2}
    assert all(row[k] == pytest.approx(v) for k, v in want.items())
    assert geometry.gcp_residuals(gcp, fit).collect()[0]["worst"] == pytest.approx(0, abs=1e-9)
    line = gcp.filter("r = 0")
    assert geometry.fit_gcp(line).collect()[0]["xc"] is None


def test_resample_identity(spark, grid, picture):
    same = spark.createDataFrame([(0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0)], "scene_id int, xc double, xr double, x0 double, yc double, yr double, y0 double")
    out = geometry.resample_nearest(grid(COUNT), same, 1.0).withColumnsRenamed({"i": "r", "j": "c"})
    assert picture(out, "dn") == COUNT


def test_square_and_hourglass_polygons(spark, grid):
    square = [(1, 1.0, 1.0, 4.0, 1.0), (1, 4.0, 1.0, 4.0, 3.0), (1, 4.0, 3.0, 1.0, 3.0), (1, 1.0, 3.0, 1.0, 1.0)]
    # a frame: outer and inner square of one zone, so the middle is outside
    frame = [
        (2, a, b, c, d)
        for lo, hi in ((0.0, 5.0), (2.0, 3.0))
        for a, b, c, d in ((lo, lo, hi, lo), (hi, lo, hi, hi), (hi, hi, lo, hi), (lo, hi, lo, lo))
    ]
    edges = spark.createDataFrame(square + frame, "zone_id int, x1 double, y1 double, x2 double, y2 double")
    hits = zonal.points_in_polygon(grid(COUNT), edges).collect()
    assert sorted((r["r"], r["c"]) for r in hits if r["zone_id"] == 1) == [(r, c) for r in (1, 2) for c in (1, 2, 3)]
    inside = {(r["r"], r["c"]) for r in hits if r["zone_id"] == 2}
    assert inside == {(r, c) for r in range(5) for c in range(5)} - {(2, 2)}


def test_composites(spark):
    rows = [
        (0, 0, 5, 1, 2, 1), (0, 0, 7, 3, 1, 2), (0, 0, 9, 3, 1, 3), (0, 0, 1, 9, 2, 4), (0, 1, None, 1, 1, 5),
    ]
    obs = spark.createDataFrame(rows, "r int, c int, dn int, acq_ts int, strip int, k int")
    assert mosaic.composite_latest(obs, ["k"]).filter("c = 0").collect()[0]["dn"] == 1
    first = mosaic.composite_priority(obs, ["k"]).filter("c = 0").collect()[0]
    assert (first["dn"], first["strip"]) == (9, 1)
    assert [(r["c"], r["dn"]) for r in mosaic.composite_median(obs).collect()] == [(0, 5)]
    bias = mosaic.seam_bias(obs).collect()
    assert [(r["s1"], r["s2"], r["n_pairs"], r["bias"]) for r in bias] == [(1, 2, 4, (7 + 9) / 2 - (5 + 1) / 2)]


def test_flagship_on_a_dark_square(grid, picture):
    size = 20
    px = [[20 if 5 <= r < 13 and 4 <= c < 15 else 200 for c in range(size)] for r in range(size)]
    px[17][17] = 20  # a speck: removed by opening or sieve
    px[0][0] = None
    out = picture(forest_extract(grid(px), block=8), "cls")
    assert out[0][0] is None
    assert out[9][9] == 1 and out[17][17] == 0 and out[2][2] == 0
    assert all(out[r][c] == 1 for r in range(6, 12) for c in range(5, 14))
