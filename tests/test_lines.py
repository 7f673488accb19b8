"""Distances, boxes and look-ups of any size by brute force."""

import random

import pytest

from silvagrid.operators import distance, lines, radiometry, zonal
from tests.test_forms import noise


def cells_of(df, *names):
    return {(r["scene_id"], r["r"], r["c"]): tuple(r[n] for n in names) for r in df.collect()}


def classes(share, h, w, seed):
    rnd = random.Random(seed)
    return [[None if rnd.random() < 0.1 else int(rnd.random() < share) for _ in range(w)] for _ in range(h)]


def test_distance_equals_brute_force(grid):
    pictures = [
        classes(0.02, 31, 23, 1), classes(0.5, 12, 17, 2), classes(0.98, 9, 40, 3), [[1] * 6] * 4, [[None] * 5] * 3, [[0, 1]], [[1], [None], [None], [0]],
        [[0] * 50 + [1]], [[1] + [0] * 20] + [[0] * 21 for _ in range(19)],
    ]
    got = cells_of(distance.distance_transform(grid(*pictures, value="cls")), "cls", "d2")
    want = {}
    for s, p in enumerate(pictures):
        at = [(r, c, v) for r, line in enumerate(p) for c, v in enumerate(line)]
        for r, c, v in at:
            others = [(r - y) ** 2 + (c - x) ** 2 for y, x, u in at if v is not None and u == 1 - v]
            want[s, r, c] = (v, min(others, default=None))
    assert got == want


def test_distance_of_scenes_that_begin_anywhere(grid):
    p = classes(0.1, 15, 22, 6)
    want = cells_of(distance.distance_transform(grid(p, value="cls")), "d2")
    moved = grid(p, value="cls").selectExpr("scene_id", "r - 40 as r", "c - 9 as c", "cls")
    assert {(s, r + 40, c + 9): v for (s, r, c), v in cells_of(distance.distance_transform(moved), "d2").items()} == want


@pytest.mark.parametrize("radius", [0, 1, 7, 300])
def test_boxes_equal_brute_force(grid, radius):
    p = noise(4, 14, 19, nulls=0.4)
    got = cells_of(lines.box_mean(grid(p), radius), "b_sum", "b_n", "b_mean")
    for r in range(14):
        for c in range(19):
            v = [p[y][x] for y in range(14) for x in range(19) if abs(y - r) <= radius and abs(x - c) <= radius and p[y][x] is not None]
            assert got[0, r, c] == (sum(v), len(v), sum(v) / len(v) if v else None)
    with pytest.raises(ValueError):
        lines.box_mean(grid(p), -1)


def test_integral_image(grid):
    p = noise(5, 9, 11, nulls=0.3)
    got = cells_of(lines.summed_area(grid(p)), "total", "n")
    for r in range(9):
        for c in range(11):
            v = [p[y][x] for y in range(r + 1) for x in range(c + 1) if p[y][x] is not None]
            assert got[0, r, c] == (sum(v), len(v))


def test_levels_far_apart(spark):
    levels = [0, 1, 255, 256, 70_000, 2_000_000_000, None, -2_000_000_000, 0, 70_000]
    px = spark.createDataFrame([(0, 0, c, v) for c, v in enumerate(levels)] + [(1, 0, c, c) for c in range(10)], "scene_id int, r int, c int, dn int")
    got = cells_of(radiometry.hist_equalize(px), "dn")
    known = sorted(v for v in levels if v is not None)
    first = known.count(known[0])
    for c, v in enumerate(levels):
        cum = sum(x <= v for x in known) if v is not None else 0
        assert got[0, 0, c] == (None if v is None else int((cum - first) / (len(known) - first) * 255 + 0.5),)
    matched = cells_of(radiometry.hist_match(px, 1), "dn")
    for c, v in enumerate(levels):
        share = sum(x <= v for x in known) / len(known) if v is not None else 0
        assert matched[0, 0, c] == (None if v is None else next(k for k in range(10) if (k + 1) / 10 >= share),)
        assert matched[1, 0, c] == (c,)


def test_totals_hold_unnamed_zones(spark):
    px = spark.createDataFrame([(0, 0, 0, 10, 1, 1), (0, 0, 1, 20, 0, 7), (1, 0, 2, None, None, 7), (1, 0, 3, 30, 1, None)], "scene_id int, r int, c int, dn int, cls int, zone_id int")
    zones = spark.createDataFrame([(1, "one", "north")], "zone_id int, zone string, region string")
    rollup = {(r["region"], r["zone"], r["level"]): r["n_px"] for r in zonal.zonal_rollup(px, zones).collect()}
    assert rollup == {("north", "one", 0): 1, (None, None, 0): 2, ("north", None, 1): 1, (None, None, 1): 2, (None, None, 3): 3}
    cube = {(r["region"], r["scene_id"], r["level"]): r["n_px"] for r in zonal.zonal_cube(px, zones).collect()}
    assert cube[None, None, 3] == 3 and cube[None, None, 1] == 2 and cube[None, 0, 2] == 2 and cube[None, 1, 0] == 1
