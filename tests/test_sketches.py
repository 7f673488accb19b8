"""Sketches merged upwards stay within their error bounds."""

import random

import pytest

from silvagrid.operators import sketches


@pytest.fixture(scope="module")
def scene(spark):
    rnd = random.Random(3)
    cells = [(0, r - 20, c, rnd.randrange(3000) if r % 9 else None) for r in range(64) for c in range(64)]
    cells += [(1, r, c, None) for r in range(4) for c in range(4)] + [(2, 0, 0, 7)]
    return cells, spark.createDataFrame(cells, "scene_id int, r int, c int, dn int")


def test_counts_are_exact_and_estimates_near(scene):
    cells, px = scene
    tiles = sketches.tile_sketches(px, 8)
    got = {r["scene_id"]: r for r in sketches.sketch_values(sketches.merge_scenes(sketches.merge_tiles(tiles, 4)), (0.1, 0.5, 0.9)).collect()}
    valid = sorted(v for s, _, _, v in cells if s == 0 and v is not None)
    assert got[0]["n_px"] == len(valid)
    assert abs(got[0]["n_levels"] - len(set(valid))) <= 0.05 * len(set(valid))
    for i, share in enumerate((0.1, 0.5, 0.9)):
        q = got[0][f"q{i}"]
        assert sum(v < q for v in valid) / len(valid) - 0.03 <= share <= sum(v <= q for v in valid) / len(valid) + 0.03
    assert (got[1]["n_px"], got[1]["n_levels"], got[1]["q0"]) == (0, 0, None)
    assert (got[2]["n_px"], got[2]["n_levels"], got[2]["q1"]) == (1, 1, 7)


def test_levels_of_tiles(scene):
    cells, px = scene
    tiles = sketches.tile_sketches(px, 8)
    for df, side in ((tiles, 8), (sketches.merge_tiles(tiles, 2), 16), (sketches.merge_tiles(tiles, 1), 8)):
        want = {}
        for s, r, c, v in cells:
            want.setdefault((s, r // side, c // side), []).append(v)
        got = {(r["scene_id"], r["tile_r"], r["tile_c"]): r["n_px"] for r in df.collect()}
        assert got == {k: sum(v is not None for v in x) for k, x in want.items()}
    with pytest.raises(ValueError):
        sketches.merge_tiles(tiles, 0)
    assert sketches.merge_scenes(tiles.limit(0)).count() == 0
