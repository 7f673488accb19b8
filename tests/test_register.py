"""Planted shifts of pictures with nodata, edge tiles and scenes of other size."""

import random

import pytest

from silvagrid.operators import register
from silvagrid.sources import tiles

SIZE = 16


def texture(h, w, seed):
    rnd = random.Random(seed)
    return {(r, c): rnd.randrange(256) for r in range(h) for c in range(w)}


def scene(spark, number, cells):
    return spark.createDataFrame([(number, r, c, v) for (r, c), v in cells.items()], "scene_id int, r int, c int, dn int")


@pytest.fixture(scope="module")
def scenes(spark):
    ground = texture(61, 50, 1)
    out = scene(spark, 0, ground)
    planted = {}
    for k, (dr, dc) in enumerate([(0, 0), (5, -5), (-3, 4), (1, 0)], 1):
        cells = {(r + dr, c + dc): None if (r * c) % 7 == 0 else 10 + v // 2 for (r, c), v in ground.items() if r + dr >= 0 and c + dc >= 0}
        if k == 2:  # a smaller scene, a larger one
            cells = {(r, c): v for (r, c), v in cells.items() if r < 40 and c < 35}
        if k == 3:
            cells |= {(r, c): 7 for r in range(58, 90) for c in range(54, 80)}
        out = out.union(scene(spark, k, cells))
        planted[k] = (dr, dc)
    out = out.union(scene(spark, 8, {k: 9 for k in ground})).union(scene(spark, 9, {k: None for k in ground}))
    return out, planted


def test_planted_shifts(spark, scenes):
    px, planted = scenes
    asked = [(0, k) for k in planted] + [(k, 0) for k in planted] + [(0, 8), (8, 0), (0, 9), (9, 0), (0, 77), (77, 0), (None, 0), (0, None), (0, 1)]
    pairs = spark.createDataFrame(asked, "scene_a int, scene_b int")
    got = {(r["scene_a"], r["scene_b"]): r for r in register.register_shift(tiles.pixels_to_tiles(px, SIZE), pairs, 5, SIZE).collect()}
    assert len(got) == len({p for p in asked if None not in p})
    for k, (dr, dc) in planted.items():
        assert (got[0, k]["dr"], got[0, k]["dc"]) == (dr, dc) and (got[k, 0]["dr"], got[k, 0]["dc"]) == (-dr, -dc)
        assert got[0, k]["votes"] >= max(2, 0.8 * got[0, k]["n_tiles"])  # a sliver at the edge may err
    for p in ((0, 8), (8, 0), (0, 9), (9, 0), (0, 77), (77, 0)):
        assert (got[p]["dr"], got[p]["dc"], got[p]["votes"], got[p]["n_tiles"]) == (None, None, 0, 0)


def test_tiles_equal_brute_force(spark, scenes):
    """Score and overlap of each tile from all cells at all shifts, edge tiles of both scenes included."""
    px, _ = scenes
    cells = {}
    for r in px.collect():
        cells.setdefault(r["scene_id"], {})[r["r"], r["c"]] = r["dn"]
    pairs = spark.createDataFrame([(0, 2), (2, 0), (3, 0), (0, 3)], "scene_a int, scene_b int")
    got = {tuple(r)[:4]: tuple(r)[4:] for r in register.tile_shifts(tiles.pixels_to_tiles(px, SIZE), pairs, 4, SIZE).collect()}
    want = {}
    for a, b in [(0, 2), (2, 0), (3, 0), (0, 3)]:
        by_tile = {}
        for (r, c), v in cells[a].items():
            if v is not None:
                by_tile.setdefault((r // SIZE, c // SIZE), []).append((r, c, v))
        for at, own in by_tile.items():
            tried = []
            for dr in range(-4, 5):
                for dc in range(-4, 5):
                    met = [(v, cells[b].get((r + dr, c + dc))) for r, c, v in own]
                    met = [(x, y) for x, y in met if y is not None]
                    n, sa, sb = len(met), sum(x for x, _ in met), sum(y for _, y in met)
                    va, vb = n * sum(x * x for x, _ in met) - sa * sa, n * sum(y * y for _, y in met) - sb * sb
                    if 2 * n >= len(own) and va > 0 and vb > 0:
                        score = (n * sum(x * y for x, y in met) - sa * sb) / (float(va) * float(vb)) ** 0.5
                        tried.append((-score, abs(dr) + abs(dc), dr, dc, n))
            if tried:
                score, _, dr, dc, n = min(tried)
                want[a, b, *at] = (dr, dc, -score, n)
    assert set(got) == set(want)
    for k, (dr, dc, score, n) in want.items():
        assert (got[k][0], got[k][1], got[k][3]) == (dr, dc, n) and abs(got[k][2] - score) < 1e-12


def test_align_moves_scenes_back(spark, scenes):
    px, planted = scenes
    pairs = spark.createDataFrame([(0, k) for k in (*planted, 9)], "scene_a int, scene_b int")
    shifts = register.register_shift(tiles.pixels_to_tiles(px, SIZE), pairs, 5, SIZE)
    out = register.align(px, shifts)
    assert out.columns == px.columns and out.count() == px.count()
    ground = {(r["r"], r["c"]): r["dn"] for r in out.where("scene_id = 0").collect()}
    for k in (1, 2, 4):
        for r in out.where(f"scene_id = {k} and dn is not null").collect():
            assert r["dn"] == 10 + ground[r["r"], r["c"]] // 2


def test_empty_tables_and_bad_reach(spark, scenes):
    px, _ = scenes
    all_tiles = tiles.pixels_to_tiles(px, SIZE)
    pairs = spark.createDataFrame([(0, 1)], "scene_a int, scene_b int")
    assert register.register_shift(all_tiles, pairs.limit(0), 3, SIZE).count() == 0
    assert [r["votes"] for r in register.register_shift(all_tiles.limit(0), pairs, 3, SIZE).collect()] == [0]
    for reach in (0, SIZE + 1):
        with pytest.raises(ValueError):
            register.tile_shifts(all_tiles, pairs, reach, SIZE)
