"""Rings of hand-made pictures, and cells that come back from rings of noise."""

import pytest

from silvagrid.operators import regions, rings
from tests.test_forms import noise, spiral
from tests.test_grids import CORNERS, RING


def traced(df):
    """Corners per ring in order; each goes on to the next and the last to the first."""
    out = {}
    for r in df.collect():
        out.setdefault((r["scene_id"], r["region_id"], r["ring"]), {})[r["pos"]] = (r["y"], r["x"], r["y1"], r["x1"])
    for ring in out.values():
        assert set(ring) == set(range(len(ring)))
        for k, (_, _, y1, x1) in ring.items():
            assert ring[(k + 1) % len(ring)][:2] == (y1, x1)
    return {k: [ring[i][:2] for i in range(len(ring))] for k, ring in out.items()}


def key(r, c):
    return (r << 32) + c


def test_ring_with_a_hole(grid):
    got = traced(rings.trace_rings(grid(RING, value="cls")))
    assert got == {
        (0, key(1, 1), key(1, 1)): [(1, 1), (1, 4), (4, 4), (4, 1)],
        (0, key(1, 1), key(2, 2)): [(2, 2), (3, 2), (3, 3), (2, 3)],
    }
    stats = {r["ring"]: (r["n_corners"], r["length"], r["area"]) for r in rings.ring_stats(rings.trace_rings(grid(RING, value="cls"))).collect()}
    assert stats == {key(1, 1): (4, 12, 9), key(2, 2): (4, 4, -1)}


@pytest.mark.parametrize("connectivity,rings_", [(8, 1), (4, 2)])
def test_cells_that_touch_by_a_corner(grid, connectivity, rings_):
    for picture in (CORNERS, [line[::-1] for line in CORNERS]):
        got = traced(rings.trace_rings(grid(picture, value="cls"), connectivity))
        assert len(got) == rings_ and sum(map(len, got.values())) == 8


@pytest.mark.parametrize("connectivity", [4, 8])
def test_cells_come_back(grid, connectivity):
    pictures = [[[None if x is None else int(x < 130) for x in line] for line in noise(8, 15, 18)], spiral(13), [[1] * 6] * 3, [[0] * 4] * 3, [[None, 1], [1, None]]]
    mask = grid(*pictures, value="cls")
    back = rings.fill_rings(rings.trace_rings(mask, connectivity, 8))
    names = ["scene_id", "r", "c", "region_id"]
    want = sorted(tuple(r) for r in regions.connected_components(mask, connectivity).select(*names).collect())
    assert sorted(tuple(r) for r in back.select(*names).collect()) == want
    traced(rings.trace_rings(mask, connectivity, 8))


def test_nothing(grid):
    empty = grid([[0, None]], value="cls")
    assert rings.trace_rings(empty).count() == 0 and rings.fill_rings(rings.trace_rings(empty)).count() == 0


def test_only_chains_are_ranked(spark, grid, tmp_path, monkeypatch):
    """Rings inside one block are complete before any round."""
    ranked = []
    monkeypatch.setattr(rings, "_leaders", lambda chains, given=rings._leaders: ranked.append(chains.count()) or given(chains))
    for block, chains in ((8, 0), (2, 12)):
        assert rings.ring_stats(rings.trace_rings(grid(RING, value="cls"), 8, block)).count() == 2
        assert (ranked[-1] == 0) == (chains == 0)
