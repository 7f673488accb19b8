"""Regions as polygons: closed rings of corners, and cells from rings again.

A side of border lies between a forest cell and one that is not, directed so that the forest is on its right. What side
follows is told by the two cells ahead: where cells touch by a corner only, the ring goes on around the other cell with 8
neighbours, a turn to the left, and around its own with 4. Each block follows its own sides, which gives rings
and chains of rings that leave it. Which chains make a ring, and in what order, is list ranking: every
chain's pointer is doubled until it has seen its whole ring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators.regions import connected_components
from silvagrid.plans.blocks import BLOCK, BLOCK_KEY, to_blocks
from silvagrid.plans.staging import stage

#: A side is named by the corner it starts at and its way (0 to 3: east, south, west, north).
_KEY = ["scene_id", "id"]


def _block_tracer(connectivity: int, block: int):
    """Function that follows the border of the forest inside one block; self-contained for the workers.

    Gives rows of two kinds. A corner (``n`` is NULL) belongs to a chain, the stretch of border that lies in the block,
    named by its first side; ``at`` is its place there. A chain (``n`` corners) tells what chain it goes on to, its
    lowest corner and where that and its first corner lie. A ring inside the block is complete: its ``ring`` is set.
    """
    none = (1 << 63) - 1

    def trace(cells):
        import numpy as np
        import pyarrow as pa

        scene, br, bc = (cells.column(x)[0].as_py() for x in ("scene_id", "_br", "_bc"))
        r, c, region = (cells.column(x).to_numpy() for x in ("r", "c", "region_id"))
        top, left = br * block - 1, bc * block - 1
        side = block + 2
        forest, name = np.zeros((side, side), bool), np.zeros((side, side), np.int64)
        forest[r - top, c - left] = True
        name[r - top, c - left] = region
        y, x = np.nonzero(forest[1:-1, 1:-1])
        y, x = y + 1, x + 1
        # one step along each way, and one to its left, where no forest is; the corner a side starts at
        step, start = [(0, 1), (1, 0), (0, -1), (-1, 0)], [(0, 0), (0, 1), (1, 1), (1, 0)]
        ys, xs, ways, turned, nexts = [], [], [], [], []
        for way in range(4):
            (dy, dx), (ly, lx) = step[way], step[way - 1]
            bare = ~forest[y + ly, x + lx]
            ey, ex = y[bare], x[bare]
            ahead, beyond = forest[ey + dy, ex + dx], forest[ey + dy + ly, ex + dx + lx]
            to_left = beyond if connectivity == 8 else beyond & ahead
            straight = ahead & ~beyond
            ny = ey + np.where(to_left, dy + ly, np.where(straight, dy, 0))
            nx = ex + np.where(to_left, dx + lx, np.where(straight, dx, 0))
            nway = np.where(to_left, (way - 1) % 4, np.where(straight, way, (way + 1) % 4))
            ys.append(ey)
            xs.append(ex)
            ways.append(np.full(len(ey), way))
            turned.append(~(forest[ey - dy, ex - dx] & ~forest[ey - dy + ly, ex - dx + lx]))
            nexts.append(np.stack([ny, nx, nway]))
        ys, xs, ways, turned = map(np.concatenate, (ys, xs, ways, turned))
        ny, nx, nway = np.concatenate(nexts, axis=1)
        first = np.array(start)

        def names(y, x, way):
            cy, cx = y + top + first[way, 0], x + left + first[way, 1]
            return (((cy << 32) + cx) << 2) + way

        n = len(ys)
        number = np.full((4, side, side), -1)
        number[ways, ys, xs] = np.arange(n)
        key, onward = names(ys, xs, ways), names(ny, nx, nway)
        inner = (ny > 0) & (ny < side - 1) & (nx > 0) & (nx < side - 1)
        follower = np.where(inner, number[nway, ny, nx], -1)
        before = np.full(n, -1)
        before[follower[follower >= 0]] = np.flatnonzero(follower >= 0)
        # sides of closed rings never run out of sides before them
        low, jump = np.where(turned, key, none), before.copy()
        while True:
            k = np.flatnonzero(jump >= 0)
            less = np.minimum(low[k], low[jump[k]])
            onto = jump[jump[k]]
            done = (less == low[k]).all() and (onto >= 0).all()
            low[k], jump[k] = less, onto
            if done:
                break
        closed = jump >= 0
        jump = np.where(closed & (low == key), -1, before)
        head, place = np.arange(n), (jump >= 0).astype(np.int64)
        while (jump >= 0).any():
            k = np.flatnonzero(jump >= 0)
            on = jump[k]
            head[k] = head[on]
            place[k], jump[k] = place[k] + place[on], jump[on]

        along = np.lexsort((place, head))
        begin = np.flatnonzero(place[along] == 0)
        chain = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, n)))
        id_, open_ = key[head[along]], ~closed[along]
        last = along[np.append(begin, n)[1:] - 1] if n else along
        corner = np.flatnonzero(turned[along])
        owner = chain[corner]
        size = np.bincount(owner, minlength=len(begin))
        ahead_of = np.cumsum(size) - size
        at = np.arange(len(corner)) - ahead_of[owner]
        e = along[corner]
        cy, cx = ys[e] + top + first[ways[e], 0], xs[e] + left + first[ways[e], 1]
        final = at == size[owner] - 1
        to = np.where(final, ahead_of[owner], np.arange(len(corner)) + 1)
        ends = final & open_[corner]
        # per chain: its lowest corner, its first one
        lowest = np.full(len(begin), none)
        np.minimum.at(lowest, owner, key[e])
        low_at = np.zeros(len(begin), np.int64)
        hit = key[e] == lowest[owner]
        low_at[owner[hit]] = at[hit]
        through = np.flatnonzero(open_[begin])
        bare_ = size[through] == 0
        head_corner = ahead_of[through][~bare_]
        fy, fx = np.zeros(len(through), np.int64), np.zeros(len(through), np.int64)
        fy[~bare_], fx[~bare_] = cy[head_corner], cx[head_corner]
        m, p = len(corner), len(through)
        unset, kept = (np.ones(m, bool), np.ones(p, bool)), (np.zeros(m, bool), np.zeros(p, bool))

        def column(a, b, kind, a_null=kept[0], b_null=kept[1]):
            return pa.array(np.concatenate([a, b]).astype(kind), mask=np.concatenate([a_null, b_null]))

        zero_m, zero_p = np.zeros(m, np.int64), np.zeros(p, np.int64)
        return pa.table({
            "scene_id": pa.array(np.full(m + p, scene, np.int32)),
            "region_id": column(name[ys[e], xs[e]], zero_p, np.int64, b_null=unset[1]),
            "chain": column(id_[corner], id_[begin][through], np.int64),
            "at": column(at, low_at[through], np.int64),
            "y": column(cy, fy, np.int32, b_null=bare_),
            "x": column(cx, fx, np.int32, b_null=bare_),
            "y1": column(cy[to], zero_p, np.int32, ends, unset[1]),
            "x1": column(cx[to], zero_p, np.int32, ends, unset[1]),
            "ring": column(id_[corner], zero_p, np.int64, open_[corner], unset[1]),
            "next": column(zero_m, onward[last][through], np.int64, unset[0]),
            "n": column(zero_m, size[through], np.int64, unset[0]),
            "low": column(zero_m, lowest[through], np.int64, unset[0]),
        })

    return trace


_TRACED = "scene_id int, region_id long, chain long, at long, y int, x int, y1 int, x1 int, ring long, next long, n long, low long"


def _doubled(state: DataFrame, *carried: str) -> DataFrame:
    """Each row with what its ``next`` holds, as ``_next`` and ``_<name>``."""
    there = state.select("scene_id", F.col("id").alias("next"), F.col("next").alias("_next"), *[F.col(x).alias(f"_{x}") for x in carried])
    return state.join(there, ["scene_id", "next"], "left")


def _leaders(chains: DataFrame) -> DataFrame:
    """``scene_id, id, ring, y, x``: the lowest corner of each chain's ring, and the first corner from the chain's begin on.

    Seen over 1, 2, 4, ... followers until nothing changes. Stretches of equal length cover a ring one after the other; if
    none of them sees a lower corner in the next one, all have seen the ring's lowest.
    """
    state = chains.select(*_KEY, "next", F.col("low").alias("ring"), "y", "x")
    while True:
        seen = _doubled(state, "ring", "y", "x")
        new = stage(seen.select(
            *_KEY, F.col("_next").alias("next"), F.least("ring", "_ring").alias("ring"), F.coalesce("y", "_y").alias("y"), F.coalesce("x", "_x").alias("x"),
            (F.col("_ring") < F.col("ring")).alias("fell"),
        ), "leaders")
        state = new.drop("fell")
        if new.where("fell").isEmpty():
            return state.drop("next")


def _places(chains: DataFrame, leaders: DataFrame) -> DataFrame:
    """``scene_id, id, ring, left``: how many corners there are from a chain's begin to the ring's end, which is before
    the chain with its lowest corner."""
    named = chains.join(leaders.select(*_KEY, "ring"), _KEY)
    first = chains.join(leaders.select(*_KEY, "ring"), _KEY).where("low = ring").select("scene_id", F.col("id").alias("next"), F.lit(True).alias("_first"))
    cut = named.join(first, ["scene_id", "next"], "left")
    state = stage(cut.select(*_KEY, "ring", F.when(F.col("_first").isNull(), F.col("next")).alias("next"), F.col("n").alias("left")), "places")
    while not state.where("next is not null").isEmpty():
        ahead = _doubled(state, "left")
        state = stage(ahead.select(*_KEY, "ring", F.col("_next").alias("next"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left")), "places")
    return state.drop("next")


def trace_rings(mask: DataFrame, connectivity: int = 8, block: int = BLOCK) -> DataFrame:
    """Corners of all rings in order: ``scene_id, region_id, ring, pos, y, x, y1, x1``.

    Cells of class 1 are forest; cell ``(r, c)`` is the square from corner ``(r, c)`` to ``(r + 1, c + 1)``. A row is a
    corner ``(y, x)`` and the corner the ring goes on to; ``pos`` counts from 0 at the ring's first corner in row-major
    order. Outer rings run clockwise (rows count downwards), holes the other way round. NULL and absent cells are not forest.

    Borders are followed inside blocks, after one exchange of cells; rings in one block are complete then. Of the others
    each block has chains, of which only one row each is ranked. Rounds grow with the logarithm of the most chains of a
    ring; each is a join of chains on a unique key.
    """
    cells = connected_components(mask.select(*CELL, "cls"), connectivity, block)
    blocks = to_blocks(cells, 1, block, gaps=False).groupBy(*BLOCK_KEY)
    traced = stage(blocks.applyInArrow(_block_tracer(connectivity, block), _TRACED), "traced")
    chains = traced.where("n is not null").select("scene_id", F.col("chain").alias("id"), "next", "n", "low", "at", "y", "x")
    leaders = _leaders(chains)
    placed = stage(_places(chains, leaders).join(chains.select(*_KEY, "next", "low", "at"), _KEY), "placed")
    start = placed.where("low = ring").select("scene_id", "ring", F.col("left").alias("_all"), F.col("at").alias("_from"))
    after = leaders.select("scene_id", F.col("id").alias("next"), F.col("y").alias("_y"), F.col("x").alias("_x"))
    ranked = placed.join(start, ["scene_id", "ring"]).join(after, ["scene_id", "next"]).select(
        "scene_id", F.col("id").alias("chain"), F.col("ring").alias("_ring"), (F.col("_all") - F.col("left") - F.col("_from")).alias("_before"), "_all", "_y", "_x"
    )
    corners = traced.where("n is null").join(ranked, ["scene_id", "chain"], "left")
    return corners.select(
        "scene_id", "region_id", F.shiftright(F.coalesce("ring", "_ring"), 2).alias("ring"),
        F.when(F.col("ring").isNull(), F.pmod(F.col("at") + F.col("_before"), "_all")).otherwise(F.col("at")).alias("pos"),
        "y", "x", F.coalesce("y1", "_y").alias("y1"), F.coalesce("x1", "_x").alias("x1"),
    )




def ring_stats(rings: DataFrame) -> DataFrame:
    """Per ring: ``scene_id, region_id, ring, n_corners, length, area``; the area of a hole is negative."""
    y, x, y1, x1 = (F.col(n).cast("long") for n in ("y", "x", "y1", "x1"))
    return rings.groupBy("scene_id", "region_id", "ring").agg(
        F.count("*").alias("n_corners"), F.sum(F.abs(y1 - y) + F.abs(x1 - x)).alias("length"), F.sum(x * (y1 - y)).alias("area")
    )


def fill_rings(rings: DataFrame) -> DataFrame:
    """The cells inside rings: ``scene_id, region_id, r, c``.

    In each row of cells, borders that run north or south are crossed in and out in turn. A window group
    is one region's row.
    """
    steep = rings.where("y <> y1")
    rows = F.sequence(F.least("y", "y1"), F.greatest("y", "y1") - 1)
    crossed = steep.select("scene_id", "region_id", "x", F.explode(rows).alias("r"))
    line = Window.partitionBy("scene_id", "region_id", "r").orderBy("x")
    paired = crossed.select("*", F.lead("x").over(line).alias("_to"), (F.row_number().over(line) % 2).alias("_in")).where("_in = 1")
    return paired.select("scene_id", "region_id", "r", F.explode(F.sequence("x", F.col("_to") - 1)).alias("c"))
