"""Balanced strips against a dense solver, planted gains, and cases without seams."""

import random

import numpy as np
import pytest

from silvagrid.operators import balance


def observations(spark, rows):
    return spark.createDataFrame(rows, "r int, c int, strip int, dn int")


def dense(rows, ridge=balance.RIDGE):
    """The same least squares with every cell of every pair of strips as an equation."""
    cells = {}
    for r, c, s, v in rows:
        if v is not None and s is not None:
            cells.setdefault((r, c), {}).setdefault(s, []).append(v)
    cells = {k: {s: sum(v) / len(v) for s, v in x.items()} for k, x in cells.items()}
    strips = sorted({s for x in cells.values() if len(x) > 1 for s in x})
    at = {s: 2 * i for i, s in enumerate(strips)}
    a, b = np.zeros((2 * len(strips),) * 2), np.zeros(2 * len(strips))
    for x in cells.values():
        for i, u in x.items():
            for j, v in x.items():
                if i < j:
                    row = np.zeros(2 * len(strips))
                    row[at[i] : at[i] + 2], row[at[j] : at[j] + 2] = (u, 1), (-v, -1)
                    a += np.outer(row, row)
                if i != j:
                    a[at[i], at[i]] += ridge * u * u
                    b[at[i]] += ridge * u * u
                    a[at[i] + 1, at[i] + 1] += ridge
    x = np.linalg.solve(a, b) if strips else b
    return {s: (x[i], x[i + 1]) for s, i in at.items()}


def chain(strips=9, seed=3):
    """A ring of strips, each overlapping the next two, of one ground."""
    rnd = random.Random(seed)
    rows = []
    for c in range(strips * 6):
        for r in range(5):
            level = rnd.randrange(20, 200)
            for s in range(strips):
                if (c - 6 * s) % (strips * 6) < 15:
                    v = round(level * (1 + 0.05 * (s % 4)) + 2 * s)
                    rows += [(r, c, s, None if rnd.random() < 0.1 else v)] * (1 + (r == 2))
    return rows


@pytest.mark.parametrize("ridge", [0.01, 0.2])
def test_equals_dense_solution(spark, ridge):
    rows = chain()
    got = {r["strip"]: r for r in balance.seam_balance(observations(spark, rows), ridge).collect()}
    want = dense(rows, ridge)
    assert set(got) == set(want)
    for s, (g, o) in want.items():
        assert abs(got[s]["gain"] - g) < 1e-6 and abs(got[s]["offset"] - o) < 1e-4 and got[s]["residual"] < 1e-6
    seams = {}
    cells = {}
    for r, c, s, v in rows:
        if v is not None:
            cells.setdefault((r, c), set()).add(s)
    for x in cells.values():
        for i in x:
            for j in x - {i}:
                seams.setdefault(i, []).append(j)
    assert {s: (r["n_cells"], r["n_seams"]) for s, r in got.items()} == {s: (len(x), len(set(x))) for s, x in seams.items()}


def test_seams_agree_afterwards(spark):
    rows = [x for x in chain() if x[3] is not None]
    obs = observations(spark, rows)
    done = balance.balance(obs, balance.seam_balance(obs)).collect()

    def spread(all_):
        cells = {}
        for r, c, s, v in all_:
            cells.setdefault((r, c), []).append(v)
        return sum(max(v) - min(v) for v in cells.values()) / len(cells)

    assert spread([tuple(r) for r in done]) < 0.2 * spread(rows)


def test_no_seams_zeros_and_nodata(spark):
    apart = [(0, 0, 1, 10), (0, 1, 2, 20), (0, 2, 3, None), (0, 2, 4, 5), (0, 0, None, 7)]
    obs = observations(spark, apart)
    solved = balance.seam_balance(obs)
    assert solved.count() == 0
    assert sorted(map(tuple, balance.balance(obs, solved).collect()), key=str) == sorted(apart, key=str)
    assert balance.seam_balance(obs.limit(0)).count() == 0
    zeros = [(0, c, s, 0 if s == 1 else 30) for c in range(4) for s in (1, 2)]
    got = {r["strip"]: r for r in balance.seam_balance(observations(spark, zeros)).collect()}
    assert got[1]["gain"] == pytest.approx(1) and got[1]["residual"] < 1e-6


def test_levels_stay_in_range(spark):
    strips = spark.createDataFrame([(1, 2.0, 10.0), (2, 1.0, -50.0)], "strip int, gain double, offset double")
    obs = observations(spark, [(0, 0, 1, 200), (0, 1, 2, 20), (0, 2, 1, None), (0, 3, 9, 7), (0, 4, 1, 7)])
    got = {r["c"]: r["dn"] for r in balance.balance(obs, strips).collect()}
    assert got == {0: 255, 1: 0, 2: None, 3: 7, 4: 24}
