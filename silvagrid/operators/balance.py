"""Gain and offset per strip, so that strips agree where they overlap.

``seam_bias`` measures each seam by itself; strips corrected seam by seam do not close around a loop. Here all
seams are one least-squares problem in two unknowns per strip. Its matrix is as sparse as the seams are, so
it stays a table, and conjugate gradients need from it only products with a vector: a join and a sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import clamp
from silvagrid.plans.joins import attach
from silvagrid.plans.staging import stage

#: Weight of staying at gain 1 and offset 0 against the seams; without it all strips could fade to one level.
RIDGE = 0.01


def seam_sums(obs: DataFrame) -> DataFrame:
    """Per ordered pair of strips with common cells: ``i, j, n, si, sj, sii, sij`` over these cells.

    A strip's value on a cell is the mean of its observations. NULL observations do not count. A cell's strips are
    gathered (one entry each) and paired in place: only sums per pair leave a task.
    """
    part = obs.where("dn is not null and strip is not null").groupBy("r", "c", "strip").agg(F.avg("dn").alias("x"))
    cells = part.groupBy("r", "c").agg(F.sort_array(F.collect_list(F.struct("strip", "x"))).alias("x")).where(F.size("x") > 1)

    def with_others(a: Column) -> Column:
        others = F.filter("x", lambda b: b["strip"] != a["strip"])
        return F.transform(others, lambda b: F.struct(a["strip"].alias("i"), b["strip"].alias("j"), a["x"].alias("a"), b["x"].alias("b")))

    pairs = cells.select(F.explode(F.flatten(F.transform("x", with_others))).alias("p")).select("p.*")
    sums = {"si": F.col("a"), "sj": F.col("b"), "sii": F.col("a") * F.col("a"), "sij": F.col("a") * F.col("b")}
    return pairs.groupBy("i", "j").agg(F.count("*").alias("n"), *[F.sum(e).alias(k) for k, e in sums.items()])


def _pair(g: Column, o: Column) -> Column:
    return F.struct(g.alias("g"), o.alias("o"))


def _dot(a: str, b: str) -> Column:
    return F.col(f"{a}.g") * F.col(f"{b}.g") + F.col(f"{a}.o") * F.col(f"{b}.o")


def _solved(v: str) -> Column:
    """A strip's own 2 x 2 block divided out of a vector: the preconditioner."""
    d = F.col("d.gg") * F.col("d.oo") - F.col("d.go") * F.col("d.go")
    g, o = F.col(f"{v}.g"), F.col(f"{v}.o")
    return _pair((F.col("d.oo") * g - F.col("d.go") * o) / d, (F.col("d.gg") * o - F.col("d.go") * g) / d)


def _product(state: DataFrame, seams: DataFrame, v: str) -> DataFrame:
    """``state`` with ``q``, the matrix times the vector ``v``: own blocks less the neighbours' shares."""
    other = state.select(F.col("strip").alias("j"), F.col(f"{v}.g").alias("_g"), F.col(f"{v}.o").alias("_o"))
    g, o = F.col("_g"), F.col("_o")
    pulled = seams.join(other, "j").groupBy(F.col("i").alias("strip")).agg(
        F.sum(F.col("sij") * g + F.col("si") * o).alias("_pg"), F.sum(F.col("sj") * g + F.col("n") * o).alias("_po")
    )
    vg, vo = F.col(f"{v}.g"), F.col(f"{v}.o")
    own = (F.col("d.gg") * vg + F.col("d.go") * vo, F.col("d.go") * vg + F.col("d.oo") * vo)
    return state.join(pulled, "strip").withColumn("q", _pair(own[0] - F.col("_pg"), own[1] - F.col("_po"))).drop("_pg", "_po")


def _system(seams: DataFrame, ridge: float) -> DataFrame:
    """Per strip: its block ``d`` of the normal equations, the right side ``b`` and the cells it shares."""
    sums = seams.groupBy(F.col("i").alias("strip")).agg(*[F.sum(x).alias(x) for x in ("n", "si", "sii")], F.count("*").alias("n_seams"))
    # a strip of zeros has no gain to be found: the cell count keeps its block regular, and its gain at 1
    gain = ridge * F.col("sii") + F.when(F.col("sii") == 0, F.col("n")).otherwise(F.lit(0))
    block = F.struct((F.col("sii") + gain).alias("gg"), F.col("si").alias("go"), ((1 + ridge) * F.col("n")).alias("oo"))
    return sums.select("strip", F.col("n").alias("n_cells"), "n_seams", block.alias("d"), _pair(gain, F.lit(0.0)).alias("b"))


def seam_balance(obs: DataFrame, ridge: float = RIDGE, tolerance: float = 1e-12, most: int = 200) -> DataFrame:
    """``strip, gain, offset, n_cells, n_seams, residual`` of each strip that shares a cell with another.

    Minimises, over all pairs of strips and their common cells, the squared difference of ``gain * x + offset``, plus
    ``ridge`` times the weight of the strip's own cells on ``gain - 1`` and ``offset``. Conjugate gradients run
    on tables of a row per strip and per seam, whatever their number, until the residual of the normal equations has
    fallen to ``tolerance`` of the right side's; three numbers per round reach the driver. ``residual`` is
    computed anew from the result, as a share of the largest right side. ``most`` rounds without reaching the
    tolerance raise an error. No strips in common give an empty result.
    """
    seams = stage(seam_sums(obs), "seams")
    state = _system(seams, ridge).withColumn("x", _pair(F.lit(1.0), F.lit(0.0)))
    state = stage(_product(state, seams, "x"), "state").withColumn("res", _pair(F.col("b.g") - F.col("q.g"), F.col("b.o") - F.col("q.o")))
    state = state.withColumn("p", _solved("res"))
    z, size = state.agg(F.sum(_dot("res", "p")), F.sum(_dot("b", "b"))).first()
    left, rounds = size, 0
    while z and left > tolerance * tolerance * size:
        if rounds == most:
            raise RuntimeError(f"strips not balanced after {most} rounds")
        known = stage(_product(state.drop("q"), seams, "p"), "state")
        along = known.agg(F.sum(_dot("p", "q"))).first()[0]
        if not along > 0:  # nothing left to go along but rounding
            break
        step = z / along
        state = known.withColumns({
            "x": _pair(F.col("x.g") + step * F.col("p.g"), F.col("x.o") + step * F.col("p.o")),
            "res": _pair(F.col("res.g") - step * F.col("q.g"), F.col("res.o") - step * F.col("q.o")),
        })
        state = state.withColumn("z", _solved("res"))
        before = z
        z, left = state.agg(F.sum(_dot("res", "z")), F.sum(_dot("res", "res"))).first()
        turn = z / before
        state = state.withColumn("p", _pair(F.col("z.g") + turn * F.col("p.g"), F.col("z.o") + turn * F.col("p.o"))).drop("z")
        rounds += 1
    out = _product(stage(state.drop("q"), "balanced"), seams, "x")
    largest = out.agg(F.max(F.abs("b.g"))).first()[0] or 1.0
    worst = F.greatest(F.abs(F.col("b.g") - F.col("q.g")), F.abs(F.col("b.o") - F.col("q.o")))
    return out.select("strip", F.col("x.g").alias("gain"), F.col("x.o").alias("offset"), "n_cells", "n_seams", (worst / largest).alias("residual"))


def balance(obs: DataFrame, strips: DataFrame, top: int = 255) -> DataFrame:
    """Observations with ``dn`` replaced by ``gain * dn + offset``, rounded and kept within 0 and ``top``; NULL stays,
    and so do strips without a balance."""
    onto = strips.select("strip", F.col("gain").alias("_gain"), F.col("offset").alias("_offset"))
    level = clamp(F.round(F.col("_gain") * F.col("dn") + F.col("_offset")).cast("int"), 0, top)
    # greatest and least leave out NULL, nodata must stay
    level = F.when(F.col("dn").isNotNull(), F.when(F.col("_gain").isNotNull(), level).otherwise(F.col("dn")))
    return attach(obs, onto, ["strip"], "left").withColumn("dn", level).select(*obs.columns)
