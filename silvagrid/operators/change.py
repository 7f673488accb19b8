"""Change between dates and series per cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvagrid.plans.series import running

#: What identifies a piece of ground; add a footprint where scenes cover different ground.
GROUND = ("r", "c")


def dated_steps(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "scene_id") -> DataFrame:
    """Each classified cell beside its last classified state before: columns plus ``was, now, was_scene``.

    Cells are matched by ``ground`` and ordered by ``date``; dates may be missing and NULL classes
    are passed over. A window group is one piece of ground: as many rows as there are dates of it.
    """
    cell = Window.partitionBy(*ground).orderBy(date)
    valid = classes.filter("cls is not null")
    return (
        valid.withColumn("_before", F.lag(F.struct("cls", "scene_id")).over(cell))
        .filter("_before is not null")
        .select(*classes.columns, F.col("_before.cls").alias("was"), F.col("cls").alias("now"), F.col("_before.scene_id").alias("was_scene"))
    )


def transition_matrix(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "scene_id") -> DataFrame:
    """Cell counts by class before and after, for each scene that held the state before."""
    steps = dated_steps(classes, ground, date)
    return steps.groupBy(F.col("was_scene").alias("scene_id"), "was", "now").agg(F.count("*").alias("n"))


def _turned(classes: DataFrame, was: int, now: int, ground: Sequence[str], date: str) -> DataFrame:
    steps = dated_steps(classes, ground, date).filter((F.col("was") == was) & (F.col("now") == now))
    return steps.select(F.col("was_scene").alias("scene_id"), *ground)


def forest_loss(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "scene_id") -> DataFrame:
    """Cells that were forest in scene ``scene_id`` and other (0) when next classified. Nodata is no loss."""
    return _turned(classes, 1, 0, ground, date)


def forest_gain(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "scene_id") -> DataFrame:
    """Cells that were other (0) in scene ``scene_id`` and forest when next classified."""
    return _turned(classes, 0, 1, ground, date)


def forest_stable(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "scene_id") -> DataFrame:
    """Cells that were forest in scene ``scene_id`` and when next classified."""
    return _turned(classes, 1, 1, ground, date)


def pixel_series(obs: DataFrame, ties: Sequence[str]) -> DataFrame:
    """Every observation with the cell's previous grey level, the difference and
    the running mean, in time order."""
    order = ["acq_ts", *ties]
    series = running(
        obs.select("r", "c", "dn", *order),
        ["r", "c"],
        order,
        last={"prev_dn": F.col("dn")},
        sums={"_sum": F.col("dn"), "n_so_far": F.when(F.col("dn").isNotNull(), 1).otherwise(0)},
        inclusive=False,
    )
    return series.select(
        "r",
        "c",
        *order,
        "dn",
        "prev_dn",
        (F.col("dn") - F.col("prev_dn")).alias("diff"),
        "n_so_far",
        F.try_divide("_sum", "n_so_far").alias("mean_so_far"),
    )


def first_loss(classes: DataFrame, ground: Sequence[str] = GROUND, date: str = "acq_date") -> DataFrame:
    """First date on which a cell is other (0) that was forest when last classified before."""
    lost = dated_steps(classes, ground, date).filter("was = 1 and now = 0")
    return lost.groupBy(*ground).agg(F.min(date).alias("first_loss"))


def asof_scene(requests: DataFrame, scenes: DataFrame, key: str = "zone_id") -> DataFrame:
    """For each request the latest acquisition of its zone at or before its time.

    Both tables carry ``key, ts, event_id``; the result keeps all requests and
    adds ``scene_event, scene_ts`` (NULL where nothing came before).
    """
    none = F.lit(None)
    both = scenes.select(
        key, "ts", F.lit(0).alias("_side"), "event_id", F.struct("event_id", "ts").alias("_scene")
    ).unionByName(
        requests.select(
            key,
            "ts",
            F.lit(1).alias("_side"),
            "event_id",
            none.cast("struct<event_id:bigint,ts:timestamp>").alias("_scene"),
        )
    )
    # a scene of the same instant sorts before the request
    order = ["ts", "_side", "event_id"]
    seen = running(both, [key], order, last={"_last": F.col("_scene")}, sums={}, inclusive=True)
    return seen.filter("_side = 1").select(
        "event_id", key, "ts", F.col("_last.event_id").alias("scene_event"), F.col("_last.ts").alias("scene_ts")
    )


def area_by_year(classes: DataFrame, by: Sequence[str] = ("zone_id",), ground: Sequence[str] = GROUND) -> DataFrame:
    """Cells that are forest at the end of each year per group, with the change on the preceding
    year present. A cell counts once a year, by its last classification of that year."""
    valid = classes.filter("cls is not null")
    last = valid.groupBy(*by, *ground, F.year("acq_date").alias("year")).agg(F.max_by("cls", F.struct("acq_date", "scene_id")).alias("cls"))
    yearly = last.groupBy(*by, "year").agg(F.sum("cls").alias("n_forest"))
    before = F.lag("n_forest").over(Window.partitionBy(*by).orderBy("year"))
    return yearly.withColumn("change", F.col("n_forest") - before)
