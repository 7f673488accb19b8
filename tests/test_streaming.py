"""Stream mechanics that a batch comparison does not show."""

from pyspark.sql import functions as F

from silvagrid.plans.staging import new_path
from workload import tables
from silvagrid.sources.schemas import EVENTS
from silvagrid.streaming import intake
from tests.conftest import SF_DIR
from workload.queries import QUERIES


def land(part, folder):
    part.write.mode("append").parquet(folder)


def test_restart_gives_no_duplicates(spark):
    """Two runs on one checkpoint, data arriving in between, equal one batch."""
    events = tables.table(spark, SF_DIR, "events")
    folder, state, out = (new_path(spark, x) for x in ("landing", "state", "out"))
    stream = intake.tumbling(tables.arrivals_of(intake.read_arrivals(spark, _made(spark, folder), EVENTS)))
    land(events.filter("day(ts) <= 15"), folder)
    first = intake.run_now(stream, "t", state, out).count()
    land(events.filter("day(ts) > 15"), folder)
    both = intake.run_now(stream, "t", state, out)
    again = intake.run_now(stream, "t", state, out)
    assert 0 < first < both.count() == again.count()
    assert both.groupBy("w_start", "kind").count().filter("count > 1").count() == 0
    end = both.agg(F.max("w_end")).first()[0]
    batch = tables.arrivals_of(events).withColumn("w", F.window("ts", "1 hour")).filter(F.col("w.end") <= F.lit(end))
    assert both.agg(F.sum("n")).first()[0] == batch.count()


def _made(spark, folder):
    """A landing folder that exists before the first file arrives."""
    spark.createDataFrame([], EVENTS).write.mode("append").parquet(folder)
    return folder


def test_repeated_arrivals_count_once(spark):
    out = QUERIES["stream_dedup"](spark, SF_DIR)
    assert out.count() == out.select("event_id").distinct().count() == 1000


def test_partials_are_overwritten_not_added(spark):
    """Totals over several micro-batches equal the batch totals."""
    folder = _made(spark, new_path(spark, "landing"))
    events = tables.table(spark, SF_DIR, "events")
    for day in range(1, 32, 10):
        land(events.filter(F.dayofmonth("ts").between(day, day + 9)).coalesce(1), folder)
    stream = tables.arrivals_of(intake.read_arrivals(spark, folder, EVENTS, files_per_batch=1))
    got = {r["zone_id"]: r["n"] for r in intake.zonal_totals(stream).collect()}
    want = tables.arrivals_of(events).groupBy("zone_id").agg(F.count("*").alias("n"))
    assert got == {r["zone_id"]: r["n"] for r in want.collect()}


def test_late_rows_are_seen_as_late(spark):
    out = QUERIES["stream_late_rows"](spark, SF_DIR)
    days = {r["late"]: (r["lo"], r["hi"]) for r in out.groupBy((F.col("n_late") > 0).alias("late")).agg(
        F.min(F.dayofmonth("w_start")).alias("lo"), F.max(F.dayofmonth("w_start")).alias("hi")
    ).collect()}
    assert days[True] == (1, 20) and days[False][0] == 21
    assert out.filter("n_kept > 0 and n_late > 0").count() == 0


def test_pairs_across_bucket_borders_meet_once(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1L, TIMESTAMP '2024-01-01 00:59:59', 7L, 'click'), (2L, TIMESTAMP '2024-01-01 01:00:01', 7L, 'purchase'),"
        "(3L, TIMESTAMP '2024-01-01 01:59:59', 7L, 'purchase'), (4L, TIMESTAMP '2024-01-01 02:00:00', 7L, 'purchase'),"
        "(5L, TIMESTAMP '2024-01-01 01:00:01', 8L, 'purchase') AS t(event_id, ts, user_id, event_type)"
    )
    folder = new_path(spark, "landing")
    rows.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
        F.lit(0.0).alias("value"), F.lit("{}").alias("props"),
    ).write.parquet(folder)
    stream = tables.arrivals_of(intake.read_arrivals(spark, folder, EVENTS))
    out = intake.run_now(intake.interval_join(stream, "click", "purchase"), "pairs")
    assert sorted((r["first_id"], r["then_id"]) for r in out.collect()) == [(1, 2), (1, 3)]


def test_partial_totals_are_compacted_and_counted_once(spark, tmp_path):
    import os

    out, want = str(tmp_path), {}
    for k in range(8):
        batch = spark.createDataFrame([(z, float(z + k)) for z in range(k % 3 + 1)], "zone_id int, value double")
        for z in range(k % 3 + 1):
            n, total = want.get(z, (0, 0.0))
            want[z] = n + 1, total + z + k
        intake.add_totals(batch, k, out, 3)
        intake.add_totals(batch, k, out, 3)  # a repeated batch
        got = {r["zone_id"]: (r["n"], r["total"]) for r in intake._summed(spark, out)[0].collect()}
        assert got == want
        assert len(os.listdir(tmp_path / "part")) <= 3 and len(os.listdir(tmp_path / "whole")) <= 1 if k >= 2 else True
    assert intake._summed(spark, str(tmp_path / "nothing"))[0].count() == 0
