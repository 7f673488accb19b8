"""Stream operators. Each takes and returns streaming DataFrames; ``run_now`` and
``zonal_totals`` start queries.

Where rows meet, state is keyed by time windows or buckets besides the source or the kind, so
a source that sends a third of all arrivals is spread over partitions. Sessions are the exception:
their windows are not known beforehand, so state is by source; with
``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` each task first merges what
it has read, and a hot source costs one row per task and open session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvagrid.plans.staging import new_path

HOUR = 3600


def read_arrivals(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files in a folder, or matching a glob, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_now(stream: DataFrame, name: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Process everything available into a Parquet sink and return the sink's table.

    Given the same ``checkpoint`` and ``out`` a later call goes on where the last
    one stopped.
    """
    spark = stream.sparkSession
    out = out or new_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint or new_path(spark, f"{name}-state"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def dedup(arrivals: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First arrival of each ``event_id`` within the watermark."""
    return arrivals.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def _flat(windowed: DataFrame) -> DataFrame:
    rest = [x for x in windowed.columns if x != "window"]
    return windowed.select(F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), *rest)


def tumbling(arrivals: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Arrivals per window and kind."""
    return _flat(
        arrivals.withWatermark("ts", delay)
        .groupBy(F.window("ts", width).alias("window"), "kind")
        .agg(F.count("*").alias("n"))
    )


def sliding(arrivals: DataFrame, width: str = "2 hours", step: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Arrivals per overlapping window and kind."""
    return _flat(
        arrivals.withWatermark("ts", delay)
        .groupBy(F.window("ts", width, step).alias("window"), "kind")
        .agg(F.count("*").alias("n"))
    )


def sessions(arrivals: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Bursts per source: arrivals at most ``gap`` apart."""
    return _flat(
        arrivals.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap).alias("window"), "source_id")
        .agg(F.count("*").alias("n"))
    )


def enrich(arrivals: DataFrame, zones: DataFrame) -> DataFrame:
    """Arrivals with their zone's name; the static side is broadcast by Spark when
    its files are under the broadcast threshold, and shuffled otherwise."""
    return arrivals.join(zones, "zone_id")


def interval_join(arrivals: DataFrame, first: str, then: str, within: int = HOUR, delay: str = "1 hour") -> DataFrame:
    """Pairs of an arrival of kind ``first`` and one of kind ``then`` from the same
    source at most ``within`` seconds later.

    Joined on source and time bucket: an early row is put in each bucket its
    partners can lie in, a late row in its own, so each pair meets exactly once.
    """
    def bucket(ts):
        return F.floor(F.unix_timestamp(ts) / within)

    marked = arrivals.withWatermark("ts", delay)
    a = marked.filter(F.col("kind") == first).select(
        F.col("event_id").alias("first_id"),
        F.col("source_id").alias("a_source"),
        F.col("ts").alias("first_ts"),
        F.explode(F.sequence(bucket(F.col("ts")), bucket(F.col("ts")) + 1)).alias("a_bucket"),
    )
    b = marked.filter(F.col("kind") == then).select(
        F.col("event_id").alias("then_id"),
        F.col("source_id").alias("b_source"),
        F.col("ts").alias("then_ts"),
        bucket(F.col("ts")).alias("b_bucket"),
    )
    limit = F.expr(f"then_ts >= first_ts AND then_ts <= first_ts + INTERVAL {within} SECONDS")
    met = (F.col("a_source") == F.col("b_source")) & (F.col("a_bucket") == F.col("b_bucket")) & limit
    return a.join(b, met).select(F.col("a_source").alias("source_id"), "first_id", "then_id", "first_ts", "then_ts")


_TOTALS = "zone_id int, n long, total double"


def _folders(spark: SparkSession, path: str) -> tuple[object, dict[int, object]]:
    """The file system of a folder and its finished ``name=<number>`` folders by number."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [x.getPath() for x in store.listStatus(top)] if store.exists(top) else []
    done = [x for x in found if "=" in x.getName() and store.exists(x.suffix("/_SUCCESS"))]
    return store, {int(x.getName().split("=")[1]): x for x in done}


def _summed(spark: SparkSession, out: str) -> tuple[DataFrame, int]:
    """The totals of a folder written by ``add_totals``, and the last batch that its compacted table holds."""
    _, whole = _folders(spark, f"{out}/whole")
    _, parts = _folders(spark, f"{out}/part")
    last = max(whole, default=-1)
    paths = [str(whole[last])] if whole else []
    paths += [str(p) for k, p in parts.items() if k > last]
    rows = spark.read.schema(_TOTALS).parquet(*paths) if paths else spark.createDataFrame([], _TOTALS)
    return rows.groupBy("zone_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), last


def add_totals(batch: DataFrame, batch_id: int, out: str, every: int) -> None:
    """Add a micro-batch to the totals per zone in ``out``.

    A batch overwrites its own partial, so that a repeated one counts once. Every ``every`` batches all partials and the last
    compacted table become a new one, under the number of its last batch; only when that is complete are they deleted. A
    batch that a compacted table holds already is passed over.
    """
    spark = batch.sparkSession
    _, whole = _folders(spark, f"{out}/whole")
    if batch_id <= max(whole, default=-1):
        return
    part = batch.groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    part.write.mode("overwrite").parquet(f"{out}/part/batch={batch_id}")
    if (batch_id + 1) % every == 0:
        _summed(spark, out)[0].write.mode("overwrite").parquet(f"{out}/whole/upto={batch_id}")
        for kind in ("whole", "part"):
            store, found = _folders(spark, f"{out}/{kind}")
            for k, path in found.items():
                if k < batch_id or (kind == "part" and k == batch_id):
                    store.delete(path, True)


def zonal_totals(arrivals: DataFrame, name: str = "zonal", every: int = 64) -> DataFrame:
    """Running totals per zone: the compacted table and at most ``every`` partials of micro-batches, added by the reader."""
    spark = arrivals.sparkSession
    out = new_path(spark, name)
    query = (
        arrivals.writeStream.foreachBatch(lambda batch, batch_id: add_totals(batch, batch_id, out, every))
        .option("checkpointLocation", new_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _summed(spark, out)[0]


def late_rows(slices: list[DataFrame], schema: T.StructType, to_arrivals, delay: str = "1 hour") -> DataFrame:
    """Hourly counts of a stream whose ``slices`` land one after another, beside
    what has landed in all: ``w_start, w_end, n_kept, n_late``.

    Each slice is counted once, as it lands; its counts are added up, landed files are not read again. It is written to the landing folder and processed by a run that goes
    on from the last checkpoint, so rows older than the watermark at their arrival
    are excluded by Spark and show up as the difference. Windows still open at the
    end are left out.
    """
    spark = slices[0].sparkSession
    landing, out, state, landed = (new_path(spark, f"late-{x}") for x in ("in", "out", "state", "landed"))
    for part in slices:
        part.write.mode("append").parquet(landing)
        arrived = to_arrivals(part).groupBy(F.window("ts", "1 hour").alias("window")).agg(F.count("*").alias("n_all"))
        _flat(arrived).write.mode("append").parquet(landed)
        stream = to_arrivals(read_arrivals(spark, landing, schema))
        counts = _flat(stream.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("window")).count())
        kept = run_now(counts, "late", state, out)
    every = spark.read.schema("w_start timestamp, w_end timestamp, n_all long").parquet(landed)
    every = every.groupBy("w_start", "w_end").agg(F.sum("n_all").alias("n_all"))
    newest = kept.agg(F.max("w_end")).first()[0]
    sides = every.join(kept.select("w_start", F.col("count").alias("n_kept")), "w_start", "left")
    closed = sides.filter(F.col("w_end") <= F.lit(newest))
    n_kept = F.coalesce("n_kept", F.lit(0))
    return closed.select("w_start", "w_end", n_kept.alias("n_kept"), (F.col("n_all") - n_kept).alias("n_late"))
