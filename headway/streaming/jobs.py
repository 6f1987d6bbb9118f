"""Structured Streaming: bronze ingest, arrival resolution, scoring of predictions, windows, dead letters."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.constants import GRAIN
from headway.operators.positions import first_sightings, resolvable
from headway.operators.tables import VersionedTable, merge_by_partition
from headway.sources import feed

#: How late an event may come.
LATENESS = "1 hour"


def shared(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: below the checkpoint folder, or a local one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="headway-")
    return f"{base.rstrip('/')}/headway-{uuid.uuid4().hex[:12]}/{name}"


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at path, a file or a folder, as a stream of its files."""
    batch = spark.read.parquet(path)
    one = batch.inputFiles()[:1]
    reader = spark.readStream.schema(batch.schema)
    if one and one[0].rstrip("/").endswith(path.rsplit("/", 1)[1]):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def drain(df: DataFrame, batch: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None, **conf: str) -> dict:
    """Runs the stream over all there is and stops; batches, rows and the rows a second that it read.

    With a checkpoint that stays, the next run goes on where this one stopped, and its batches' numbers go on too; files
    are marked as done after their batch is.
    """
    spark = df.sparkSession
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        q = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint or shared(spark, "checkpoint")).trigger(availableNow=True).foreachBatch(batch).start()
        q.awaitTermination()
        done = {p["batchId"]: p for p in q.recentProgress if p["numInputRows"]}
        return {"batches": len(done), "rows": sum(p["numInputRows"] for p in done.values()), "seconds": sum(p["batchDuration"] for p in done.values()) / 1000}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def collected(df: DataFrame, mode: str = "append", keys: tuple[str, ...] = (), **conf: str) -> DataFrame:
    """The stream's whole output as a table; of an updated one, the last row of each of `keys`. Each batch writes a folder of its own by number, so a batch that runs again
    replaces what it had written; of a complete output the last batch counts."""
    spark, path, last = df.sparkSession, shared(df.sparkSession, "out"), []

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        last.append(number)

    drain(df, write, mode, None, **conf)
    if not last:
        return spark.createDataFrame([], df.schema)
    if mode == "complete":
        return spark.read.schema(df.schema).parquet(f"{path}/batch={last[-1]}")
    if mode == "update":  # the last row of each key counts
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in sorted(set(last))])
        w = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
        return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(df.columns)
    return spark.read.schema(df.schema).parquet(*[f"{path}/batch={n}" for n in sorted(set(last))])


def with_event_time(positions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return positions.withColumn("event_time", F.timestamp_seconds("report_epoch")).withWatermark("event_time", lateness)


# Bronze


def ingest(files: DataFrame, feed_type: str, table: VersionedTable, poll_interval_s: int = 120, **extra) -> None:
    """Decodes the payloads that the table's ledger doesn't name. Rows, quarantine and ledger are one commit, and the
    ledger has every path, with good rows or not: no file is decoded twice and none is quarantined twice."""
    ledger = table.side("ledger")
    if ledger is not None:
        files = files.join(ledger.select("path"), "path", "left_anti").select(files.columns)
    rows = feed.decoded(files, feed_type, poll_interval_s).persist()
    try:
        good, bad = feed.split(rows)
        seen = files.select("path", "poll_epoch", F.current_timestamp().alias("seen_at"))
        table.append(good.withColumn("bronze_loaded_at", F.current_timestamp()), side={"quarantine": bad, "ledger": seen}, **extra)
    finally:
        rows.unpersist()


def bronze(spark: SparkSession, root: str, feed_type: str, table: VersionedTable, poll_interval_s: int = 120, max_files: int = 200) -> dict:
    """New payloads into the table, batch by batch. The checkpoint lies with the table, so a further run takes new files
    alone; a batch's number is committed with its rows, so one that failed before its own commit isn't written twice."""

    def write(files: DataFrame, number: int) -> None:
        files = files.persist()
        try:
            if not files.isEmpty() and number > table.meta().get("batch", -1):
                ingest(files, feed_type, table, poll_interval_s, batch=number)
        finally:
            files.unpersist()

    return drain(feed.scan_stream(spark, root, feed_type, max_files), write, "append", f"{table.path}/_checkpoint")


# Arrivals


def resolve(positions: DataFrame, table: VersionedTable, checkpoint: str | None = None) -> dict:
    """First sightings of each grain, merged batch by batch: a late but earlier sighting corrects, order doesn't matter.
    A batch reads and writes the service dates that it touches."""

    def write(rows: DataFrame, number: int) -> None:
        new = first_sightings(rows.where(resolvable())).select(*GRAIN, "entity_id", "report_epoch", "last_stopped")
        merge_by_partition(table, new, list(GRAIN), "report_epoch", "service_date", ("entity_id",), ("last_stopped",))

    return drain(positions, write, "append", checkpoint)


TRIP_DAY = ["service_date", "trip_id"]


def resolve_with_status(positions: DataFrame, arrivals: VersionedTable, state: VersionedTable, idle_s: int = 3 * 86400) -> dict:
    """Arrivals in the order of delivery, each with its trip's status before.

    The state, each trip day's last status, is a table of its own version by version, as are the arrivals: a batch reads
    both, takes the first stop at each sequence that isn't there yet, and writes both. Trip days that have been silent for
    `idle_s` before the batch's first report are forgotten. Rows without a service date are a day of their own.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows = rows.where("trip_id is not null").withColumn("service_date", F.coalesce("service_date", F.lit("nodate")))
        w = Window.partitionBy(*TRIP_DAY).orderBy("report_epoch", "entity_id")
        newest = rows.groupBy(*TRIP_DAY).agg(F.max(F.struct("report_epoch", "entity_id", "current_status")).alias("last"))
        if state.version is None:
            known = newest.limit(0)
        else:
            known = state.read()
        seen = rows.withColumns({"_rn": F.row_number().over(w), "_lag": F.lag("current_status").over(w)}).join(known, TRIP_DAY, "left")
        seen = seen.withColumn("prev_status", F.when(F.col("_rn") > 1, F.col("_lag")).otherwise(F.col("last.current_status")))
        new = first_sightings(seen.where(resolvable())).select(*GRAIN, "entity_id", "report_epoch", "prev_status")
        if arrivals.version is not None:
            new = new.join(arrivals.read().select(*GRAIN), list(GRAIN), "left_anti")
        arrivals.append(new, batch=number)
        first = F.broadcast(rows.agg(F.min("report_epoch").alias("_first")))  # one row
        still = known.join(newest, TRIP_DAY, "left_anti").join(first).where(F.col("last.report_epoch") >= F.col("_first") - idle_s)
        state.overwrite(newest.unionByName(still.select(newest.columns)), batch=number)

    return drain(positions, write)


# Predictions, deduplication, windows


def score(predictions: DataFrame, arrivals: DataFrame, bound: str = "1 day") -> DataFrame:
    """Pairs of predictions (issued, predicted) and later arrivals (actual) of a grain within the bound, after which the
    state of either side can go."""
    p = predictions.withColumn("pts", F.timestamp_seconds("issued")).withWatermark("pts", LATENESS)
    a = arrivals.select(*[F.col(c).alias(f"a_{c}") for c in GRAIN], "actual").withColumn("ats", F.timestamp_seconds("actual")).withWatermark("ats", LATENESS)
    same = [F.col(c) == F.col(f"a_{c}") for c in GRAIN]
    on = same[0] & same[1] & same[2] & F.expr(f"pts < ats and ats <= pts + interval {bound}")
    return p.join(a, on).select(*GRAIN, "issued", "predicted", "actual", (F.col("predicted") - F.col("actual")).alias("error_s"))


def once(positions: DataFrame, keys: tuple[str, ...] = GRAIN, lateness: str = LATENESS) -> DataFrame:
    """One row of each key within the lateness, whichever is delivered first."""
    return with_event_time(positions, lateness).dropDuplicatesWithinWatermark(list(keys))


def tumbling(positions: DataFrame, width: str = "1 day") -> DataFrame:
    return sliding(positions, width, width)


def sliding(positions: DataFrame, width: str, step: str) -> DataFrame:
    """(agency, start_epoch, n) coverage by window."""
    w = with_event_time(positions).groupBy(F.window("event_time", width, step).alias("w"), F.split_part("trip_id", F.lit(":"), F.lit(1)).alias("agency")).agg(F.count(F.lit(1)).alias("n"))
    return w.select("agency", F.unix_timestamp("w.start").alias("start_epoch"), "n")


def sessions(positions: DataFrame, gap: str = "2 hours") -> DataFrame:
    """(trip_id, start_epoch, n): runs of a trip's positions with no gap as long. Spark also merges sessions that only touch,
    so the window is a microsecond, the least step of a timestamp, shorter than the gap that ends a run."""
    w = with_event_time(positions).groupBy(F.session_window("event_time", f"{gap} -1 microseconds").alias("w"), "trip_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("trip_id", F.unix_timestamp("w.start").alias("start_epoch"), "n")
