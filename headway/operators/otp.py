"""Arrivals as facts, and their delay from the timetable that was valid on their service day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.constants import AGENCY_TZ
from headway.functions.expressions import agency_of, local, on_time, scheduled_epoch, service_day_start
from headway.operators.schedule import as_of, backdate_first

#: How an arrival is known, and by which rules.
METHOD, CONFIDENCE, RESOLVER_VERSION = "stopped_at", "high", "1.0.0"
KEYS = ("trip_id", "stop_sequence")
DIMENSION = ("arrival_time", "valid_from_assumed")


def facts(sightings: DataFrame) -> DataFrame:
    """First sightings with the stop renamed (an attribute, no part of the grain), how they are known, and a second
    method's agreement, which there is none of yet; columns that sightings lack are null."""
    given = lambda c, kind: F.col(c) if c in sightings.columns else F.lit(None).cast(kind)
    stop = "current_stop_id" if "current_stop_id" in sightings.columns else "stop_id"
    return sightings.select(
        "service_date",
        "trip_id",
        "stop_sequence",
        given(stop, "string").alias("stop_id"),
        given("route_id", "string").alias("route_id"),
        "report_epoch",
        "last_stopped",
        "observed_dwell_s",
        "n_stopped_observations",
        F.lit(METHOD).alias("arrival_method"),
        F.lit(CONFIDENCE).alias("arrival_confidence"),
        F.lit(None).cast("double").alias("arrival_method_agreement_s"),
        F.lit(RESOLVER_VERSION).alias("resolver_version"),
        given("poll_interval_s", "bigint").alias("poll_interval_s"),
        given("decoder_version", "string").alias("decoder_version"),
        given("ingest_ts", "timestamp").alias("ingest_ts"),
        given("source_path", "string").alias("source_path"),
    )


def delays(arrivals: DataFrame, dim: DataFrame, time: str = "report_epoch", tz: str = AGENCY_TZ) -> DataFrame:
    """arrivals with scheduled_epoch, delay_s, is_on_time, schedule_matched, valid_from_assumed, agency and hour_local.

    The version of the timetable is the one valid as the service day began; a key's first version reaches back and says
    so. Each arrival stays once: unmatched ones, and ones whose time is malformed, have no delay.
    """
    dim = backdate_first(dim, list(KEYS))
    rows = arrivals.withColumn("_as_of", F.timestamp_seconds(service_day_start(F.col("service_date"), tz)))
    rows = as_of(rows, dim, {k: k for k in KEYS}, "_as_of", list(DIMENSION))
    planned = scheduled_epoch(F.col("service_date"), F.col("arrival_time"), tz)
    rows = rows.withColumns({"scheduled_epoch": planned, "schedule_matched": F.col("arrival_time").isNotNull(), "delay_s": F.col(time) - planned})
    return rows.withColumns({"is_on_time": on_time(F.col("delay_s")), "agency": agency_of(F.col("trip_id")), "hour_local": F.hour(local(F.timestamp_seconds(time), tz)).cast("long")}).drop("_as_of", "arrival_time")


def conserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """(facts_in, rows_out, join_conserved, schedule_matched, scored, match_rate_pct): a join that multiplies facts has
    met two versions of a key."""
    out = after.agg(F.count(F.lit(1)).alias("rows_out"), F.count_if("schedule_matched").alias("schedule_matched"), F.count("delay_s").alias("scored"))
    both = before.agg(F.count(F.lit(1)).alias("facts_in")).join(F.broadcast(out))  # one row each
    rate = F.when(F.col("facts_in") > 0, F.round(100 * F.col("schedule_matched") / F.col("facts_in"), 1)).otherwise(0.0)
    return both.select("facts_in", "rows_out", (F.col("facts_in") == F.col("rows_out")).alias("join_conserved"), "schedule_matched", "scored", rate.alias("match_rate_pct"))
