"""The driver's star tables in the shape of transit feeds: positions, predictions, timetable snapshots, scored arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.constants import STOPPED
from headway.functions.expressions import local
from headway.operators.positions import first_sightings, resolvable
from headway.operators.schedule import unique_keys

STATUS = {"view": STOPPED, "purchase": STOPPED, "click": "IN_TRANSIT_TO", "signup": "INCOMING_AT"}
SNAPSHOT = "1998-01-01 00:00:00"
KEYS, ATTRIBUTES = ["k1", "k2"], ["q", "dsc", "rf"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shape_positions(events: DataFrame) -> DataFrame:
    status = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in STATUS.items()])
    user = F.col("user_id")
    return events.select(
        F.col("event_id").alias("entity_id"),
        F.date_format("ts", "yyyyMMdd").alias("service_date"),
        F.concat(F.lit("A"), user % 5, F.lit(":T"), user).alias("trip_id"),
        F.concat(F.lit("A"), user % 5, F.lit(":R"), user % 7).alias("route_id"),
        F.when(F.col("event_id") % 23 != 0, F.get_json_object("props", "$.k").cast("long") % 3).alias("stop_sequence"),
        status.alias("current_status"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("report_epoch"),
        "value",
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_positions(table(spark, sf_dir, "events"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = positions(spark, sf_dir).where("current_status in ('IN_TRANSIT_TO', 'INCOMING_AT') and stop_sequence is not null")
    return p.select("service_date", "trip_id", "stop_sequence", F.col("report_epoch").alias("issued"), (F.col("report_epoch") + F.floor(F.col("value") * 60).cast("long")).alias("predicted")).distinct()


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_sightings(positions(spark, sf_dir).where(resolvable()))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).withColumnRenamed("report_epoch", "actual")


def otp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First sightings with a delay by rule, one in 17 unscored, and the local hour."""
    s = sightings(spark, sf_dir)
    return s.select(
        "*",
        F.split_part("trip_id", F.lit(":"), F.lit(1)).alias("agency"),
        F.when(F.col("entity_id") % 17 != 0, F.col("entity_id") * 7919 % 1200 - 400).alias("delay_s"),
        F.hour(local(F.timestamp_seconds("report_epoch"))).cast("long").alias("hour_local"),
        (F.col("entity_id") % 4 == 0).alias("valid_from_assumed"),
        (120 + F.col("entity_id") % 2).alias("poll_interval_s"),
    )


def snapshot(spark: SparkSession, sf_dir: str, later: bool) -> DataFrame:
    """Line items shipped before, or from, a day, as timetable rows, one of each key."""
    cut = F.col("l_shipdate") >= F.lit(SNAPSHOT).cast("timestamp_ntz")
    rows = unique_keys(table(spark, sf_dir, "lineitem").where(cut if later else ~cut), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return rows.select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").cast("long").alias("k2"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("dsc"), F.col("l_returnflag").alias("rf"))
