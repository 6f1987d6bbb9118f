"""From positions to arrivals: typing, deduplication, flags, first sightings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.constants import GRAIN, STOPPED


def dedup(df: DataFrame, keys: list[str], order: list[Column], whole: list[str] | None = None) -> DataFrame:
    """The first row of each key; rows in which a column of `whole` is null aren't keyed and all stay."""
    w = Window.partitionBy(*keys).orderBy(*order)
    keyed = df
    apart = None
    for c in whole or []:
        apart = F.col(c).isNull() if apart is None else apart | F.col(c).isNull()
    if apart is not None:
        keyed = df.where(~apart)
    out = keyed.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return out if apart is None else out.unionByName(df.where(apart))


def typed(df: DataFrame, columns: list[str]) -> DataFrame:
    """ISO texts as UTC timestamps; null where malformed."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c)) for c in columns if c in df.columns})


def quality_flags(df: DataFrame, grain: tuple[str, ...] = GRAIN, deleted: str = "is_deleted") -> DataFrame:
    """Adds grain_complete and is_deleted_entity; no row goes."""
    complete = F.lit(True)
    for c in grain:
        complete = complete & F.col(c).isNotNull()
    return df.withColumns({"grain_complete": complete, "is_deleted_entity": F.coalesce(F.col(deleted), F.lit(False))})


def resolvable(status: str = "current_status", event_time: str = "report_epoch", stop: str | None = None, deleted: str | None = None) -> Column:
    """Whether a sighting can stand for an arrival."""
    ok = (F.col(status) == STOPPED) & F.col(event_time).isNotNull()
    for c in GRAIN:
        ok = ok & F.col(c).isNotNull()
    if stop:
        ok = ok & F.col(stop).isNotNull()
    if deleted:
        ok = ok & ~F.coalesce(F.col(deleted), F.lit(False))
    return ok


def first_sightings(df: DataFrame, event_time: str = "report_epoch", ties: tuple[str, ...] = ("entity_id",), grain: tuple[str, ...] = GRAIN) -> DataFrame:
    """The earliest row of each grain with n_stopped_observations, last_stopped and observed_dwell_s; one exchange."""
    every = Window.partitionBy(*grain)
    order = every.orderBy(event_time, *ties)
    out = df.withColumns({"_rn": F.row_number().over(order), "n_stopped_observations": F.count(F.lit(1)).over(every), "last_stopped": F.max(event_time).over(every)})
    return out.where("_rn = 1").drop("_rn").withColumn("observed_dwell_s", F.col("last_stopped") - F.col(event_time))


def skip_reason() -> Column:
    """Why a sighting is no arrival: the first of the reasons in this order, else null."""
    reasons = (("no_trip", F.col("trip_id").isNull()), ("no_status", ~(F.coalesce(F.col("current_status"), F.lit("")) == STOPPED)), ("no_sequence", F.col("stop_sequence").isNull()), ("no_event_ts", F.col("report_epoch").isNull()))
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in reasons])


def previous(df: DataFrame, column: str, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn(f"prev_{column}", F.lag(column).over(Window.partitionBy(*keys).orderBy(*order)))


def stale(df: DataFrame, same: list[str], keys: list[str], order: list[str]) -> DataFrame:
    """Adds is_stale: any of the columns is as in the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    any_same = F.lit(False)
    for c in same:
        any_same = any_same | F.coalesce(F.lag(c).over(w) == F.col(c), F.lit(False))
    return df.withColumn("is_stale", any_same)


def islands(df: DataFrame, keys: list[str], time: str, gap_s: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds island: the number of the run in which no two neighbours are further apart than the gap."""
    w = Window.partitionBy(*keys).orderBy(time, *ties)
    starts = F.when(F.col(time) - F.lag(time).over(w) <= gap_s, 0).otherwise(1)
    return df.withColumn("_s", starts).withColumn("island", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def sliding_count(df: DataFrame, keys: list[str], time: str, seconds: int) -> DataFrame:
    """Adds recent: rows of the key in the seconds up to this row, itself included."""
    w = Window.partitionBy(*keys).orderBy(time).rangeBetween(-seconds, 0)
    return df.withColumn("recent", F.count(F.lit(1)).over(w))


def loops(df: DataFrame, trip: list[str], stop: str, sequence: str) -> DataFrame:
    """(trip, stop, n_sequences): stops that a trip visits at more than one place."""
    return df.where(F.col(stop).isNotNull()).groupBy(*trip, stop).agg(F.countDistinct(sequence).alias("n_sequences")).where("n_sequences > 1")
