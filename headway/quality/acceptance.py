"""The acceptance checks of a lake: each with a floor of rows, below which it is unmeasured and not passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import GRAIN
from headway.quality import contracts, expectations as E

#: Rows below which a check says nothing.
ARRIVALS, ROWS = 100, 10_000
#: Shares and seconds within which the vehicles' clocks may run ahead, and event times may equal ingest times.
SKEWED, WORST_SKEW_S, SAME_TIME = 0.10, 120, 0.01


def skew(facts: DataFrame, event: str = "report_epoch", ingest: str = "ingest_epoch", floor: int = ARRIVALS) -> DataFrame:
    """Vehicles' clocks ahead of the poll that saw them: few, and by no more than a poll; event times are no ingest times."""
    ahead = F.col(event) - F.col(ingest)
    worst = facts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.when(ahead > 0, ahead)), F.lit(0)).alias("m"))
    return E.report(
        E.share_below(facts, "clock ahead", ahead > 0, SKEWED, floor),
        E._result(worst, "worst skew", F.col("m"), F.col("m") <= WORST_SKEW_S, floor),
        E.share_below(facts, "event time is ingest time", ahead == 0, SAME_TIME, floor),
    )


def null_and_zero(rows: DataFrame, column: str, floor: int = ROWS) -> DataFrame:
    """Absent and zero are both there, so neither was made of the other."""
    c = F.col(column)
    agg = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(c.isNull()).alias("absent"), F.count_if(c == 0).alias("zero"))
    return E._result(agg, f"{column} null and zero", F.col("zero"), (F.col("absent") > 0) & (F.col("zero") > 0), floor)


def loops(facts: DataFrame, stop: str = "stop_id") -> DataFrame:
    """How many stops a trip visits at two places: why the sequence, and not the stop, is of the grain."""
    twice = facts.where(F.col(stop).isNotNull()).groupBy("service_date", "trip_id", stop).agg(F.countDistinct("stop_sequence").alias("k")).where("k > 1")
    return E.info(twice, "stops visited twice", F.count(F.lit(1)))


def checks(facts: DataFrame, again: DataFrame, rows: DataFrame, optional: str, provenance: list[str], more: dict[str, Column] | None = None, floor: int = ARRIVALS, row_floor: int = ROWS) -> DataFrame:
    """(name, status, measured, n), seven rows: grain, a second run's arrivals, null against zero, contract, provenance,
    event time, loops. facts have report_epoch, ingest_epoch and stop_id; rows are decoded events."""
    bad = contracts.violations(rows, more)
    lacking = F.lit(False)
    for c in provenance:
        lacking = lacking | F.col(c).isNull()
    same = E.same_rows(facts.select(*GRAIN, "report_epoch"), again.select(*GRAIN, "report_epoch"), "second run is the same")
    return E.report(
        E.unique(facts, list(GRAIN), floor),
        same.withColumn("status", F.when(F.col("n") < floor, "UNMEASURED").otherwise(F.col("status"))),
        null_and_zero(rows, optional, row_floor),
        E.none_violate(bad, "contract holds", F.size("violations") > 0, row_floor),
        E.none_violate(facts, "provenance complete", lacking, floor),
        E.share_below(facts, "event time is ingest time", F.col("report_epoch") == F.col("ingest_epoch"), SAME_TIME, floor),
        loops(facts),
    )
