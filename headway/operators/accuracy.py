"""Predictions scored against arrivals, and marts of punctuality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.constants import EARLY_S, FLOOR_AGENCY, FLOOR_ROUTE_HOUR, FLOOR_WORST, GRAIN, LATE_S
from headway.functions.expressions import lead_bucket, lead_order, on_time


def usable_predictions(df: DataFrame) -> DataFrame:
    """Predictions with a trip, a sequence, a predicted and an issue time; zero counts as missing."""
    issued = F.coalesce(F.nullif(F.col("trip_update_ts_epoch"), F.lit(0)), F.nullif(F.col("feed_header_ts_epoch"), F.lit(0)))
    out = df.withColumns({"issued": issued, "predicted": F.nullif(F.col("arrival_time_epoch"), F.lit(0))})
    return out.where("trip_id is not null and stop_sequence is not null and issued is not null and predicted is not null")


def pairs(predictions: DataFrame, arrivals: DataFrame, grain: tuple[str, ...] = GRAIN) -> DataFrame:
    """(grain, issued, predicted, actual, lead_s, error_s, lead_bucket, lead_order): every prediction made before its arrival.

    Copies of a prediction or an arrival count once; predictions made in hindsight don't count. error_s is predicted less
    actual: positive when the vehicle came earlier than foretold.
    """
    p = predictions.select(*grain, "issued", "predicted").distinct()
    a = arrivals.select(*grain, "actual").distinct()
    out = p.join(a, list(grain)).where("issued < actual")
    lead = F.col("actual") - F.col("issued")
    return out.withColumns({"lead_s": lead, "error_s": F.col("predicted") - F.col("actual"), "lead_bucket": lead_bucket(lead), "lead_order": lead_order(lead)})


def hindsight(predictions: DataFrame, arrivals: DataFrame, grain: tuple[str, ...] = GRAIN) -> DataFrame:
    """(n_pairs, n_scored, n_hindsight, n_unmatched_arrivals)."""
    p = predictions.select(*grain, "issued", "predicted").distinct()
    a = arrivals.select(*grain, "actual").distinct()
    j = a.join(p, list(grain), "left")
    return j.agg(F.count("issued").alias("n_pairs"), F.count_if(F.col("issued") < F.col("actual")).alias("n_scored"), F.count_if(F.col("issued") >= F.col("actual")).alias("n_hindsight"), F.count_if(F.col("issued").isNull()).alias("n_unmatched_arrivals"))


def by_value(df: DataFrame, by: list[str], value: Column) -> DataFrame:
    """(by, v, n, upto, total): how often each value occurs in its group, running and in all. Whole seconds have few
    values, so what follows the first, combining aggregate is small however many rows there are."""
    counts = df.select(*by, value.alias("v")).where("v is not null").groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by)
    return counts.withColumns({"upto": F.sum("n").over(w.orderBy("v")), "total": F.sum("n").over(w)})


def at_rank(rank: Column) -> Column:
    """Aggregates rows of by_value: the value at a rank from 0 in the sorted group."""
    return F.min(F.when(F.col("upto") > rank, F.col("v")))


def _median() -> Column:
    low, high = at_rank(F.floor((F.col("total") - 1) / 2)), at_rank(F.floor(F.col("total") / 2))
    return (low + high) / 2


def summarize(df: DataFrame, by: list[str], error: str = "error_s") -> DataFrame:
    """n, bias, medians, the nearest-rank-low p90 and shares within one and three minutes, by group."""
    size = lambda limit: F.sum(F.when(F.abs("v") <= limit, F.col("n")).otherwise(0))
    n = F.sum("n")
    signed = by_value(df, by, F.col(error)).groupBy(*by).agg(
        n.alias("n"),
        F.round(F.sum(F.col("v") * F.col("n")) / n, 1).alias("mean_error_s"),
        _median().alias("median_error_s"),
        F.round(100 * size(60) / n, 1).alias("pct_within_60s"),
        F.round(100 * size(180) / n, 1).alias("pct_within_180s"),
    )
    plain = by_value(df, by, F.abs(error)).groupBy(*by).agg(_median().alias("median_abs_error_s"), at_rank(F.floor(F.lit(0.9) * (F.col("total") - 1))).alias("p90_abs_error_s"))
    on = None
    for c in by:
        same = F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}"))
        on = same if on is None else on & same
    both = signed.alias("s").join(plain.alias("p"), on) if by else signed.alias("s").join(plain.alias("p"))
    return both.select(*[F.col(f"s.{c}").alias(c) for c in by], "n", "mean_error_s", "median_error_s", "median_abs_error_s", "pct_within_60s", "pct_within_180s", "p90_abs_error_s")


def _rates(delay: str) -> list:
    d = F.col(delay)
    pct = lambda c: F.round(100 * F.avg(c.cast("int")), 1)
    return [pct(on_time(d)).alias("on_time_pct"), pct(d < EARLY_S).alias("early_pct"), pct(d > LATE_S).alias("late_pct")]


def agency_mart(otp: DataFrame, floor: int = FLOOR_AGENCY) -> DataFrame:
    """Punctuality of each agency's scored arrivals."""
    out = otp.where("delay_s is not null").groupBy("agency").agg(
        F.count(F.lit(1)).alias("n_arrivals"),
        F.countDistinct("route_id").alias("n_routes"),
        F.countDistinct("service_date").alias("n_service_days"),
        F.expr("percentile_disc(0.5) within group (order by delay_s)").alias("median_delay_s"),
        F.round(F.avg("delay_s"), 1).alias("mean_delay_s"),
        F.expr("percentile_disc(0.9) within group (order by delay_s)").alias("p90_delay_s"),
        *_rates("delay_s"),
        F.max("poll_interval_s").alias("poll_interval_s"),
        F.round(100 * F.avg(F.col("valid_from_assumed").cast("int")), 1).alias("assumed_schedule_pct"),
    )
    return out.where(F.col("n_arrivals") >= floor)


def route_hour_mart(otp: DataFrame, floor: int = FLOOR_ROUTE_HOUR) -> DataFrame:
    rates = _rates("delay_s")
    out = otp.where("delay_s is not null").groupBy("agency", "route_id", "hour_local").agg(F.count(F.lit(1)).alias("n_arrivals"), F.expr("percentile_disc(0.5) within group (order by delay_s)").alias("median_delay_s"), rates[0], rates[2])
    return out.where(F.col("n_arrivals") >= floor)


def hourly(mart: DataFrame) -> DataFrame:
    """The route mart by hour, each rate weighted by its arrivals."""
    weighted = lambda c: F.round(F.sum(F.col(c) * F.col("n_arrivals")) / F.sum("n_arrivals"), 1).alias(c)
    return mart.groupBy("hour_local").agg(F.sum("n_arrivals").alias("n_arrivals"), weighted("on_time_pct"), weighted("late_pct"))


def worst_routes(otp: DataFrame, floor: int = FLOOR_WORST) -> DataFrame:
    """Routes ranked by the share on time; equal ones by agency and route. The one window without a key is over routes."""
    rates = _rates("delay_s")
    out = otp.where("delay_s is not null").groupBy("agency", "route_id").agg(F.count(F.lit(1)).alias("n_arrivals"), F.expr("percentile_disc(0.5) within group (order by delay_s)").alias("median_delay_s"), rates[0], rates[2])
    out = out.where(F.col("n_arrivals") >= floor)
    return out.withColumn("worst_rank", F.row_number().over(Window.orderBy("on_time_pct", "agency", "route_id")).cast("long"))
