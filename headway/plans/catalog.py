"""The registered queries of the engine, each with its text for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.constants import GRAIN
from headway.functions import expressions as X
from headway.operators import accuracy, positions as P, schedule as S, tables as T
from headway.sources import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The views of headway.sources.views in DuckDB's SQL.
CTES = {
    "positions": """select event_id as entity_id, strftime(ts, '%Y%m%d') as service_date, 'A' || (user_id % 5) || ':T' || user_id as trip_id,
 'A' || (user_id % 5) || ':R' || (user_id % 7) as route_id,
 case when event_id % 23 <> 0 then cast(json_extract_string(props, '$.k') as bigint) % 3 end as stop_sequence,
 case event_type when 'view' then 'STOPPED_AT' when 'purchase' then 'STOPPED_AT' when 'click' then 'IN_TRANSIT_TO' when 'signup' then 'INCOMING_AT' end as current_status,
 cast(floor(epoch(ts)) as bigint) as report_epoch, value from events""",
    "predictions": """select distinct service_date, trip_id, stop_sequence, report_epoch as issued, report_epoch + cast(floor(value * 60) as bigint) as predicted
 from positions where current_status in ('IN_TRANSIT_TO', 'INCOMING_AT') and stop_sequence is not null""",
    "stopped": "select * from positions where current_status = 'STOPPED_AT' and stop_sequence is not null and service_date is not null and trip_id is not null and report_epoch is not null",
    "sightings": """select * exclude (rn), last_stopped - report_epoch as observed_dwell_s from (select *, row_number() over (partition by service_date, trip_id, stop_sequence order by report_epoch, entity_id) as rn,
 count(*) over (partition by service_date, trip_id, stop_sequence) as n_stopped_observations, max(report_epoch) over (partition by service_date, trip_id, stop_sequence) as last_stopped from stopped) where rn = 1""",
    "otp": """select *, split_part(trip_id, ':', 1) as agency, case when entity_id % 17 <> 0 then entity_id * 7919 % 1200 - 400 end as delay_s,
 cast(hour(timezone('America/Los_Angeles', timezone('UTC', make_timestamp(report_epoch * 1000000)))) as bigint) as hour_local, entity_id % 4 = 0 as valid_from_assumed, 120 + entity_id % 2 as poll_interval_s from sightings""",
    "pairs": """select distinct p.*, s.report_epoch as actual, s.report_epoch - p.issued as lead_s, p.predicted - s.report_epoch as error_s,
 case when s.report_epoch - p.issued >= 1200 then '20+ min' when s.report_epoch - p.issued >= 600 then '10-20 min' when s.report_epoch - p.issued >= 300 then '5-10 min' when s.report_epoch - p.issued >= 120 then '2-5 min' else '0-2 min' end as lead_bucket
 from predictions p join sightings s using (service_date, trip_id, stop_sequence) where p.issued < s.report_epoch""",
    "items": "select *, row_number() over (partition by l_shipdate >= timestamp '1998-01-01', l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem",
    "v1": "select l_orderkey as k1, cast(l_linenumber as bigint) as k2, l_quantity as q, l_discount as dsc, l_returnflag as rf from items where rn = 1 and l_shipdate < timestamp '1998-01-01'",
    "v2": "select l_orderkey as k1, cast(l_linenumber as bigint) as k2, l_quantity as q, l_discount as dsc, l_returnflag as rf from items where rn = 1 and l_shipdate >= timestamp '1998-01-01'",
    "changes": """select coalesce(a.k1, b.k1) as k1, coalesce(a.k2, b.k2) as k2, case when a.k1 is null then 'new' when b.k1 is null then 'missing'
 when a.q is distinct from b.q or a.dsc is distinct from b.dsc or a.rf is distinct from b.rf then 'changed' else 'same' end as change from v1 a full join v2 b on a.k1 = b.k1 and a.k2 = b.k2""",
    "dim": """select v1.*, 0 as valid_from, case when change = 'changed' then 1 else 2 end as valid_to, change <> 'changed' as is_current from v1 join changes using (k1, k2)
 union all select v2.*, 1, 2, true from v2 join changes using (k1, k2) where change in ('new', 'changed')""",
    "features": """select p.service_date, p.trip_id, p.stop_sequence, p.issued, p.predicted, s.report_epoch as actual, p.predicted - p.issued as horizon_s, s.report_epoch - p.predicted as residual_s
 from predictions p join sightings s using (service_date, trip_id, stop_sequence) where p.issued < s.report_epoch and p.predicted - p.issued between 1 and 3600""",
}
NEEDS = {"predictions": ["positions"], "stopped": ["positions"], "sightings": ["stopped"], "otp": ["sightings"], "pairs": ["predictions", "sightings"], "v1": ["items"], "v2": ["items"], "changes": ["v1", "v2"], "dim": ["changes", "v1", "v2"], "features": ["predictions", "sightings"]}


def sql_with(body: str, *names: str) -> str:
    """The body after a WITH clause of the named views and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return ("with " + ",\n".join(f"{n} as ({CTES[n]})" for n in order) + "\n" if order else "") + body


def query(sql: str | None = None, *views: str):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql_with(sql, *views)
        return f

    return register


GRAIN_COLUMNS = list(GRAIN)


# Projections and filters


@query("select entity_id, service_date is not null and trip_id is not null and stop_sequence is not null as grain_complete, coalesce(case when entity_id % 11 = 0 then null else entity_id % 10 = 0 end, false) as is_deleted_entity from positions", "positions")
def p5_quality_flags(spark, d):
    p = V.positions(spark, d).withColumn("is_deleted", F.when(F.col("entity_id") % 11 != 0, F.col("entity_id") % 10 == 0))
    return P.quality_flags(p).select("entity_id", "grain_complete", "is_deleted_entity")


@query("""select entity_id, cast(hour(t) as bigint) as hour_local, strftime(t, '%A') as day_name, cast((dayofweek(t) + 6) % 7 as bigint) as weekday
from (select entity_id, timezone('America/Los_Angeles', timezone('UTC', make_timestamp(report_epoch * 1000000))) as t from positions)""", "positions")  # fmt: skip
def p6_local_time(spark, d):
    t = X.local(F.timestamp_seconds("report_epoch"))
    return V.positions(spark, d).select("entity_id", F.hour(t).cast("long").alias("hour_local"), F.date_format(t, "EEEE").alias("day_name"), F.weekday(t).cast("long").alias("weekday"))


@query("select entity_id, case when entity_id % 3 = 0 then 'UNKNOWN' else split_part(trip_id, ':', 1) end as agency from positions", "positions")
def p7_agency_prefix(spark, d):
    bare = F.when(F.col("entity_id") % 3 == 0, F.split_part("trip_id", F.lit(":"), F.lit(2))).otherwise(F.col("trip_id"))
    return V.positions(spark, d).select("entity_id", X.agency_of(bare, F.lit(None).cast("string")).alias("agency"))


@query("select entity_id, trip_id, report_epoch from stopped", "stopped")
def f1_resolver_filter(spark, d):
    return V.positions(spark, d).where(P.resolvable()).select("entity_id", "trip_id", "report_epoch")


@query("select entity_id, trip_id from positions where starts_with(trip_id, 'A3:')", "positions")
def f4_agency_filter(spark, d):
    return V.positions(spark, d).where(F.col("trip_id").startswith("A3:")).select("entity_id", "trip_id")


@query("select agency, route_id, n_arrivals, on_time_pct from (select agency, route_id, count(*) as n_arrivals, round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct from otp where delay_s is not null group by all) where agency = 'A2' order by on_time_pct, route_id limit 5", "otp")
def f11_api_filters(spark, d):
    V.otp(spark, d).createOrReplaceTempView("headway_otp")
    return spark.sql("select agency, route_id, count(*) as n_arrivals, round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct from headway_otp where delay_s is not null and agency = :agency group by agency, route_id order by on_time_pct, route_id limit :n", args={"agency": "A2", "n": 5})


@query("select entity_id from positions where report_epoch between (select min(report_epoch) + 3600 from positions where current_status = 'STOPPED_AT') and (select max(report_epoch) - 3600 from positions where current_status = 'STOPPED_AT')", "positions")
def f12_window_clip(spark, d):
    p = V.positions(spark, d)
    edge = p.where("current_status = 'STOPPED_AT'").agg((F.min("report_epoch") + 3600).alias("t0"), (F.max("report_epoch") - 3600).alias("t1"))
    return p.join(F.broadcast(edge), F.col("report_epoch").between(F.col("t0"), F.col("t1"))).select("entity_id")  # one row


# Windows


@query("select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_quantity from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate, l_partkey, l_suppkey, l_extendedprice) as rn from lineitem) where rn = 1")
def w1_silver_dedup(spark, d):
    out = P.dedup(V.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").asc_nulls_last(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")])
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "l_quantity")


@query("select service_date, trip_id, stop_sequence, entity_id, report_epoch from sightings", "sightings")
def w2_first_sighting(spark, d):
    return V.sightings(spark, d).select(*GRAIN_COLUMNS, "entity_id", "report_epoch")


@query("select service_date, trip_id, stop_sequence, n_stopped_observations, last_stopped, observed_dwell_s from sightings", "sightings")
def w3_w4_dwell(spark, d):
    return V.sightings(spark, d).select(*GRAIN_COLUMNS, "n_stopped_observations", "last_stopped", "observed_dwell_s")


def _dim(spark, d, close_missing=False):
    """The timetable after its two snapshots; observation times are hours after the epoch, to compare as numbers."""
    one = S.upsert(None, V.snapshot(spark, d, False), V.KEYS, V.ATTRIBUTES, "1970-01-01 00:00:00")
    return S.upsert(one, V.snapshot(spark, d, True), V.KEYS, V.ATTRIBUTES, "1970-01-01 01:00:00", close_missing)


def _numbered(dim):
    """Validity as 0, 1 and 2 for the first, the second snapshot and no end."""
    n = lambda c: F.least(F.lit(2).cast("long"), F.floor(F.unix_timestamp(c) / 3600)).cast("long").alias(c)
    return dim.select(*V.KEYS, *V.ATTRIBUTES, n("valid_from"), n("valid_to"), "is_current")


@query("select k1, k2, row_number() over (partition by k1, k2 order by valid_from) as version, valid_from from dim", "dim")
def w5_version_ordinal(spark, d):
    out = _dim(spark, d).withColumn("version", F.row_number().over(Window.partitionBy(*V.KEYS).orderBy("valid_from")).cast("long"))
    return out.select(*V.KEYS, "version", F.floor(F.unix_timestamp("valid_from") / 3600).cast("long").alias("valid_from"))


@query("""select *, row_number() over (order by on_time_pct, agency, route_id) as worst_rank from (select agency, route_id, count(*) as n_arrivals, quantile_disc(delay_s, 0.5) as median_delay_s,
round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct, round(100 * avg(cast(delay_s > 300 as int)), 1) as late_pct from otp where delay_s is not null group by all having count(*) >= 50)""", "otp")  # fmt: skip
def w6_worst_routes(spark, d):
    return accuracy.worst_routes(V.otp(spark, d))


@query("""select user_id, island, count(*) as n, min(t) as t0, max(t) as t1 from (select *, cast(sum(s) over (partition by user_id order by t, event_id rows unbounded preceding) as bigint) as island from
(select user_id, event_id, epoch(ts)::bigint as t, case when epoch(ts)::bigint - lag(epoch(ts)::bigint) over (partition by user_id order by epoch(ts)::bigint, event_id) <= 7200 then 0 else 1 end as s
from (select user_id, event_id, date_trunc('second', ts) as ts from events))) group by all""")  # fmt: skip
def w7_gap_islands(spark, d):
    e = V.table(spark, d, "events").select("user_id", "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    return P.islands(e, ["user_id"], "t", 7200, ("event_id",)).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"))


@query("select entity_id, lag(current_status) over (partition by trip_id order by report_epoch, entity_id) as prev_current_status from positions", "positions")
def w8_prev_status(spark, d):
    return P.previous(V.positions(spark, d), "current_status", ["trip_id"], ["report_epoch", "entity_id"]).select("entity_id", "prev_current_status")


@query("""select entity_id, coalesce(current_status = lag(current_status) over w, false) or coalesce(report_epoch = lag(report_epoch) over w, false) as is_stale from positions window w as (partition by trip_id order by report_epoch, entity_id)""", "positions")
def w9_stale_feed(spark, d):
    return P.stale(V.positions(spark, d), ["current_status", "report_epoch"], ["trip_id"], ["report_epoch", "entity_id"]).select("entity_id", "is_stale")


@query("select entity_id, count(*) over (partition by trip_id order by report_epoch range between 86400 preceding and current row) as recent from positions", "positions")
def w10_sliding_count(spark, d):
    return P.sliding_count(V.positions(spark, d), ["trip_id"], "report_epoch", 86400).select("entity_id", "recent")


# Joins


@query("select o_orderkey, k2, q, valid_from from (select o_orderkey, case when o_orderdate < timestamp '1997-01-01' then 0 else 1 end as at from orders) o left join dim on o.o_orderkey = dim.k1 and dim.valid_from <= o.at and o.at < dim.valid_to", "dim")
def j1_asof_left(spark, d):
    o = V.table(spark, d, "orders").withColumn("at", F.when(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"), F.timestamp_seconds(F.lit(0))).otherwise(F.timestamp_seconds(F.lit(3600))))
    dim = _dim(spark, d).withColumn("vf", F.floor(F.unix_timestamp("valid_from") / 3600).cast("long"))
    return S.as_of(o, dim, {"o_orderkey": "k1"}, "at", ["k2", "q", "vf"]).select("o_orderkey", "k2", "q", F.col("vf").alias("valid_from"))


@query("select count(*) as n_facts, count(*) as n_joined, count(q) as n_matched from (select event_id, (select q from dim where k1 = event_id and k2 = 1 and valid_from <= 1 and 1 < valid_to) as q from events)", "dim")
def q2_join_conservation(spark, d):
    e = V.table(spark, d, "events").select("event_id", F.lit(1).cast("long").alias("line"), F.timestamp_seconds(F.lit(3600)).alias("at"))
    out = S.as_of(e, _dim(spark, d), {"event_id": "k1", "line": "k2"}, "at", ["q"])
    n = e.agg(F.count(F.lit(1)).alias("n_facts"))
    return out.agg(F.count(F.lit(1)).alias("n_joined"), F.count("q").alias("n_matched")).join(F.broadcast(n)).select("n_facts", "n_joined", "n_matched")  # one row each


@query("select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, o_orderpriority, o_orderkey is null as orphan from lineitem left join (select * from orders where o_orderkey % 10 <> 0) on l_orderkey = o_orderkey")
def j2_left_orphans(spark, d):
    o = V.table(spark, d, "orders").where("o_orderkey % 10 <> 0")
    return V.table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "o_orderpriority", F.col("o_orderkey").isNull().alias("orphan"))


@query("select change, count(*) as n from changes group by all", "changes")
def j3_change_detection(spark, d):
    return S.classify(V.snapshot(spark, d, True), V.snapshot(spark, d, False), V.KEYS, V.ATTRIBUTES).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("select a.entity_id, b.n from positions a join (select stop_sequence, count(*) as n from positions group by all) b on a.stop_sequence is not distinct from b.stop_sequence", "positions")
def j4_nullsafe(spark, d):
    p = V.positions(spark, d)
    n = p.groupBy("stop_sequence").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("stop_sequence", "s")
    return p.join(n, F.col("stop_sequence").eqNullSafe(F.col("s"))).select("entity_id", "n")


@query("select service_date, trip_id, stop_sequence, issued, predicted, actual, lead_s, error_s, lead_bucket from pairs", "pairs")
def j5_prediction_pairs(spark, d):
    return accuracy.pairs(V.predictions(spark, d), V.arrivals(spark, d)).drop("lead_order")


@query("select entity_id from positions semi join (select service_date, trip_id, stop_sequence from sightings) using (service_date, trip_id, stop_sequence)", "sightings")
def j6_broadcast_semi(spark, d):
    return V.positions(spark, d).join(V.sightings(spark, d).select(*GRAIN_COLUMNS), GRAIN_COLUMNS, "left_semi").select("entity_id")


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1)")
def j7_anti(spark, d):
    done = V.table(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return T.unprocessed(V.table(spark, d, "orders"), done, "o_orderkey").select("o_orderkey")


# Tables and history


@query("""select service_date, trip_id, stop_sequence, min(report_epoch) as report_epoch from stopped group by all""", "stopped")
def k3_merge_earliest(spark, d):
    p = V.positions(spark, d).where(P.resolvable()).select(*GRAIN_COLUMNS, "report_epoch", "entity_id")
    first = lambda x: P.first_sightings(x).select(*GRAIN_COLUMNS, "report_epoch", "entity_id")
    odd, even = first(p.where("entity_id % 2 = 1")), first(p.where("entity_id % 2 = 0"))
    merged = T.merge_earliest(odd, even, GRAIN_COLUMNS, "report_epoch", ("entity_id",))
    return T.merge_earliest(merged, even, GRAIN_COLUMNS, "report_epoch", ("entity_id",)).select(*GRAIN_COLUMNS, "report_epoch")


@query("""select count(a.t) as n_before, count(*) filter (a.t is null) as n_inserted, count(*) filter (b.t < a.t) as n_updated, count(*) as n_after
from (select service_date, trip_id, stop_sequence, min(report_epoch) as t from stopped where entity_id % 2 = 1 group by all) a
full join (select service_date, trip_id, stop_sequence, min(report_epoch) as t from stopped where entity_id % 2 = 0 group by all) b using (service_date, trip_id, stop_sequence)""", "stopped")  # fmt: skip
def k3_merge_counts(spark, d):
    p = V.positions(spark, d).where(P.resolvable())
    return T.merge_counts(P.first_sightings(p.where("entity_id % 2 = 1")), p.where("entity_id % 2 = 0"), GRAIN_COLUMNS, "report_epoch")


@query("select * from dim", "dim")
def k4_scd2_upsert(spark, d):
    return _numbered(_dim(spark, d))


@query("""select k1, k2, q, dsc, rf, valid_from, case when change = 'missing' and valid_from = 0 then 1 else valid_to end as valid_to, is_current and change <> 'missing' as is_current from dim join changes using (k1, k2)""", "dim")
def k5_scd2_close_missing(spark, d):
    return _numbered(_dim(spark, d, close_missing=True))


@query("select case when current_status is null then 'quarantine' else 'rows' end as sink, count(*) as n from positions group by all", "positions")
def k6_quarantine(spark, d):
    p = V.positions(spark, d).withColumn("decode_error", F.when(F.col("current_status").isNull(), F.lit("no status")))
    return p.groupBy(F.when(F.col("decode_error").isNull(), "rows").otherwise("quarantine").alias("sink")).agg(F.count(F.lit(1)).alias("n"))


# Aggregations


@query("""select agency, count(*) as n_arrivals, count(distinct route_id) as n_routes, count(distinct service_date) as n_service_days, quantile_disc(delay_s, 0.5) as median_delay_s, round(avg(delay_s), 1) as mean_delay_s, quantile_disc(delay_s, 0.9) as p90_delay_s,
round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct, round(100 * avg(cast(delay_s < -60 as int)), 1) as early_pct, round(100 * avg(cast(delay_s > 300 as int)), 1) as late_pct, max(poll_interval_s) as poll_interval_s,
round(100 * avg(cast(valid_from_assumed as int)), 1) as assumed_schedule_pct from otp where delay_s is not null group by all having count(*) >= 10""", "otp")  # fmt: skip
def a1_a5_agency_mart(spark, d):
    return accuracy.agency_mart(V.otp(spark, d), floor=10)


ROUTE_HOUR = "select agency, route_id, hour_local, count(*) as n_arrivals, quantile_disc(delay_s, 0.5) as median_delay_s, round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct, round(100 * avg(cast(delay_s > 300 as int)), 1) as late_pct from otp where delay_s is not null group by all having count(*) >= 3"


@query(ROUTE_HOUR, "otp")
def a6_route_hour(spark, d):
    return accuracy.route_hour_mart(V.otp(spark, d), floor=3)


@query(f"select hour_local, cast(sum(n_arrivals) as bigint) as n_arrivals, round(sum(on_time_pct * n_arrivals) / sum(n_arrivals), 1) as on_time_pct, round(sum(late_pct * n_arrivals) / sum(n_arrivals), 1) as late_pct from ({ROUTE_HOUR}) group by all", "otp")
def a7_weighted_hour(spark, d):
    return accuracy.hourly(accuracy.route_hour_mart(V.otp(spark, d), floor=3))


SUMMARY = """count(*) as n, round(avg(error_s), 1) as mean_error_s, quantile_cont(error_s, 0.5) as median_error_s, quantile_cont(abs(error_s), 0.5) as median_abs_error_s,
list_sort(list(abs(error_s)))[cast(floor(0.9 * (count(*) - 1)) as bigint) + 1] as p90_abs_error_s, round(100 * avg(cast(abs(error_s) <= 60 as int)), 1) as pct_within_60s, round(100 * avg(cast(abs(error_s) <= 180 as int)), 1) as pct_within_180s"""


@query(f"select lead_bucket, {SUMMARY} from pairs group by lead_bucket", "pairs")
def a8_accuracy_by_bucket(spark, d):
    return accuracy.summarize(accuracy.pairs(V.predictions(spark, d), V.arrivals(spark, d)), ["lead_bucket", "lead_order"]).orderBy("lead_order").drop("lead_order")


def _pairs_by_route(spark, d):
    p = accuracy.pairs(V.predictions(spark, d), V.arrivals(spark, d))
    user = F.split_part("trip_id", F.lit("T"), F.lit(2)).cast("long")
    return p.withColumns({"route_id": F.concat(F.split_part("trip_id", F.lit(":"), F.lit(1)), F.lit(":R"), user % 7), "hour": F.hour(X.local(F.timestamp_seconds("actual"))).cast("long")})


BY_ROUTE = "(select *, split_part(trip_id, ':', 1) || ':R' || (cast(split_part(trip_id, 'T', 2) as bigint) % 7) as route_id, cast(hour(timezone('America/Los_Angeles', timezone('UTC', make_timestamp(actual * 1000000)))) as bigint) as hour from pairs)"


@query(f"select route_id, {SUMMARY} from {BY_ROUTE} group by route_id", "pairs")
def a8_by_route(spark, d):
    return accuracy.summarize(_pairs_by_route(spark, d), ["route_id"])


@query(f"select route_id, hour, lead_bucket, {SUMMARY} from {BY_ROUTE} group by route_id, hour, lead_bucket", "pairs")
def a8_by_route_hour(spark, d):
    return accuracy.summarize(_pairs_by_route(spark, d), ["route_id", "hour", "lead_bucket"])


@query(f"select route_id, {SUMMARY} from {BY_ROUTE} group by route_id order by n desc, route_id limit 10", "pairs")
def t2_top10_routes(spark, d):
    return accuracy.summarize(_pairs_by_route(spark, d), ["route_id"]).orderBy(F.desc("n"), "route_id").limit(10)


@query("select count(p.issued) as n_pairs, count(*) filter (p.issued < s.report_epoch) as n_scored, count(*) filter (p.issued >= s.report_epoch) as n_hindsight, count(*) filter (p.issued is null) as n_unmatched_arrivals from sightings s left join predictions p using (service_date, trip_id, stop_sequence)", "predictions", "sightings")
def f6_hindsight(spark, d):
    return accuracy.hindsight(V.predictions(spark, d), V.arrivals(spark, d))


@query("select split_part(trip_id, ':', 1) as agency, count(*) as n, round(100.0 * count(current_status) / count(*), 2) as status_pct, round(100.0 * count(stop_sequence) / count(*), 2) as sequence_pct, count(distinct trip_id || '|' || report_epoch) as n_pairs, 100.0 * count(current_status) / count(*) > 50 and 100.0 * count(stop_sequence) / count(*) > 50 and count(*) filter (current_status = 'STOPPED_AT') > 0 as resolver_a from positions group by all", "positions")
def a10_population(spark, d):
    pct = lambda c: 100.0 * F.count(c) / F.count(F.lit(1))
    can = (pct("current_status") > 50) & (pct("stop_sequence") > 50) & (F.count_if(F.col("current_status") == "STOPPED_AT") > 0)
    out = V.positions(spark, d).groupBy(X.agency_of(F.col("trip_id")).alias("agency"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.round(pct("current_status"), 2).alias("status_pct"), F.round(pct("stop_sequence"), 2).alias("sequence_pct"), F.countDistinct("trip_id", "report_epoch").alias("n_pairs"), can.alias("resolver_a"))


@query("select split_part(trip_id, ':', 1) as agency, count(*) filter (stop_sequence is null) as n_absent, count(*) filter (stop_sequence = 0) as n_zero, count(*) filter (stop_sequence <> 0) as n_other from positions group by all", "positions")
def a11_tristate(spark, d):
    s = F.col("stop_sequence")
    return V.positions(spark, d).groupBy(X.agency_of(F.col("trip_id")).alias("agency")).agg(F.count_if(s.isNull()).alias("n_absent"), F.count_if(s == 0).alias("n_zero"), F.count_if(s != 0).alias("n_other"))


@query("select n_name, round(avg(n), 4) as mean_fanout, max(n) as max_fanout from (select *, row_number() over (partition by o_custkey order by o_orderkey) as rn from (select o_custkey, o_orderkey, count(*) as n from orders join lineitem on o_orderkey = l_orderkey group by all)) join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where rn = 1 group by all")
def a12_fanout(spark, d):
    n = V.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    first = V.table(spark, d, "orders").join(n, "o_orderkey").groupBy("o_custkey").agg(F.min_by("n", "o_orderkey").alias("n"))
    out = first.join(V.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(V.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return out.groupBy("n_name").agg(F.round(F.avg("n"), 4).alias("mean_fanout"), F.max("n").alias("max_fanout"))


@query("select trip_id, route_id, count(distinct stop_sequence) as n_sequences from positions where route_id is not null group by all having count(distinct stop_sequence) > 1", "positions")
def a13_loops(spark, d):
    return P.loops(V.positions(spark, d), ["trip_id"], "route_id", "stop_sequence")


@query("select count(*) as n_polls, count(distinct value) as n_payloads, round(100.0 * (count(*) - count(distinct value)) / count(*), 2) as duplicate_pct from events")
def a14_freshness(spark, d):
    n, u = F.count(F.lit(1)), F.countDistinct("value")
    return V.table(spark, d, "events").agg(n.alias("n_polls"), u.alias("n_payloads"), F.round(100.0 * (n - u) / n, 2).alias("duplicate_pct"))


@query("select split_part(trip_id, ':', 1) as agency, case when trip_id is null then 'no_trip' when current_status is distinct from 'STOPPED_AT' then 'no_status' when stop_sequence is null then 'no_sequence' when report_epoch is null then 'no_event_ts' else 'kept' end as reason, count(*) as n from positions group by all", "positions")
def a15_skip_reasons(spark, d):
    return V.positions(spark, d).groupBy(X.agency_of(F.col("trip_id")).alias("agency"), F.coalesce(P.skip_reason(), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("select min(report_epoch) as first_epoch, max(report_epoch) as last_epoch, count(*) as n from sightings", "sightings")
def a19_window(spark, d):
    return V.sightings(spark, d).agg(F.min("report_epoch").alias("first_epoch"), F.max("report_epoch").alias("last_epoch"), F.count(F.lit(1)).alias("n"))


@query("select max(report_epoch) as newest from positions having max(report_epoch) < 1800000000 - 72 * 3600", "positions")
def a20_freshness(spark, d):
    V.positions(spark, d).createOrReplaceTempView("headway_positions")
    return spark.sql("select max(report_epoch) as newest from headway_positions having max(report_epoch) < :now - 72 * 3600", args={"now": 1800000000})


# Set operations, sorts


@query("select event_id as id, 'e' as kind from events union all select o_orderkey, 'o' from orders")
def u1_union(spark, d):
    return V.table(spark, d, "events").select(F.col("event_id").alias("id"), F.lit("e").alias("kind")).unionByName(V.table(spark, d, "orders").select(F.lit("o").alias("kind"), F.col("o_orderkey").alias("id")))


@query("select distinct service_date, trip_id from positions", "positions")
def u3_distinct(spark, d):
    return V.positions(spark, d).select("service_date", "trip_id").distinct()


@query("select l_orderkey from lineitem where l_shipdate < timestamp '1998-01-01' intersect select l_orderkey from lineitem where l_shipdate >= timestamp '1998-01-01'")
def u5_intersect(spark, d):
    i, cut = V.table(spark, d, "lineitem"), F.lit("1998-01-01").cast("timestamp_ntz")
    return i.where(F.col("l_shipdate") < cut).select("l_orderkey").intersect(i.where(F.col("l_shipdate") >= cut).select("l_orderkey"))


@query("select l_orderkey from lineitem where l_shipdate >= timestamp '1998-01-01' except select l_orderkey from lineitem where l_shipdate < timestamp '1998-01-01'")
def u6_except(spark, d):
    i, cut = V.table(spark, d, "lineitem"), F.lit("1998-01-01").cast("timestamp_ntz")
    return i.where(F.col("l_shipdate") >= cut).select("l_orderkey").subtract(i.where(F.col("l_shipdate") < cut).select("l_orderkey"))


@query("select count(*) as n_rows, count(distinct l_orderkey || '|' || l_linenumber) as n_distinct, count(*) - count(distinct l_orderkey || '|' || l_linenumber) as n_collapsed from lineitem")
def u7_dedup_counts(spark, d):
    u = F.countDistinct("l_orderkey", "l_linenumber")
    return V.table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"), u.alias("n_distinct"), (F.count(F.lit(1)) - u).alias("n_collapsed"))


@query("select t, feed, entity_id from (select report_epoch as t, 'trip_updates' as feed, entity_id from positions where current_status <> 'STOPPED_AT' union all select report_epoch, 'vehicle_positions', entity_id from positions where current_status = 'STOPPED_AT') order by t, feed, entity_id", "positions")
def t1_replay_order(spark, d):
    p = V.positions(spark, d).select(F.col("report_epoch").alias("t"), F.when(F.col("current_status") == "STOPPED_AT", "vehicle_positions").otherwise("trip_updates").alias("feed"), "entity_id", "current_status")
    return p.where("current_status is not null").drop("current_status").orderBy("t", "feed", "entity_id")


@query("select current_status, count(*) as n from positions group by all order by n desc, current_status", "positions")
def t7_status_counts(spark, d):
    return V.positions(spark, d).groupBy("current_status").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "current_status")


# Scalar functions


@query("""select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, case when regexp_matches(trim(t), '^[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]$') then cast(split_part(trim(t), ':', 1) as bigint) * 3600 + cast(split_part(trim(t), ':', 2) as bigint) * 60 + cast(split_part(trim(t), ':', 3) as bigint) end as seconds
from (select *, case when l_orderkey % 13 = 0 then null when l_orderkey % 7 = 0 then 'not a time' when l_orderkey % 5 = 0 then ' ' || cast(l_quantity as int) || ':0' || l_linenumber || ':61' else ' ' || cast(l_quantity as int) || ':0' || l_linenumber || ':5' || (l_orderkey % 10) || ' ' end as t from lineitem)""")  # fmt: skip
def s_gtfs_seconds(spark, d):
    k, q, n = F.col("l_orderkey"), F.col("l_quantity").cast("int"), F.col("l_linenumber")
    t = F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("not a time")).when(k % 5 == 0, F.concat(F.lit(" "), q, F.lit(":0"), n, F.lit(":61"))).otherwise(F.concat(F.lit(" "), q, F.lit(":0"), n, F.lit(":5"), k % 10, F.lit(" ")))
    return V.table(spark, d, "lineitem").select("l_orderkey", n.cast("long").alias("l_linenumber"), "l_partkey", X.gtfs_seconds(t).alias("seconds"))


@query("""select service_date, cast(epoch(timezone('America/Los_Angeles', strptime(service_date || ' 12:00:00', '%Y%m%d %H:%M:%S'))) as bigint) - 43200 as start_epoch
from (select distinct strftime(o_orderdate, '%Y%m%d') as service_date from orders union select unnest(['20260308', '20261101', '20260806'])) union all select 'junk', null""")  # fmt: skip
def s_service_day_start(spark, d):
    days = V.table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("service_date")).union(spark.createDataFrame([("20260308",), ("20261101",), ("20260806",), ("junk",)], "service_date string")).distinct()
    return days.select("service_date", X.service_day_start(F.col("service_date")).alias("start_epoch"))


@query("select entity_id, delay_s, delay_s between -60 and 300 as is_on_time from otp", "otp")
def s_delay_on_time(spark, d):
    return V.otp(spark, d).select("entity_id", "delay_s", X.on_time(F.col("delay_s")).alias("is_on_time"))


@query("select entity_id, substr(sha256('vehicle_positions|' || report_epoch || '|' || entity_id || '|' || coalesce(cast(stop_sequence as varchar), 'None')), 1, 32) as row_key, coalesce(service_date, 'nodate') || ':' || coalesce(trip_id, 'notrip') as event_key from positions", "positions")
def s_row_keys(spark, d):
    return V.positions(spark, d).select("entity_id", X.dedup_key(F.lit("vehicle_positions"), F.col("report_epoch"), F.col("entity_id"), F.col("stop_sequence")).alias("row_key"), X.partition_key(F.col("service_date"), F.col("trip_id")).alias("event_key"))


# Checks


@query("select count(*) as n, count(distinct (service_date, trip_id, stop_sequence)) as n_distinct, count(*) = count(distinct (service_date, trip_id, stop_sequence)) as ok from sightings", "sightings")
def q1_grain(spark, d):
    u = F.countDistinct(*GRAIN_COLUMNS)
    return V.sightings(spark, d).agg(F.count(F.lit(1)).alias("n"), u.alias("n_distinct"), (F.count(F.lit(1)) == u).alias("ok"))


@query("select count(*) as n_keys, count(*) filter (n <> 1) as n_bad from (select k1, k2, count(*) filter (is_current) as n from dim group by all)", "dim")
def q3_one_current(spark, d):
    n = _dim(spark, d).groupBy(*V.KEYS).agg(F.count_if("is_current").alias("n"))
    return n.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") != 1).alias("n_bad"))


@query("select count(*) as n_gaps from (select valid_to, lead(valid_from) over (partition by k1, k2 order by valid_from) as nxt from dim) where nxt is not null and nxt <> valid_to", "dim")
def q7_windows_tile(spark, d):
    return S.gaps(_dim(spark, d), V.KEYS).agg(F.count(F.lit(1)).alias("n_gaps"))


@query("select count(*) as n, count(*) filter (observed_dwell_s < 0) as n_negative_dwell, count(*) filter (stop_sequence = 0) > 0 as has_zero, (select count(*) > 0 from positions where stop_sequence is null) as has_null from sightings", "sightings", "positions")
def q6_bounds(spark, d):
    has = V.positions(spark, d).agg((F.count_if(F.col("stop_sequence").isNull()) > 0).alias("has_null"))
    out = V.sightings(spark, d).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("observed_dwell_s") < 0).alias("n_negative_dwell"), (F.count_if(F.col("stop_sequence") == 0) > 0).alias("has_zero"))
    return out.join(F.broadcast(has))  # one row each


@query("select count(*) filter (o_orderkey is null) as n_orphans, count(*) as n from lineitem left join (select * from orders where o_orderkey % 10 <> 0) on l_orderkey = o_orderkey")
def q8_orphans(spark, d):
    return j2_left_orphans(spark, d).agg(F.count_if("orphan").alias("n_orphans"), F.count(F.lit(1)).alias("n"))
