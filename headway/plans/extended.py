"""Registered queries of decoding, contracts, checks, learning and streams."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from headway.functions import expressions as X
from headway.ml import eta
from headway.operators import accuracy, tables as T
from headway.plans.catalog import GRAIN_COLUMNS, query
from headway.quality import contracts, expectations as E
from headway.sources import feed, views as V
from headway.streaming import jobs

# Decoding: positions are written as feed payloads, one for each hour, and read back.


def payloads(positions):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        f = feed.message()()
        f.header.gtfs_realtime_version = "2.0"
        f.header.timestamp = key[0].as_py() * 3600
        for r in table.to_pylist():
            e = f.entity.add(id=str(r["entity_id"]))
            e.vehicle.trip.trip_id, e.vehicle.trip.start_date, e.vehicle.timestamp = r["trip_id"], r["service_date"], r["report_epoch"]
            if r["stop_sequence"] is not None:
                e.vehicle.current_stop_sequence = r["stop_sequence"]
            if r["current_status"] is not None:
                e.vehicle.current_status = feed.ENUMS["status"].index(r["current_status"])
        raw = f.SerializeToString()
        return pa.table({"path": [f"raw/vehicle_positions/ingest_dt=x/{key[0].as_py() * 3600:010d}-0123abcd.pb.gz"], "content": [raw]}, pa.schema([("path", pa.string()), ("content", pa.binary())]))

    rows = positions.withColumn("poll", F.floor(F.col("report_epoch") / 3600)).groupBy("poll").applyInArrow(run, "path string, content binary")
    return rows.withColumn("poll_epoch", X.poll_epoch(F.col("path")))


@query("select cast(entity_id as varchar) as entity_id, trip_id, service_date, stop_sequence, current_status, report_epoch, report_epoch // 3600 * 3600 as poll_epoch from positions", "positions")
def s3_decode(spark, d):
    rows = feed.decoded(payloads(V.positions(spark, d)), "vehicle_positions")
    return feed.split(rows)[0].select("entity_id", "trip_id", "service_date", F.col("current_stop_sequence").cast("long").alias("stop_sequence"), "current_status", F.col("vehicle_report_ts_epoch").alias("report_epoch"), "poll_epoch")


# Contracts

def spoiled(positions):
    return positions.withColumns({"report_epoch": F.when(F.col("entity_id") % 50 == 0, 0).otherwise(F.col("report_epoch")), "service_date": F.when(F.col("entity_id") % 70 == 0, "2024-01-01").otherwise(F.col("service_date")), "latitude": (F.col("entity_id") % 101 - 5).cast("double")})


REASONS = "list_filter([case when entity_id % 70 = 0 then 'service_date is not YYYYMMDD' end, case when entity_id % 50 = 0 then 'report_epoch is not above zero' end, case when entity_id % 101 - 5 > 90 then 'latitude is out of range' end], lambda x: x is not null)"


def _checked(spark, d):
    return contracts.violations(spoiled(V.positions(spark, d)))


@query(f"select entity_id, len({REASONS}) = 0 as valid, array_to_string({REASONS}, '; ') as reasons from positions", "positions")
def f10_contract_split(spark, d):
    return _checked(spark, d).select("entity_id", (F.size("violations") == 0).alias("valid"), F.array_join("violations", "; ").alias("reasons"))


@query(f"select entity_id, 'vehicle_positions' as topic, 'contract_violation' as reason, array_to_string({REASONS}, '; ') as error, '1.0.0' as contract_version from positions where len({REASONS}) > 0", "positions")
def k10_dead_letter(spark, d):
    bad = contracts.split(spoiled(V.positions(spark, d)))[1]
    out = contracts.dead_letters(bad, "vehicle_positions", "2024-02-01 00:00:00")
    return out.select(F.get_json_object("raw", "$.entity_id").cast("long").alias("entity_id"), "topic", "reason", "error", "contract_version")


@query("select service_date || ':' || trip_id as key, entity_id, current_status from positions", "positions")
def k9_keyed_publish(spark, d):
    p = V.positions(spark, d)
    e = contracts.event(p, ["report_epoch"], ["service_date", "trip_id"], ["entity_id", "current_status"])
    log = contracts.keyed(e, X.partition_key(F.col("trip.service_date"), F.col("trip.trip_id")))
    back = F.from_json("value", "envelope struct<report_epoch:long>, trip struct<service_date:string,trip_id:string>, entity_id long, current_status string")
    return log.select("key", back.alias("e")).select("key", "e.entity_id", "e.current_status")


@query("select service_date, trip_id, stop_sequence, count(*) as n from (select * from stopped union all select * from stopped where entity_id % 2 = 0) group by all", "stopped")
def k1_append_versions(spark, d):
    p = V.positions(spark, d).where("current_status = 'STOPPED_AT' and stop_sequence is not null").select(*GRAIN_COLUMNS, "entity_id")
    t = T.VersionedTable(spark, jobs.shared(spark, "bronze"))
    t.append(p, ["service_date"])
    t.append(p.where("entity_id % 2 = 0"), ["service_date"])
    return t.read().groupBy(*GRAIN_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


@query("select 0 as version, count(*) as n from positions union all select 1, count(*) from positions where entity_id % 3 = 0", "positions")
def s9_time_travel(spark, d):
    t = T.VersionedTable(spark, jobs.shared(spark, "travel"))
    t.overwrite(V.positions(spark, d))
    t.overwrite(t.read().where("entity_id % 3 = 0"))
    n = lambda v: t.read(v).agg(F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("n"))
    return n(0).unionAll(n(1))


@query("""select 'trip_id not null' as name, 'PASS' as status, 0.0 as measured, count(*) as n from sightings union all select 'stop_sequence accepted', 'PASS', 0.0, count(*) from sightings
union all select 'service_date+trip_id+stop_sequence unique', 'PASS', 0.0, count(*) from sightings union all select 'too few', 'UNMEASURED', 0.0, count(*) from sightings
union all select 'report_epoch in range', 'PASS', 0.0, count(*) from sightings union all select 'negative dwell', 'PASS', 0.0, count(*) from sightings union all select 'arrivals', 'INFO', cast(count(*) as double), count(*) from sightings""", "sightings")
def q4_expectations(spark, d):
    s = V.sightings(spark, d)
    return E.report(E.not_null(s, "trip_id"), E.accepted_values(s, "stop_sequence", [0, 1, 2]), E.unique(s, GRAIN_COLUMNS), E.none_violate(s, "too few", F.lit(False), floor=10**9), E.accepted_range(s, "report_epoch", 1, 4102444800), E.share_below(s, "negative dwell", F.col("observed_dwell_s") < 0, 0.01), E.info(s, "arrivals", F.count(F.lit(1))))


# Learning


def _features(spark, d):
    return eta.features(V.predictions(spark, d), V.arrivals(spark, d))


@query("select service_date, trip_id, stop_sequence, issued, horizon_s, residual_s, cast(hour(t) as bigint) as hour, cast((dayofweek(t) + 6) % 7 as bigint) as dow from (select *, timezone('America/Los_Angeles', timezone('UTC', make_timestamp(issued * 1000000))) as t from features)", "features")
def m1_features(spark, d):
    return _features(spark, d).select(*GRAIN_COLUMNS, "issued", "horizon_s", "residual_s", F.col("hour").cast("long").alias("hour"), F.col("dow").cast("long").alias("dow"))


SPLIT = "(select *, issued >= (select quantile_disc(issued, 0.75) from features) as in_test from features)"


@query(f"select in_test, count(*) as n, min(issued) as first_issued, max(issued) as last_issued from {SPLIT} group by all", "features")
def m3_temporal_split(spark, d):
    train, test = eta.temporal_split(_features(spark, d))
    both = train.withColumn("in_test", F.lit(False)).unionByName(test.withColumn("in_test", F.lit(True)))
    return both.groupBy("in_test").agg(F.count(F.lit(1)).alias("n"), F.min("issued").alias("first_issued"), F.max("issued").alias("last_issued"))


@query("select * from (values ('agency_delay_s', 'all null'), ('agency_delay_known', 'constant'), ('uncertainty', 'all null')) t(feature, reason)")
def m4_degenerate_features(spark, d):
    train, test = eta.temporal_split(_features(spark, d))
    return eta.degenerate(train, test, ["horizon_s", "agency_delay_s", "agency_delay_known", "uncertainty", "stop_sequence_f"])


BUCKET = "case when horizon_s >= 1200 then '20+ min' when horizon_s >= 600 then '10-20 min' when horizon_s >= 300 then '5-10 min' when horizon_s >= 120 then '2-5 min' else '0-2 min' end"
BASE = f"""(select t.*, 0.0 as by_agency, m.x as by_mean, coalesce(b.x, m.x) as by_bucket from (select *, {BUCKET} as bucket from {SPLIT} where in_test) t left join (select {BUCKET} as bucket, avg(residual_s) as x from {SPLIT} where not in_test group by 1) b using (bucket), (select avg(residual_s) as x from {SPLIT} where not in_test) m)"""


def _baselines(spark, d):
    return eta.baselines(*eta.temporal_split(_features(spark, d)))


@query(f"select service_date, trip_id, stop_sequence, issued, predicted, round(by_mean, 4) as by_mean, round(by_bucket, 4) as by_bucket from {BASE}", "features")
def a18_bucket_baseline(spark, d):
    return _baselines(spark, d).select(*GRAIN_COLUMNS, "issued", "predicted", F.round("by_mean", 4).alias("by_mean"), F.round("by_bucket", 4).alias("by_bucket"))


METRICS = """count(*) as n, round(avg(abs(e)), 4) as mae, round(sqrt(avg(e * e)), 4) as rmse, round(avg(e), 4) as bias, round(quantile_cont(abs(e), 0.9), 4) as p90, round(100 * avg(cast(abs(e) <= 60 as int)), 4) as pct_60s, round(100 * avg(cast(abs(e) <= 180 as int)), 4) as pct_180s"""


def _rounded(df, *keep):
    return df.select(*keep, "n", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "bias", "p90", "pct_60s", "pct_180s")])


@query(f"select {METRICS} from (select residual_s - by_bucket as e from {BASE})", "features")
def a17_metrics(spark, d):
    return _rounded(eta.metrics(_baselines(spark, d), F.col("residual_s") - F.col("by_bucket")))


@query(f"select bucket, {METRICS} from (select bucket, cast(residual_s as double) as e from {BASE}) group by bucket", "features")
def m7_per_horizon(spark, d):
    return _rounded(eta.metrics(_baselines(spark, d), F.col("residual_s"), ["bucket"]), "bucket")


@query("""select count(*) as n, round(avg(residual_s), 4) as mean_s, min(residual_s) as min_s, max(residual_s) as max_s, list_sort(list(residual_s))[count(*) // 2 + 1] as mid_s, list_sort(list(residual_s))[cast(floor(0.1 * count(*)) as bigint) + 1] as p10_s,
list_sort(list(residual_s))[cast(floor(0.9 * count(*)) as bigint) + 1] as p90_s, count(distinct trip_id) as n_trips from features""", "features")  # fmt: skip
def a16_residuals(spark, d):
    rows = _features(spark, d)
    ranks = accuracy.by_value(rows, [], F.col("residual_s"))
    at = lambda k: accuracy.at_rank(F.floor(k))
    n = F.sum("n")
    found = ranks.agg(n.alias("n"), F.round(F.sum(F.col("v") * F.col("n")) / n, 4).alias("mean_s"), F.min("v").alias("min_s"), F.max("v").alias("max_s"), at(F.col("total") / 2).alias("mid_s"), at(0.1 * F.col("total")).alias("p10_s"), at(0.9 * F.col("total")).alias("p90_s"))
    return found.join(F.broadcast(rows.agg(F.countDistinct("trip_id").alias("n_trips"))))  # one row each


MODEL = ["horizon_s", "hour", "dow", "stop_sequence_f"]


def _scored(spark, d):
    train, test = eta.temporal_split(_features(spark, d))
    model = eta.train_model(train, MODEL)
    return eta.predict(model, eta.baselines(train, test), MODEL)


@query()
def m6_model(spark, d):
    return eta.metrics(_scored(spark, d), F.col("residual_s") - F.col("residual_hat"))


@query()
def m8_fallback(spark, d):
    scored = _scored(spark, d).persist()
    gate = eta.baseline_gate(scored)
    return eta.correct(scored, gate).select(*GRAIN_COLUMNS, "issued", "predicted", "corrected", "source")


# Streams


def _stream(spark, d):
    return V.shape_positions(jobs.files_of(spark, f"{d.rstrip('/')}/events.parquet"))


@query("select service_date, trip_id, stop_sequence, entity_id, report_epoch, last_stopped from sightings", "sightings")
def r2_resolver_stream(spark, d):
    t = T.VersionedTable(spark, jobs.shared(spark, "arrivals"))
    jobs.resolve(_stream(spark, d), t)
    return t.read()


@query("select service_date, trip_id, stop_sequence, entity_id, report_epoch, prev_status from sightings join (select entity_id, lag(current_status) over (partition by service_date, trip_id order by report_epoch, entity_id) as prev_status from positions) using (entity_id)", "sightings")
def r2_resolver_status(spark, d):
    arrivals, state = (T.VersionedTable(spark, jobs.shared(spark, n)) for n in ("arrivals", "state"))
    jobs.resolve_with_status(_stream(spark, d), arrivals, state)
    return arrivals.read()


@query("select p.service_date, p.trip_id, p.stop_sequence, issued, predicted, s.report_epoch as actual, predicted - s.report_epoch as error_s from (select *, report_epoch as issued, report_epoch + cast(floor(value * 60) as bigint) as predicted from positions where current_status in ('IN_TRANSIT_TO', 'INCOMING_AT') and stop_sequence is not null) p join stopped s using (service_date, trip_id, stop_sequence) where issued < s.report_epoch and s.report_epoch <= issued + 86400", "stopped")
def r4_stream_join(spark, d):
    p = _stream(spark, d).where("current_status in ('IN_TRANSIT_TO', 'INCOMING_AT') and stop_sequence is not null")
    p = p.select(*GRAIN_COLUMNS, F.col("report_epoch").alias("issued"), (F.col("report_epoch") + F.floor(F.col("value") * 60).cast("long")).alias("predicted"))
    a = _stream(spark, d).where("current_status = 'STOPPED_AT' and stop_sequence is not null").withColumnRenamed("report_epoch", "actual")
    return jobs.collected(jobs.score(p, a))


@query("select distinct service_date, trip_id, stop_sequence from stopped", "stopped")
def r5_stream_dedup(spark, d):
    return jobs.collected(jobs.once(_stream(spark, d).where("current_status = 'STOPPED_AT' and stop_sequence is not null")).select(*GRAIN_COLUMNS))


@query("select split_part(trip_id, ':', 1) as agency, report_epoch // 86400 * 86400 as start_epoch, count(*) as n from positions group by all", "positions")
def r11_tumbling(spark, d):
    return jobs.collected(jobs.tumbling(_stream(spark, d)), "update", ("agency", "start_epoch"))


@query("select split_part(trip_id, ':', 1) as agency, (report_epoch // 43200 - k) * 43200 as start_epoch, count(*) as n from positions, (values (0), (1)) t(k) group by all", "positions")
def r12_sliding(spark, d):
    return jobs.collected(jobs.sliding(_stream(spark, d), "24 hours", "12 hours"), "update", ("agency", "start_epoch"))


@query("""select trip_id, min(report_epoch) as start_epoch, count(*) as n from (select *, sum(s) over (partition by trip_id order by report_epoch, entity_id rows unbounded preceding) as run from
(select *, case when report_epoch - lag(report_epoch) over (partition by trip_id order by report_epoch, entity_id) < 7200 then 0 else 1 end as s from positions)) group by trip_id, run""", "positions")  # fmt: skip
def r13_session(spark, d):
    return jobs.collected(jobs.sessions(_stream(spark, d)), "complete")
