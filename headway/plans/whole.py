"""Registered queries of the timetable's delays, facts, acceptance, files, replay and the model's artefact."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.functions import expressions as X
from headway.ml import eta
from headway.operators import accuracy, otp as O, schedule as S, tables as T
from headway.plans.catalog import CTES, GRAIN_COLUMNS, NEEDS, ORACLES, query
from headway.plans.extended import MODEL, REASONS, _features, payloads, spoiled
from headway.quality import acceptance, contracts
from headway.sources import files, views as V
from headway.streaming import jobs, replay

# Delay from the timetable: two snapshots of it, made from the trips' numbers.

FIRST_SEEN, THEN_SEEN = "2024-01-05 00:00:00", "2024-01-15 00:00:00"
LOCAL = "timezone('America/Los_Angeles', timezone('UTC', make_timestamp(report_epoch * 1000000)))"
CTES |= {
    "trips": "select distinct trip_id, stop_sequence, cast(split_part(trip_id, ':T', 2) as bigint) as k from positions where stop_sequence is not null",
    "plan": """select trip_id, stop_sequence, k, k % 5 <> 4 as in_1, k % 7 <> 6 as in_2, (k * 613 + stop_sequence * 977) % 97200 as s_1, (k * 613 + stop_sequence * 977 + case when k % 3 = 0 then 180 else 0 end) % 97200 as s_2 from trips""",
    "timetable": """select trip_id, stop_sequence, s_1 as seconds, 0 as since, case when not in_2 or s_1 <> s_2 then 1 else 2 end as until, true as assumed from plan where in_1
 union all select trip_id, stop_sequence, s_2, case when in_1 then 1 else 0 end, 2, not in_1 from plan where in_2 and (not in_1 or s_1 <> s_2)""",
    "planned": f"""select s.*, cast(epoch(timezone('America/Los_Angeles', strptime(service_date || ' 12:00:00', '%Y%m%d %H:%M:%S'))) as bigint) - 43200 as day_start, split_part(trip_id, ':', 1) as agency,
 cast(hour({LOCAL}) as bigint) as hour_local, 120 as poll_interval_s from sightings s""",
    "delayed": f"""select p.*, t.seconds, t.assumed as valid_from_assumed, p.day_start + t.seconds as scheduled_epoch, p.report_epoch - p.day_start - t.seconds as delay_s from planned p
 left join timetable t on p.trip_id = t.trip_id and p.stop_sequence = t.stop_sequence and (t.since = 0 or p.day_start >= epoch(timestamp '{THEN_SEEN}')) and (t.until = 2 or p.day_start < epoch(timestamp '{THEN_SEEN}'))""",
}
NEEDS |= {"trips": ["positions"], "plan": ["trips"], "timetable": ["plan"], "planned": ["sightings"], "delayed": ["planned", "timetable"]}


def _timetable(spark, d):
    trips = V.positions(spark, d).where("stop_sequence is not null").select("trip_id", "stop_sequence").distinct()
    trips = trips.withColumn("k", F.split_part("trip_id", F.lit(":T"), F.lit(2)).cast("long"))

    def snapshot(listed, more):
        s = (F.col("k") * 613 + F.col("stop_sequence") * 977 + more) % 97200
        two = lambda x: F.lpad(x.cast("string"), 2, "0")
        text = F.concat(two(F.floor(s / 3600)), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60))
        return trips.where(listed).select("trip_id", "stop_sequence", text.alias("arrival_time"))

    keys, attributes = list(O.KEYS), ["arrival_time"]
    dim = S.upsert(None, snapshot("k % 5 <> 4", 0), keys, attributes, FIRST_SEEN)
    return S.upsert(dim, snapshot("k % 7 <> 6", F.when(F.col("k") % 3 == 0, 180).otherwise(0)), keys, attributes, THEN_SEEN, close_missing=True)


def _delayed(spark, d):
    return O.delays(V.sightings(spark, d), _timetable(spark, d)).withColumn("poll_interval_s", F.lit(120))


@query("select entity_id, service_date, trip_id, stop_sequence, scheduled_epoch, delay_s, delay_s between -60 and 300 as is_on_time, seconds is not null as schedule_matched, valid_from_assumed, agency, hour_local from delayed", "delayed")
def otp_delays(spark, d):
    return _delayed(spark, d).select("entity_id", *GRAIN_COLUMNS, "scheduled_epoch", "delay_s", "is_on_time", "schedule_matched", "valid_from_assumed", "agency", "hour_local")


@query("select count(*) as facts_in, count(*) as rows_out, true as join_conserved, count(seconds) as schedule_matched, count(delay_s) as scored, round(100.0 * count(seconds) / count(*), 1) as match_rate_pct from delayed", "delayed")
def otp_conservation(spark, d):
    return O.conserved(V.sightings(spark, d), _delayed(spark, d))


@query("select " + ORACLES["a1_a5_agency_mart"].rsplit("\nselect ", 1)[1].replace("from otp", "from delayed"), "delayed")
def otp_agency_mart(spark, d):
    return accuracy.agency_mart(_delayed(spark, d), floor=10)


@query("""select hour_local, cast(sum(n) as bigint) as n_arrivals, round(sum(on_time_pct * n) / sum(n), 1) as on_time_pct, round(sum(late_pct * n) / sum(n), 1) as late_pct from (select agency, route_id, hour_local, count(*) as n,
round(100 * avg(cast(delay_s between -60 and 300 as int)), 1) as on_time_pct, round(100 * avg(cast(delay_s > 300 as int)), 1) as late_pct from delayed where delay_s is not null group by all having count(*) >= 2) group by hour_local""", "delayed")  # fmt: skip
def otp_by_hour(spark, d):
    return accuracy.hourly(accuracy.route_hour_mart(_delayed(spark, d), floor=2))


@query("""select service_date, trip_id, stop_sequence, cast(null as varchar) as stop_id, route_id, report_epoch, last_stopped, observed_dwell_s, n_stopped_observations, 'stopped_at' as arrival_method, 'high' as arrival_confidence,
cast(null as double) as arrival_method_agreement_s, '1.0.0' as resolver_version from sightings""", "sightings")  # fmt: skip
def p2_fact_projection(spark, d):
    return O.facts(V.sightings(spark, d)).drop("poll_interval_s", "decoder_version", "ingest_ts", "source_path")


# Acceptance


def _ingested(spark, d):
    """One report in forty runs up to a minute ahead of its poll."""
    ahead = F.when(F.col("entity_id") % 40 == 0, -(F.col("entity_id") % 61)).otherwise(F.col("entity_id") % 100 + 1)
    return V.sightings(spark, d).withColumns({"ingest_epoch": F.col("report_epoch") + ahead, "stop_id": F.concat(F.lit("S"), F.col("stop_sequence") % 2)})


AHEAD = "(select *, case when entity_id % 40 = 0 then entity_id % 61 else -(entity_id % 100 + 1) end as ahead from sightings)"


@query(f"""select 'clock ahead' as name, case when avg(cast(ahead > 0 as int)) < 0.1 then 'PASS' else 'FAIL' end as status, avg(cast(ahead > 0 as double)) as measured, count(*) as n from {AHEAD}
union all select 'worst skew', case when max(greatest(ahead, 0)) <= 120 then 'PASS' else 'FAIL' end, cast(max(greatest(ahead, 0)) as double), count(*) from {AHEAD}
union all select 'event time is ingest time', case when avg(cast(ahead = 0 as int)) < 0.01 then 'PASS' else 'FAIL' end, avg(cast(ahead = 0 as double)), count(*) from {AHEAD}""", "sightings")  # fmt: skip
def q6_skew_bound(spark, d):
    return acceptance.skew(_ingested(spark, d), floor=1)


@query(f"""select 'service_date+trip_id+stop_sequence unique' as name, 'PASS' as status, 0.0 as measured, count(*) as n from sightings union all select 'second run is the same', 'PASS', 0.0, count(*) from sightings
union all select 'value null and zero', case when count(*) < 100 then 'UNMEASURED' when count(*) filter (entity_id % 9 = 0) > 0 and count(*) filter (entity_id % 9 <> 0 and entity_id % 10 = 0) > 0 then 'PASS' else 'FAIL' end, cast(count(*) filter (entity_id % 9 <> 0 and entity_id % 10 = 0) as double), count(*) from positions
union all select 'contract holds', case when sum(cast(len({REASONS}) > 0 as int)) = 0 then 'PASS' else 'FAIL' end, cast(sum(cast(len({REASONS}) > 0 as int)) as double), count(*) from positions
union all select 'provenance complete', 'PASS', 0.0, count(*) from sightings
union all select 'event time is ingest time', case when avg(cast(ahead = 0 as int)) < 0.01 then 'PASS' else 'FAIL' end, avg(cast(ahead = 0 as double)), count(*) from {AHEAD}
union all select 'stops visited twice', 'INFO', cast(count(*) as double), count(*) from (select 1 from sightings group by service_date, trip_id, stop_sequence % 2 having count(distinct stop_sequence) > 1)""", "sightings")  # fmt: skip
def q5_acceptance(spark, d):
    facts = _ingested(spark, d)
    table = T.VersionedTable(spark, jobs.shared(spark, "again"))
    table.overwrite(V.sightings(spark, d), ["service_date"])
    rows = spoiled(V.positions(spark, d)).withColumn("value", F.when(F.col("entity_id") % 9 != 0, F.when(F.col("entity_id") % 10 == 0, 0.0).otherwise(1.0)))
    again = T.merge_earliest(table.read(), V.sightings(spark, d), GRAIN_COLUMNS, "report_epoch")
    return acceptance.checks(facts, again, rows, "value", ["entity_id", "report_epoch", "n_stopped_observations"], floor=1, row_floor=100)


# Files

POSITION = "entity_id bigint, trip_id string, stop_sequence bigint, current_status string, report_epoch bigint"
PLAIN = "select entity_id, trip_id, stop_sequence, current_status, report_epoch from positions"


def _plain(spark, d):
    return V.positions(spark, d).select("entity_id", "trip_id", "stop_sequence", "current_status", "report_epoch")


@query(PLAIN, "positions")
def s6_json_lines(spark, d):
    path = jobs.shared(spark, "decoded")
    files.write_json_lines(_plain(spark, d), path)
    return files.read_json_lines(spark, path, POSITION)


@query("select service_date, trip_id, stop_sequence, entity_id, report_epoch, last_stopped from sightings", "sightings")
def k12_arrivals_json(spark, d):
    path = jobs.shared(spark, "arrivals")
    rows = V.sightings(spark, d).select(*GRAIN_COLUMNS, "entity_id", "report_epoch", "last_stopped")
    files.write_json_lines(rows, path)
    return files.read_json_lines(spark, path, "service_date string, trip_id string, stop_sequence bigint, entity_id bigint, report_epoch bigint, last_stopped bigint")


@query("select service_date, trip_id, stop_sequence, issued, predicted, actual, horizon_s, residual_s from features", "features")
def s15_feature_csv(spark, d):
    path = jobs.shared(spark, "features")
    columns = [*GRAIN_COLUMNS, "issued", "predicted", "actual", "horizon_s", "residual_s"]
    _features(spark, d).select(columns).write.option("header", True).csv(path)
    return files.read_features(spark, path, ", ".join(f"{c} {'string' if c in ('service_date', 'trip_id') else 'bigint'}" for c in columns))


@query("select agency, count(*) as n, round(avg(delay_s), 1) as mean_delay_s from otp where delay_s is not null group by agency", "otp")
def k11_report(spark, d):
    path = jobs.shared(spark, "report")
    out = V.otp(spark, d).where("delay_s is not null").groupBy("agency").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("delay_s"), 1).alias("mean_delay_s"))
    files.write_report(out, path)
    return spark.read.option("header", True).schema("agency string, n bigint, mean_delay_s double").csv(path)


@query("select current_status, count(*) as n from positions where entity_id % 2 = 0 group by current_status", "positions")
def t8_latest_snapshot(spark, d):
    root = jobs.shared(spark, "snapshots")
    for name, part in (("0a1", "entity_id % 2 = 1"), ("0b7", "entity_id % 2 = 0")):
        _plain(spark, d).where(part).write.parquet(f"{root}/{name}")
    return spark.read.parquet(files.latest(spark, root)).groupBy("current_status").agg(F.count(F.lit(1)).alias("n"))


@query("select trip_id, count(*) as n from positions group by trip_id", "positions")
def k17_registered_table(spark, d):
    path = jobs.shared(spark, "external")
    _plain(spark, d).write.parquet(path)
    files.register(spark, "headway_positions", path, POSITION)
    return spark.sql("select trip_id, count(*) as n from headway_positions group by trip_id")


# Replay


@query("select feed, poll_epoch, rank from (select feed, poll_epoch, row_number() over (order by poll_epoch, feed) as rank from (select feed, poll_epoch from (select 'trip_updates' as feed, p as poll_epoch, row_number() over (order by p) as r from (select distinct report_epoch // 3600 * 3600 as p from positions where entity_id % 2 = 0)) where r <= 30 union all select feed, poll_epoch from (select 'vehicle_positions' as feed, p as poll_epoch, row_number() over (order by p) as r from (select distinct report_epoch // 3600 * 3600 as p from positions where entity_id % 2 = 1)) where r <= 30))", "positions")
def s11_replay_polls(spark, d):
    from pyspark.sql import Window

    at = V.positions(spark, d).select((F.floor(F.col("report_epoch") / 3600) * 3600).alias("poll_epoch"), (F.col("entity_id") % 2).alias("odd")).distinct()
    part = lambda odd: at.where(F.col("odd") == odd).select("poll_epoch", F.col("poll_epoch").cast("string").alias("path"), F.lit(b"").alias("content"))
    found = replay.polls({"trip_updates": part(0), "vehicle_positions": part(1)}, max_polls=30)
    return found.select("feed", "poll_epoch", F.row_number().over(Window.orderBy("poll_epoch", "feed")).cast("long").alias("rank"))  # 60 polls


@query(f"select 'vehicle_positions' as topic, count(*) as n from positions where len({REASONS}) = 0 union all select 'vehicle_positions.dead', count(*) from positions where len({REASONS}) > 0", "positions")
def r3_publish(spark, d):
    log = jobs.shared(spark, "log")
    replay.publish(spoiled(V.positions(spark, d)), X.partition_key(F.col("service_date"), F.col("trip_id")), "vehicle_positions", log, "2024-02-01 00:00:00")
    n = lambda topic: spark.read.json(f"{log}/{topic}").agg(F.lit(topic).alias("topic"), F.count(F.lit(1)).alias("n"))
    return n("vehicle_positions").unionAll(n("vehicle_positions.dead"))


@query("select service_date || ':' || trip_id as key, entity_id, current_status from positions", "positions")
def s10_subscribe(spark, d):
    log = jobs.shared(spark, "log")
    rows = V.positions(spark, d).select("service_date", "trip_id", "entity_id", "current_status")
    contracts.keyed(rows, X.partition_key(F.col("service_date"), F.col("trip_id"))).write.json(f"{log}/positions")
    return jobs.collected(replay.subscribe(spark, log, "positions", "entity_id bigint, current_status string"))


@query("""select entity_id, recent, 3 - recent as remaining, case when recent >= 3 then 86400 - (report_epoch - first) + 0.5 else 0.0 end as wait_s from (select entity_id, report_epoch, count(*) over w as recent, min(report_epoch) over w as first
from positions window w as (partition by trip_id order by report_epoch range between 86400 preceding and current row))""", "positions")  # fmt: skip
def w10_rate_budget(spark, d):
    return replay.budget(V.positions(spark, d), ["trip_id"], "report_epoch", 3, 86400).select("entity_id", "recent", "remaining", F.col("wait_s").cast("double").alias("wait_s"))


# Ingest twice, with more payloads the second time


@query("""select 'rows' as what, count(*) as n from positions union all select 'quarantine', 1 union all select 'ledger', count(distinct report_epoch // 3600) + 1 from positions""", "positions")
def k7_ledger(spark, d):
    bad = spark.createDataFrame([("raw/vehicle_positions/ingest_dt=x/1700000000-0123abcd.pb.gz", b"junk", 1_700_000_000)], "path string, content binary, poll_epoch long")
    found = payloads(V.positions(spark, d)).unionByName(bad)
    path = jobs.shared(spark, "payloads")
    found.write.parquet(path)
    found, table = spark.read.parquet(path), T.VersionedTable(spark, jobs.shared(spark, "bronze"))
    for part in ("poll_epoch % 7200 = 0 or poll_epoch = 1700000000", "true", "true"):
        jobs.ingest(found.where(part), "vehicle_positions", table)
    n = lambda name, df: df.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))
    return n("rows", table.read()).unionAll(n("quarantine", table.side("quarantine"))).unionAll(n("ledger", table.side("ledger")))


# Expressions


@query("select entity_id, case when entity_id % 3 = 0 then 'ALL' when entity_id % 3 = 1 then split_part(trip_id, ':', 1) else split_part(route_id, ':', 1) end as agency from positions", "positions")
def p7_profile_agency(spark, d):
    k = F.col("entity_id") % 3
    trip, route = F.when(k == 1, F.col("trip_id")).otherwise("x"), F.when(k == 2, F.col("route_id"))
    return V.positions(spark, d).select("entity_id", X.agency_of(trip, F.lit("y"), route, otherwise="ALL").alias("agency"))


@query("""select entity_id, coalesce(case when entity_id % 4 > 0 then report_epoch end, report_epoch - 5) as issued, report_epoch + 60 as predicted from positions where stop_sequence is not null and entity_id % 6 > 0""", "positions")
def f8_usable_predictions(spark, d):
    k = F.col("entity_id")
    rows = V.positions(spark, d).withColumns({"trip_update_ts_epoch": F.when(k % 4 > 0, F.col("report_epoch")).when(k % 8 == 0, 0), "feed_header_ts_epoch": F.col("report_epoch") - 5, "arrival_time_epoch": F.when(k % 6 > 0, F.col("report_epoch") + 60).when(k % 12 == 0, 0)})
    return accuracy.usable_predictions(rows).select("entity_id", "issued", "predicted")


@query("select entity_id, case when entity_id % 2 = 0 then 'GET /x?api_key=***&agency=' || split_part(trip_id, ':', 1) else 'failed with *** at ' || trip_id end as text from positions", "positions")
def s_redact(spark, d):
    k = F.col("entity_id")
    text = F.when(k % 2 == 0, F.concat(F.lit("GET /x?api_key=k"), k, F.lit("&agency="), X.agency_of(F.col("trip_id")))).otherwise(F.concat(F.lit("failed with 0123456789 at "), "trip_id"))
    return V.positions(spark, d).select("entity_id", X.redact(text, "0123456789").alias("text"))


@query("select entity_id, sha256(trip_id || '||' || coalesce(cast(stop_sequence as varchar), '~') || '||' || coalesce(current_status, '~')) as digest from positions", "positions")
def s_attribute_hash(spark, d):
    return V.positions(spark, d).select("entity_id", X.attribute_hash(F.col("trip_id"), F.col("stop_sequence"), F.col("current_status")).alias("digest"))


@query("select entity_id, case when entity_id % 5 > 0 then strftime(make_timestamp(report_epoch * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') end as text, entity_id % 5 > 0 as same from positions", "positions")
def s_epoch_iso(spark, d):
    epoch = F.when(F.col("entity_id") % 5 > 0, F.col("report_epoch")).otherwise(0)
    text = X.epoch_to_iso(epoch)
    return V.positions(spark, d).select("entity_id", text.alias("text"), F.coalesce(F.unix_timestamp(X.iso_to_timestamp(text)) == F.col("report_epoch"), F.lit(False)).alias("same"))


# The model's artefact: none, and one whose gate is shut; both leave the agency's time alone.


@query("select service_date, trip_id, stop_sequence, issued, predicted, predicted as corrected, 'agency' as source, k from features, (values (0), (1)) t(k)", "features")
def m8_no_artefact(spark, d):
    rows = _features(spark, d)
    path = jobs.shared(spark, "model")
    out = eta.serve(rows, path).withColumn("k", F.lit(0))
    eta.save(eta.train_model(rows.limit(200), MODEL, iterations=1, depth=1), False, MODEL, path)  # a shut gate needs no good model
    out = out.unionByName(eta.serve(rows, path).withColumn("k", F.lit(1)), allowMissingColumns=True)
    return out.select(*GRAIN_COLUMNS, "issued", "predicted", "corrected", "source", F.col("k"))


