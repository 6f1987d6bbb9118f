"""Jobs from the command line: python -m headway.cli JOB --lake FOLDER [--data FOLDER] ..."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from headway.constants import GRAIN
from headway.functions import expressions as X
from headway.ml import eta
from headway.operators import accuracy, otp as otp_facts, positions as P, schedule as S
from headway.operators.tables import VersionedTable, merge_by_partition
from headway.serving import http, store
from headway.session import build
from headway.sources import feed, files, static
from headway.streaming import jobs, replay

FEEDS = ("trip_updates", "vehicle_positions")


def bronze(spark, a) -> dict:
    """New payloads, decoded, into bronze; files that the ledger names are left out."""
    table = VersionedTable(spark, f"{a.lake}/bronze/{a.feed}")
    files = feed.scan(spark, a.data, a.feed)
    if a.limit:
        done = table.side("ledger")
        files = files if done is None else files.join(done.select("path"), "path", "left_anti")
        files = files.orderBy("path").limit(a.limit)
    jobs.ingest(files, a.feed, table, a.interval)
    return {"version": table.version, "rows": table.read().count(), "quarantined": table.side("quarantine").count()}


def bronze_stream(spark, a) -> dict:
    return jobs.bronze(spark, a.data, a.feed, VersionedTable(spark, f"{a.lake}/bronze/{a.feed}"), a.interval)


def silver(spark, a) -> dict:
    """Bronze with times typed, copies removed and quality flagged; rows without an entity aren't copies of each other."""
    rows = VersionedTable(spark, f"{a.lake}/bronze/{a.feed}").read()
    keys = ["feed_header_ts_epoch", "entity_id"] + (["stop_sequence"] if a.feed == "trip_updates" else [])
    rows = P.dedup(rows, keys, [*([rows["ingest_ts"].asc_nulls_last()]), rows["source_path"]], whole=["entity_id"])
    rows = P.typed(rows, ["feed_header_ts", "vehicle_report_ts", "trip_update_ts", "arrival_time", "departure_time", "ingest_ts"])
    grain = GRAIN if a.feed == "trip_updates" else ("service_date", "trip_id", "current_stop_sequence")
    table = VersionedTable(spark, f"{a.lake}/silver/{a.feed}")
    return {"version": table.overwrite(P.quality_flags(rows, grain), ["service_date"]), "rows": table.read().count()}


def gold(spark, a) -> dict:
    """Arrivals from silver positions, merged so that the earliest sighting wins; service dates without news stay as they are."""
    rows = VersionedTable(spark, f"{a.lake}/silver/vehicle_positions").read().withColumnsRenamed({"current_stop_sequence": "stop_sequence", "current_stop_id": "stop_id", "vehicle_report_ts_epoch": "report_epoch"})
    new = otp_facts.facts(P.first_sightings(rows.where(P.resolvable(stop="stop_id", deleted="is_deleted_entity")), ties=("ingest_ts", "source_path")))
    table = VersionedTable(spark, f"{a.lake}/gold/arrivals")
    version = merge_by_partition(table, new, list(GRAIN), "report_epoch", "service_date", ("source_path",), ("last_stopped", "observed_dwell_s", "n_stopped_observations"))
    return {"version": version, "rows": table.read().count()}


def schedule(spark, a) -> dict:
    """A timetable snapshot into the dimension: the folder given, or the last one below it; seen when its sidecar says, or
    now."""
    folder = files.latest(spark, a.data) if a.latest else a.data
    at = a.observed_at or files.observed_at(spark, f"{folder.rstrip('/')}.json")
    rows = static.stop_schedule(spark, folder)
    attributes = [c for c in rows.columns if c not in static.KEYS]
    table = VersionedTable(spark, f"{a.lake}/dim/schedule")
    dim = S.upsert(None if table.version is None else table.read(), rows, static.KEYS, attributes, at, close_missing=a.close_missing, seed_backdate=True)
    return {"version": table.overwrite(dim), "rows": table.read().count(), "observed_at": at}


def otp(spark, a) -> dict:
    """Delays of gold arrivals from the timetable of their day; an error if the join multiplies arrivals."""
    arrivals = VersionedTable(spark, f"{a.lake}/gold/arrivals").read()
    scored = otp_facts.delays(arrivals, VersionedTable(spark, f"{a.lake}/dim/schedule").read())
    table = VersionedTable(spark, f"{a.lake}/gold/otp")
    version = table.overwrite(scored, ["service_date"])
    done = otp_facts.conserved(arrivals, table.read()).first().asDict()
    if not done["join_conserved"]:
        raise SystemExit(f"{done['facts_in']} arrivals became {done['rows_out']}")
    return {"version": version, **done}


def _marts(spark, a) -> dict:
    rows = VersionedTable(spark, f"{a.lake}/gold/otp").read()
    floor = {} if a.floor is None else {"floor": a.floor}
    return {"mart_otp_by_agency": accuracy.agency_mart(rows, **floor), "mart_otp_by_route_hour": accuracy.route_hour_mart(rows, **floor), "mart_worst_routes": accuracy.worst_routes(rows, **floor)}


def marts(spark, a) -> dict:
    """The marts as tables, and as external tables found by name."""
    out = {}
    for name, df in _marts(spark, a).items():
        path = f"{a.lake}/marts/{name}"
        df.write.mode("overwrite").parquet(path)
        files.register(spark, name, path, df.schema.toDDL())
        out[name] = spark.table(name).count()
    return out


def export(spark, a) -> dict:
    """The marts into one file of SQLite, next to the window that they cover."""
    window = VersionedTable(spark, f"{a.lake}/gold/otp").read().agg(F.min("service_date"), F.max("service_date")).first()
    return store.export(_marts(spark, a), a.out, {"first_service_date": str(window[0]), "last_service_date": str(window[1])})


def _features(spark, a):
    updates = VersionedTable(spark, f"{a.lake}/silver/trip_updates").read().withColumnsRenamed({"arrival_delay_s": "agency_delay_s", "arrival_uncertainty": "uncertainty", "n_stop_time_updates": "n_stops_in_update"})
    arrivals = VersionedTable(spark, f"{a.lake}/gold/arrivals").read().withColumn("actual", F.col("report_epoch"))
    return eta.features(accuracy.usable_predictions(updates), arrivals)


def features(spark, a) -> dict:
    table = VersionedTable(spark, f"{a.lake}/gold/features")
    return {"version": table.overwrite(_features(spark, a)), "rows": table.read().count()}


def train(spark, a) -> dict:
    """The model, with its gate, as an artefact; features that training can't use are left out."""
    first, last = eta.temporal_split(VersionedTable(spark, f"{a.lake}/gold/features").read())
    useless = {r.feature for r in eta.degenerate(first, last, list(eta.FEATURES)).collect()}
    columns = [c for c in eta.FEATURES if c not in useless]
    model = eta.train_model(first, columns)
    gate = eta.baseline_gate(eta.predict(model, eta.baselines(first, last), columns))
    eta.save(model, gate, columns, f"{a.lake}/model")
    return {"gate": gate, "features": columns}


def predict(spark, a) -> dict:
    """Corrected times of the features' predictions, by the artefact, or the agency's where there is none that helps."""
    out = eta.serve(VersionedTable(spark, f"{a.lake}/gold/features").read(), f"{a.lake}/model").select(*GRAIN, "issued", "predicted", "corrected", "source")
    table = VersionedTable(spark, f"{a.lake}/gold/corrected")
    version = table.overwrite(out)
    return {"version": version} | {r["source"]: r["count"] for r in table.read().groupBy("source").count().collect()}


def replay_log(spark, a) -> dict:
    """Archived polls into the log of topics."""
    key = lambda: X.partition_key(F.col("service_date"), F.col("trip_id"))
    return replay.replay(spark, a.data, list(FEEDS), f"{a.lake}/log", key, datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), a.speed, a.max_polls)


def serve(spark, a) -> dict:
    """The export over HTTP, until interrupted."""
    http.server(a.out, a.port).serve_forever()
    return {}


JOBS = {f.__name__.replace("_", "-"): f for f in (bronze, bronze_stream, silver, gold, schedule, otp, marts, export, features, train, predict, replay_log, serve)}


def main(args: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--lake", required=True)
    p.add_argument("--data", default="data")
    p.add_argument("--feed", choices=FEEDS, default="vehicle_positions")
    p.add_argument("--interval", type=int, default=120)
    p.add_argument("--limit", type=int)
    p.add_argument("--observed-at")
    p.add_argument("--latest", action="store_true")
    p.add_argument("--out", default="store.db")
    p.add_argument("--floor", type=int)
    p.add_argument("--speed", type=float, default=0.0)
    p.add_argument("--max-polls", type=int)
    p.add_argument("--port", type=int, default=8000)
    p.add_argument("--close-missing", action="store_true")
    a = p.parse_args(args)
    out = JOBS[a.job](build(f"headway-{a.job}"), a)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
