"""The jobs from payloads to marts, in the order of the assets."""

import gzip
import json
import threading
from argparse import Namespace
from datetime import datetime, timezone
from urllib.error import HTTPError
from urllib.request import urlopen

import pytest
from pyspark.sql import functions as F

from headway import cli, orchestration
from headway.operators.tables import VersionedTable
from headway.serving import http
from headway.sources import feed, files
from headway.streaming import replay

START = 1_754_060_400  # 2025-08-01 08:00 in Los Angeles


def positions(at, stop, late):
    m = feed.message()()
    m.header.timestamp = at
    for k in range(12):
        v = m.entity.add(id=f"v{k}").vehicle
        v.trip.trip_id, v.trip.start_date, v.trip.route_id = f"A:{k}", "20250801", "A:R"
        v.timestamp, v.stop_id, v.current_stop_sequence, v.current_status = at + late, f"s{stop}", stop, 1
    return gzip.compress(m.SerializeToString())


def updates(at, stop):
    m = feed.message()()
    m.header.timestamp = at
    for k in range(12):
        t = m.entity.add(id=f"u{k}").trip_update
        t.trip.trip_id, t.trip.start_date, t.timestamp = f"A:{k}", "20250801", at
        s = t.stop_time_update.add(stop_sequence=stop)
        s.arrival.time = at + 300 + k
    return gzip.compress(m.SerializeToString())


@pytest.fixture
def data(tmp_path):
    for name, make in (("vehicle_positions", lambda at, s: positions(at, s, 30)), ("trip_updates", lambda at, s: updates(at - 200, s))):
        folder = tmp_path / f"raw/{name}/ingest_dt=2025-08-01"
        folder.mkdir(parents=True)
        for s in range(1, 5):
            at = START + 600 * s
            (folder / f"{at}-0123abcd.pb.gz").write_bytes(make(at, s))
    static = tmp_path / "static/v1"
    static.mkdir(parents=True)
    rows = [f"A:{k},s{s},{s},{8 + s * 10 // 60:02d}:{s * 10 % 60:02d}:00" for k in range(11) for s in range(1, 5)]
    (static / "stop_times.txt").write_text("trip_id,stop_id,stop_sequence,arrival_time\n" + "\n".join(rows) + "\n")
    (static / "trips.txt").write_text("route_id,service_id,trip_id\n" + "\n".join(f"R,S,A:{k}" for k in range(12)) + "\n")
    (tmp_path / "static/v1.json").write_text(json.dumps({"fetched_at": "2025-07-20T10:00:00+00:00"}))
    return tmp_path


def args(lake, **more):
    return Namespace(**({"lake": str(lake), "data": "", "feed": None, "interval": 120, "limit": None, "observed_at": None, "latest": False, "close_missing": False, "floor": 1, "out": str(lake) + ".db", "speed": 0.0, "max_polls": None} | more))


def test_assets_in_order(spark, data, tmp_path):
    lake = tmp_path / "lake"
    static = {"timetable": str(data / "static/v1")}
    done = orchestration.materialise(spark, args(lake), {"bronze_positions": str(data), "bronze_updates": str(data)} | static)
    assert list(done) == orchestration.order() and done["timetable"]["observed_at"] == "2025-07-20 10:00:00"
    o = done["otp"]
    assert (o["facts_in"], o["rows_out"], o["schedule_matched"], o["scored"]) == (48, 48, 44, 44)
    scored = VersionedTable(spark, f"{lake}/gold/otp").read()
    assert {r.delay_s for r in scored.collect()} == {30, None} and scored.where("delay_s is null").select("trip_id").distinct().count() == 1
    assert done["marts"] == done["store"] == {"mart_otp_by_agency": 1, "mart_otp_by_route_hour": 1, "mart_worst_routes": 1}
    again = orchestration.materialise(spark, args(lake), {"bronze_positions": str(data)} | static, ["otp"])
    assert again["otp"]["scored"] == 44 and "bronze_updates" not in again
    s = http.server(str(lake) + ".db", 0)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    ask = lambda path: json.loads(urlopen(f"http://127.0.0.1:{s.server_port}{path}").read())
    try:
        assert ask("/agencies")[0]["n_arrivals"] == 44 and ask("/meta")["first_service_date"] == "20250801" and len(ask("/worst-routes?limit=3")) == 1
        with pytest.raises(HTTPError) as e:
            ask("/worst-routes?limit=0")
        assert e.value.code == 422
    finally:
        s.shutdown()
    f = cli.features(spark, args(lake))
    assert f["rows"] == 48
    first = cli.predict(spark, args(lake))
    assert first["agency"] == 48  # there is no artefact yet
    cli.train(spark, args(lake))
    assert sum(v for k, v in cli.predict(spark, args(lake)).items() if k != "version") == 48


def test_a_later_snapshot_keeps_history(spark, data, tmp_path):
    lake = tmp_path / "lake"
    cli.schedule(spark, args(lake, data=str(data / "static"), latest=True))
    v2 = data / "static/v2"
    v2.mkdir()
    (v2 / "trips.txt").write_text((data / "static/v1/trips.txt").read_text())
    (v2 / "stop_times.txt").write_text((data / "static/v1/stop_times.txt").read_text().replace("08:10:00", "08:11:00"))
    before = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    done = cli.schedule(spark, args(lake, data=str(data / "static"), latest=True))  # no sidecar: now
    assert done["observed_at"] >= before
    dim = VersionedTable(spark, f"{lake}/dim/schedule").read()
    old = dim.where("not is_current")
    assert old.count() == 11 and old.where("valid_from >= valid_to").count() == 0 and dim.where("is_current").count() == 44


def test_replay(spark, data, tmp_path):
    slept = []
    key = lambda: F.col("trip_id")
    a = replay.replay(spark, str(data), ["vehicle_positions", "trip_updates"], str(tmp_path / "a"), key, "2025-01-01 00:00:00")
    b = replay.replay(spark, str(data), ["vehicle_positions", "trip_updates"], str(tmp_path / "b"), key, "2025-01-01 00:00:00", speed=10, max_polls=2, sleep=slept.append)
    assert a == {"published": 96, "dead": 0, "quarantined": 0} and b["published"] == 48 and slept == [0.0, 60.0]
    got = replay.subscribe(spark, str(tmp_path / "a"), "trip_updates", "trip_id string, stop_sequence int")
    from headway.streaming import jobs

    assert jobs.collected(got).count() == 48


def test_rate_budget():
    now = [0.0]
    b = replay.RateBudget(2, 100, lambda: now[0])
    for t in (0.0, 40.0):
        now[0] = t
        assert b.wait_time() == 0
        b.record()
    assert b.remaining == 0 and b.wait_time() == 60.5
    now[0] = 100.5
    assert b.remaining == 1 and b.wait_time() == 0


def test_snapshot_time(spark, tmp_path):
    now = datetime(2025, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    path = tmp_path / "x.json"
    assert files.observed_at(spark, str(path), now) == "2025-01-02 03:04:05"
    for text, want in (("{", "2025-01-02 03:04:05"), ("{}", "2025-01-02 03:04:05"), ('{"fetched_at": "2024-05-06T01:00:00-07:00"}', "2024-05-06 08:00:00")):
        (tmp_path / f"{len(text)}.json").write_text(text)
        assert files.observed_at(spark, str(tmp_path / f"{len(text)}.json"), now) == want
    with pytest.raises(ValueError):
        files.latest(spark, str(tmp_path / "none"))
