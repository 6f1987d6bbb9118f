import gzip

import pytest
from pyspark.sql import functions as F

from headway import cli
from headway.operators.tables import VersionedTable
from headway.sources import feed
from headway.streaming import jobs


def trip_feed(at=1_754_000_000):
    m = feed.message()()
    m.header.gtfs_realtime_version, m.header.timestamp, m.header.incrementality = "2.0", at, 0
    t = m.entity.add(id="t1").trip_update
    t.trip.trip_id, t.trip.start_date = "A:1", "20250801"
    s = t.stop_time_update.add(stop_sequence=1)
    s.arrival.delay, s.arrival.uncertainty, s.arrival.time = 0, 0, 0
    t.stop_time_update.add(stop_sequence=2)
    s = t.stop_time_update.add(stop_sequence=3, schedule_relationship=1)
    s.arrival.delay, s.arrival.uncertainty = 240, 30
    m.entity.add(id="t2").trip_update.trip.schedule_relationship = 3
    m.entity.add(id="t3").trip_update.trip.schedule_relationship = 44
    return m.SerializeToString()


def vehicle_feed(at, status=1, sequence=5, trip="A:1", report=None):
    m = feed.message()()
    m.header.timestamp = at
    v = m.entity.add(id="v1").vehicle
    v.trip.trip_id, v.trip.start_date, v.timestamp, v.stop_id = trip, "20250801", report or at, "s5"
    v.current_stop_sequence, v.current_status = sequence, status
    m.entity.add(id="v2").vehicle.position.latitude = 37.5
    return m.SerializeToString()


def test_presence():
    rows = list(feed.decode(trip_feed(), "trip_updates"))
    assert [r.get("arrival_delay_s") for r in rows] == [0, None, 240, None, None]
    assert [r.get("arrival_uncertainty") for r in rows] == [0, None, 30, None, None]
    assert (rows[0]["arrival_time"], rows[0]["arrival_time_epoch"]) == (None, 0)
    assert [r["stop_schedule_relationship"] for r in rows] == [None, None, "SKIPPED", None, None]
    assert rows[3]["trip_schedule_relationship"] == "CANCELED" and rows[3]["stop_sequence"] is None
    assert rows[4]["trip_schedule_relationship"] == "UNKNOWN_44"
    full, bare = feed.decode(vehicle_feed(1_754_000_000), "vehicle_positions")
    assert (full["current_status"], full["current_stop_sequence"], full["vehicle_report_ts"]) == ("STOPPED_AT", 5, "2025-07-31T22:13:20+00:00")
    assert bare["current_status"] is None and bare["current_stop_sequence"] is None and bare["latitude"] == 37.5


@pytest.fixture
def archive(tmp_path):
    folder = tmp_path / "raw/vehicle_positions/ingest_dt=2025-08-01"
    folder.mkdir(parents=True)
    for i, (status, report) in enumerate([(2, 0), (1, 0), (1, 0), (1, 1_754_000_100)]):
        at = 1_754_000_000 + 120 * i
        body = vehicle_feed(at, status, report=report or at)
        (folder / f"{at}-0123abcd.pb.gz").write_bytes(gzip.compress(body) if i else body)
    (folder / "1754009999-0123abcd.pb.gz").write_bytes(b"<html>busy</html>")
    (folder / "odd-name.pb.gz").write_bytes(gzip.compress(vehicle_feed(1_754_001_000, 1, 9)))
    return tmp_path


def test_quarantine_and_poll_epochs(spark, archive):
    files = feed.scan(spark, str(archive), "vehicle_positions")
    good, bad = feed.split(feed.decoded(files, "vehicle_positions"))
    assert good.count() == 10 and [r.poll_epoch for r in bad.collect()] == [1_754_009_999]
    assert good.where("poll_epoch is null").count() == 2
    assert good.columns[2:] == [c.split()[0] for c in feed.SCHEMAS["vehicle_positions"].split(", ")]


def test_medallion_jobs_are_idempotent(spark, archive, tmp_path):
    lake = str(tmp_path / "lake")
    args = ["--lake", lake, "--data", str(archive)]
    for _ in range(2):
        done = cli.main(["bronze", *args])
        assert (done["rows"], done["quarantined"]) == (10, 1)
    cli.main(["silver", *args])
    first = cli.main(["gold", *args])
    assert cli.main(["gold", *args])["rows"] == first["rows"] == 2
    arrival = VersionedTable(spark, f"{lake}/gold/arrivals").read().where("stop_sequence = 5").first()
    assert arrival.report_epoch == 1_754_000_100 and arrival.n_stopped_observations == 3  # the late report came first


def test_bronze_stream_equals_batch_and_goes_on(spark, archive, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "b"))
    done = jobs.bronze(spark, str(archive), "vehicle_positions", table)
    assert (done["batches"], done["rows"]) == (1, 6)
    batch = feed.split(feed.decoded(feed.scan(spark, str(archive), "vehicle_positions"), "vehicle_positions"))[0]
    got = table.read().drop("bronze_loaded_at")
    assert got.exceptAll(batch.select(got.columns)).count() == 0 and got.count() == batch.count() and table.side("quarantine").count() == 1
    folder = archive / "raw/vehicle_positions/ingest_dt=2025-08-02"
    folder.mkdir()
    (folder / "1754100000-0123abcd.pb.gz").write_bytes(vehicle_feed(1_754_100_000))
    (folder / "1754100120-0123abcd.pb.gz").write_bytes(b"junk")
    assert jobs.bronze(spark, str(archive), "vehicle_positions", table)["rows"] == 2
    assert jobs.bronze(spark, str(archive), "vehicle_positions", table)["rows"] == 0
    jobs.ingest(feed.scan(spark, str(archive), "vehicle_positions"), "vehicle_positions", table)  # by hand: nothing is left to do
    assert table.read().count() == 12 and table.side("quarantine").count() == 2 and table.side("ledger").count() == 8


def test_stream_in_pieces_equals_batch(spark, sf, tmp_path):
    from headway.sources import views as V

    spark.read.parquet(f"{sf}/events.parquet").repartition(5, F.col("event_id")).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "e")).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert jobs.resolve(V.shape_positions(stream), table)["batches"] >= 5
    want = V.sightings(spark, sf).select("service_date", "trip_id", "stop_sequence", "entity_id", "report_epoch", "last_stopped")
    got = table.read().select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
