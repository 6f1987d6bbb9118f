import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.constants import GRAIN
from headway.functions import expressions as X
from headway.ml import eta
from headway.operators import accuracy, schedule as S
from headway.operators.tables import VersionedTable, merge_by_partition, merge_earliest
from headway.quality import contracts, expectations
from headway.serving.store import Store, export
from headway.sources import static, views as V
from headway.streaming import jobs


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_service_days_over_clock_changes(spark):
    epoch = lambda d, t: one(spark, X.scheduled_epoch(F.lit(d), F.lit(t)))
    assert epoch("20260308", "08:00:00") == 1772982000  # 15:00 UTC
    assert epoch("20261101", "08:00:00") == 1793548800  # 16:00 UTC
    assert epoch("20260806", "25:14:00") == 1786090440  # 08:14 UTC the next day
    assert epoch("2026-8-6", "08:00:00") is None and epoch("20261301", "08:00:00") is None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=9), st.from_regex(r"\A[0-9]{1,3}:[0-9]{2}:[0-9]{2}\Z")), max_size=40))
def test_gtfs_seconds(spark, values):
    import re

    def want(v):
        m = re.fullmatch(r"([0-9]{1,3}):([0-5][0-9]):([0-5][0-9])", (v or "").strip(" "))
        return int(m[1]) * 3600 + int(m[2]) * 60 + int(m[3]) if m else None

    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", X.gtfs_seconds(F.col("v")).alias("s")).collect()
    assert {r.i: r.s for r in rows} == {i: want(v) for i, v in enumerate(values)}


def test_lead_bucket_edges(spark):
    leads = [-1, 0, 119, 120, 299, 300, 1199, 1200, 99_999]
    rows = spark.createDataFrame([(x,) for x in leads], "x long").select(X.lead_bucket(F.col("x")).alias("b"), X.lead_order(F.col("x")).alias("o")).collect()
    assert [r.o for r in rows] == [-1, 0, 0, 1, 1, 2, 3, 4, 4] and rows[0].b is None and rows[-1].b == "20+ min"


def test_versioned_table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.version is None and t.bootstrap("a int, b string") == 0 and t.read().count() == 0
    t.overwrite(spark.createDataFrame([(1, "x")], "a int, b string"))
    t.append(spark.createDataFrame([(2, "y")], "a int, b string"))
    t.overwrite(t.read().where("a = 2"))
    assert [t.read(v).count() for v in range(4)] == [0, 1, 2, 1] and t.meta()["retention_days"] == 90
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([(2,)], "c int"))
    with pytest.raises(ValueError):
        t.read(9)
    assert t.vacuum(now=4e9) and t.version == 3 and t.read().count() == 1


def test_partitions_are_replaced_alone(spark, tmp_path):
    f = lambda rows: spark.createDataFrame(rows, "d string, k int, t long")
    t = VersionedTable(spark, str(tmp_path / "p"))
    merge = lambda rows, **how: merge_by_partition(t, f(rows), ["d", "k"], "t", "d", **how)
    merge([("a", 1, 5), ("b", 1, 5), (None, 1, 5)])
    merge([("a", 1, 3), ("a", 2, 9)])
    merge([("a", 1, 4), ("c", 1, 1), (None, 1, 2)])
    want = [(None, 1, 2), ("a", 1, 3), ("a", 2, 9), ("b", 1, 5), ("c", 1, 1)]
    assert sorted((tuple(r) for r in t.read().select("d", "k", "t").collect()), key=str) == sorted(want, key=str)
    assert len(t.meta()["data"]) == 3 and t.read(0).count() == 3
    merge([("b", 1, 9)], most=2)
    assert len(t.meta()["data"]) == 1 and t.read().count() == 5


KEY = ["k"]


def test_merge_earliest(spark):
    target = [(1, 100, 5), (2, 100, 5), (None, 7, 1)]
    assert sorted(merge_rows(spark, target, target), key=str) == sorted(target, key=str)
    out = {k: (t, m) for k, t, m in merge_rows(spark, target, [(1, 90, 6), (2, 110, 9), (3, 1, 1), (None, 9, 0)])}
    assert out == {1: (90, 6), 2: (100, 9), 3: (1, 1), None: (7, 1)}


def merge_rows(spark, a, b):
    f = lambda rows: spark.createDataFrame(rows, "k int, t long, m long")
    return [tuple(r) for r in merge_earliest(f(a), f(b), KEY, "t", refresh=("m",)).collect()]


def test_scd2(spark):
    f = lambda rows: spark.createDataFrame(rows, "k int, v string")
    dim = S.upsert(None, f([(1, "a"), (2, "b"), (3, None)]), ["k"], ["v"], "2024-01-01 00:00:00", seed_backdate=True)
    same = S.upsert(dim, f([(1, "a"), (2, "b"), (3, None)]), ["k"], ["v"], "2024-01-02 00:00:00")
    assert same.exceptAll(dim).count() == 0 and same.count() == 3
    later = S.upsert(same, f([(1, "A"), (3, "c"), (4, "d")]), ["k"], ["v"], "2024-01-03 00:00:00", close_missing=True)
    assert later.where("is_current").count() == 3 and later.count() == 6
    assert S.gaps(later, ["k"]).count() == 0
    back = S.upsert(later, f([(2, "b")]), ["k"], ["v"], "2024-01-05 00:00:00")
    facts = spark.createDataFrame([(1, "2023-06-01"), (1, "2024-01-03"), (2, "2024-01-04"), (2, "2024-01-05"), (9, "2024-01-01")], "k int, d string").withColumn("at", F.col("d").cast("timestamp"))
    got = [(r.k, r.d, r.v) for r in S.as_of(facts, back, {"k": "k"}, "at", ["v"]).orderBy("k", "d").collect()]
    assert got == [(1, "2023-06-01", "a"), (1, "2024-01-03", "A"), (2, "2024-01-04", None), (2, "2024-01-05", "b"), (9, "2024-01-01", None)]
    assert S.backdate_first(back, ["k"]).where("version = 1 and valid_from > timestamp '1970-01-01 00:00:00'").count() == 0


def test_static_snapshot(spark, tmp_path):
    z = tmp_path / "x.zip"
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("stop_times.txt", "location_id,trip_id,stop_id,stop_sequence,arrival_time\n,A:1,100,1,08:00:00\n,A:1,200,x,09:00:00\n,B:2,100,3,25:40:00\n")
        f.writestr("trips.txt", "route_id,service_id,trip_id\nR1,S,A:1\n")
    path = static.archive(z.read_bytes(), str(tmp_path / "a"), "2024-01-01")
    assert static.archive(z.read_bytes(), str(tmp_path / "a"), "2024-01-02") == path and "2024-01-01" in path.with_suffix(".json").read_text()
    rows = static.stop_schedule(spark, str(static.extract(path, str(tmp_path / "e")))).collect()
    assert sorted((r.trip_id, r.stop_sequence, r.route_id, r.pickup_type) for r in rows) == [("A:1", 1, "R1", None), ("B:2", 3, None, None)]
    with pytest.raises(ValueError):
        static.archive(b"<html>", str(tmp_path / "a"), "")


def test_accuracy_counts_copies_once(spark):
    g = ("20240101", "A:1", 1)
    p = spark.createDataFrame([(*g, 100, 400), (*g, 100, 400), (*g, 600, 700), (*g, 200, 250)], "service_date string, trip_id string, stop_sequence int, issued long, predicted long")
    a = spark.createDataFrame([(*g, 500), (*g, 500)], "service_date string, trip_id string, stop_sequence int, actual long")
    assert sorted((r.error_s, r.lead_s) for r in accuracy.pairs(p, a).collect()) == [(-250, 300), (-100, 400)]
    assert tuple(accuracy.hindsight(p, a).first()) == (3, 2, 1, 0)


def test_contracts(spark):
    rows = spark.createDataFrame([(1, "20240101", 5, 10.0), (2, "2024-01-01", 0, 91.0), (3, None, None, None)], "id int, service_date string, report_epoch long, latitude double")
    good, bad = contracts.split(rows)
    assert sorted(r.id for r in good.collect()) == [1, 3]
    (letter,) = contracts.dead_letters(bad, "t", "2024-01-01 00:00:00").collect()
    assert letter.error.count(";") == 2 and '"id":2' in letter.raw
    assert contracts.unknown_fields(rows, ["id", "service_date"]) == ["latitude", "report_epoch"]
    wrong = spark.createDataFrame([('{"a": "0", "b": "x"}',), ('{"a": 0, "b": "x"}',), ('{"a": 1.5}',)], "j string").select(contracts.wrong_types(F.col("j"), {"a": "bigint", "b": "string"}).alias("w")).collect()
    assert [len(r.w) for r in wrong] == [1, 0, 1]


def test_expectations_need_enough_rows(spark):
    df = spark.range(10)
    states = {r.name: r.status for r in expectations.report(expectations.not_null(df, "id"), expectations.none_violate(df, "few", F.lit(False), 100), expectations.accepted_range(df, "id", 0, 5), expectations.unique(df, ["id"]), expectations.same_rows(df, df, "twice")).collect()}
    assert states == {"id not null": "PASS", "few": "UNMEASURED", "id in range": "FAIL", "id unique": "PASS", "twice": "PASS"}


def test_features_leak_nothing(spark, sf):
    f = eta.features(V.predictions(spark, sf), V.arrivals(spark, sf))
    assert set(eta.FEATURES) <= set(f.columns) and not {"actual", "lead_s", "residual_s"} & set(eta.FEATURES)
    train, test = eta.temporal_split(f)
    assert train.agg(F.max("issued")).first()[0] < test.agg(F.min("issued")).first()[0]
    rows = spark.createDataFrame([(1000, 100, 5.4), (1000, 9999, 5.4), (1000, 100, None)], "predicted long, horizon_s long, residual_hat double")
    assert [r.corrected for r in eta.correct(rows, True).collect()] == [1005, 1000, 1000]
    assert [r.source for r in eta.correct(rows, False).collect()] == ["agency"] * 3


def test_store(spark, sf, tmp_path):
    otp = V.otp(spark, sf)
    marts = {"mart_otp_by_agency": accuracy.agency_mart(otp, 1), "mart_worst_routes": accuracy.worst_routes(otp, 1), "mart_otp_by_route_hour": accuracy.route_hour_mart(otp, 1)}
    counts = export(marts, str(tmp_path / "s.db"), {"window": "all"})
    store = Store(str(tmp_path / "s.db"))
    assert len(store.agencies()) == counts["mart_otp_by_agency"] and store.health()["ok"] and not store.meta()["stale"]
    assert [r["worst_rank"] for r in store.worst_routes(3)] == [1, 2, 3] and store.otp_by_hour("A1")
    with pytest.raises(ValueError):
        store.worst_routes(0)
    assert store.meta(now=4e9)["stale"] and set(GRAIN)


def test_sessions_end_at_a_gap_of_just_the_bound(spark, tmp_path):
    times = {"a": [0, 7200, 14399, 21598], "b": [0, 7199, 7200, 14401], "c": [5]}
    spark.createDataFrame([(t, x) for t, xs in times.items() for x in xs], "trip_id string, report_epoch long").coalesce(1).write.parquet(f"{tmp_path}/p")
    out = jobs.collected(jobs.sessions(jobs.files_of(spark, f"{tmp_path}/p")), "complete").collect()
    assert sorted(tuple(r) for r in out) == [("a", 0, 1), ("a", 7200, 3), ("b", 0, 3), ("b", 14401, 1), ("c", 5, 1)]
