"""Timetable snapshots: a content-addressed archive of zips, and CSV read by header."""

from __future__ import annotations

import json
import zipfile
from hashlib import sha256
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("stop_times.txt", "trips.txt")
STOP_TIMES = ("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time", "pickup_type", "drop_off_type", "timepoint")
TRIPS = ("trip_id", "route_id", "service_id", "trip_headsign", "direction_id")
KEYS = ["trip_id", "stop_sequence"]


def archive(body: bytes, root: str, fetched_at: str) -> Path:
    """The zip under its digest, with a sidecar of when it was fetched; an unchanged one is left alone."""
    if body[:2] != b"PK":
        raise ValueError("not a zip")
    path = Path(root) / f"{sha256(body).hexdigest()[:16]}.zip"
    if not path.exists():
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
        path.with_suffix(".json").write_text(json.dumps({"fetched_at": fetched_at, "bytes": len(body)}))
    return path


def extract(path: Path, root: str) -> Path:
    out = Path(root) / path.stem
    with zipfile.ZipFile(path) as z:
        if missing := set(REQUIRED) - set(z.namelist()):
            raise ValueError(f"the snapshot lacks {sorted(missing)}")
        for name in REQUIRED:
            z.extract(name, out)
    return out


def csv(spark: SparkSession, path: str, columns: tuple[str, ...], required: tuple[str, ...]) -> DataFrame:
    """Named columns as text; those the file lacks are null, further ones are left out, a lacking required one is an error."""
    raw = spark.read.option("header", True).csv(path)
    if missing := set(required) - set(raw.columns):
        raise ValueError(f"{path} lacks {sorted(missing)}")
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def stop_schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Stop times with their trips' attributes, one row of each key; rows of unknown trips stay."""
    from headway.operators.schedule import unique_keys

    times = csv(spark, f"{folder}/stop_times.txt", STOP_TIMES, ("trip_id", "stop_sequence")).withColumn("stop_sequence", F.col("stop_sequence").try_cast("int"))
    times = times.where("trip_id is not null and stop_sequence is not null")
    trips = unique_keys(csv(spark, f"{folder}/trips.txt", TRIPS, ("trip_id",)), ["trip_id"], [F.col(c) for c in TRIPS])
    rows = unique_keys(times, KEYS, [F.col(c) for c in STOP_TIMES])
    return rows.join(trips, "trip_id", "left")
