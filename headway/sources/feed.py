"""Archived feed payloads: scanning, presence-aware decoding, quarantine.

The messages are declared here from the published GTFS-Realtime specification, field numbers and all. Enums are declared as
numbers, so values that the specification doesn't have survive as UNKNOWN_n.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.expressions import poll_epoch

#: The specification's messages, as name: {field: (number, type)}; a list is a repeated field.
MESSAGES = {
    "FeedMessage": {"header": (1, "FeedHeader"), "entity": (2, ["FeedEntity"])},
    "FeedHeader": {"gtfs_realtime_version": (1, "string"), "incrementality": (2, "int32"), "timestamp": (3, "uint64")},
    "FeedEntity": {"id": (1, "string"), "is_deleted": (2, "bool"), "trip_update": (3, "TripUpdate"), "vehicle": (4, "VehiclePosition")},
    "TripUpdate": {"trip": (1, "TripDescriptor"), "stop_time_update": (2, ["StopTimeUpdate"]), "vehicle": (3, "VehicleDescriptor"), "timestamp": (4, "uint64"), "delay": (5, "int32")},
    "StopTimeUpdate": {"stop_sequence": (1, "uint32"), "arrival": (2, "StopTimeEvent"), "departure": (3, "StopTimeEvent"), "stop_id": (4, "string"), "schedule_relationship": (5, "int32")},
    "StopTimeEvent": {"delay": (1, "int32"), "time": (2, "int64"), "uncertainty": (3, "int32")},
    "VehiclePosition": {"trip": (1, "TripDescriptor"), "position": (2, "Position"), "current_stop_sequence": (3, "uint32"), "current_status": (4, "int32"), "timestamp": (5, "uint64"), "congestion_level": (6, "int32"), "stop_id": (7, "string"), "vehicle": (8, "VehicleDescriptor"), "occupancy_status": (9, "int32"), "occupancy_percentage": (10, "uint32")},
    "Position": {"latitude": (1, "float"), "longitude": (2, "float"), "bearing": (3, "float"), "odometer": (4, "double"), "speed": (5, "float")},
    "TripDescriptor": {"trip_id": (1, "string"), "start_time": (2, "string"), "start_date": (3, "string"), "schedule_relationship": (4, "int32"), "route_id": (5, "string"), "direction_id": (6, "uint32")},
    "VehicleDescriptor": {"id": (1, "string"), "label": (2, "string"), "license_plate": (3, "string")},
}
ENUMS = {
    "incrementality": ("FULL_DATASET", "DIFFERENTIAL"),
    "stop": ("SCHEDULED", "SKIPPED", "NO_DATA", "UNSCHEDULED"),
    "trip": ("SCHEDULED", "ADDED", "UNSCHEDULED", "CANCELED", None, "REPLACEMENT", "DUPLICATED", "DELETED"),
    "status": ("INCOMING_AT", "STOPPED_AT", "IN_TRANSIT_TO"),
    "congestion": ("UNKNOWN_CONGESTION_LEVEL", "RUNNING_SMOOTHLY", "STOP_AND_GO", "CONGESTION", "SEVERE_CONGESTION"),
    "occupancy": ("EMPTY", "MANY_SEATS_AVAILABLE", "FEW_SEATS_AVAILABLE", "STANDING_ROOM_ONLY", "CRUSHED_STANDING_ROOM_ONLY", "FULL", "NOT_ACCEPTING_PASSENGERS", "NO_DATA_AVAILABLE", "NOT_BOARDABLE"),
}

#: The decoded tables' columns, in order.
META = "feed_type string, feed_header_ts string, feed_header_ts_epoch bigint, gtfs_realtime_version string, incrementality string, ingest_ts string, payload_sha256 string, poll_interval_s int, decoder_version string, protobuf_runtime string"
ENTITY = "entity_id string, is_deleted boolean"
TRIP = "trip_id string, route_id string, direction_id int, trip_start_time string, service_date string, trip_schedule_relationship string"
VEHICLE = "vehicle_id string, vehicle_label string"
COMMON = ", ".join((META, ENTITY, TRIP, VEHICLE))
SCHEMAS = {
    "trip_updates": COMMON + ", trip_update_ts string, trip_update_ts_epoch bigint, trip_delay_s int, n_stop_time_updates int, stop_sequence int, stop_id string, stop_schedule_relationship string, arrival_time string, arrival_time_epoch bigint, arrival_delay_s int, arrival_uncertainty int, departure_time string, departure_time_epoch bigint, departure_delay_s int, departure_uncertainty int",
    "vehicle_positions": COMMON + ", vehicle_report_ts string, vehicle_report_ts_epoch bigint, latitude double, longitude double, bearing double, speed double, current_stop_sequence int, current_stop_id string, current_status string, congestion_level string, occupancy_status string, occupancy_percentage int",
}
DECODER_VERSION = "1.0.0"
BINARY = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


@cache
def message(name: str = "FeedMessage"):
    """The message class, built at run time."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = descriptor_pb2.FieldDescriptorProto
    types = {"string": kinds.TYPE_STRING, "int32": kinds.TYPE_INT32, "uint32": kinds.TYPE_UINT32, "int64": kinds.TYPE_INT64, "uint64": kinds.TYPE_UINT64, "bool": kinds.TYPE_BOOL, "float": kinds.TYPE_FLOAT, "double": kinds.TYPE_DOUBLE}
    file = descriptor_pb2.FileDescriptorProto(name="headway/feed.proto", package="headway", syntax="proto2")
    for what, fields in MESSAGES.items():
        m = file.message_type.add(name=what)
        for field, (number, kind) in fields.items():
            many = isinstance(kind, list)
            kind = kind[0] if many else kind
            f = m.field.add(name=field, number=number, label=kinds.LABEL_REPEATED if many else kinds.LABEL_OPTIONAL)
            if kind in types:
                f.type = types[kind]
            else:
                f.type, f.type_name = kinds.TYPE_MESSAGE, f".headway.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"headway.{name}"))


def field(m, name: str):
    """The value if the field is there, else None: zero is a value, absence isn't."""
    return getattr(m, name) if m is not None and m.HasField(name) else None


def enum(m, name: str, kind: str) -> str | None:
    n = field(m, name)
    if n is None:
        return None
    names = ENUMS[kind]
    return names[n] if 0 <= n < len(names) and names[n] else f"UNKNOWN_{n}"


def iso(epoch: int | None) -> str | None:
    from datetime import datetime, timezone

    return datetime.fromtimestamp(epoch, timezone.utc).isoformat() if epoch and epoch > 0 else None


def decode(payload: bytes, feed_type: str, poll_interval_s: int = 120, ingest_ts: str | None = None) -> Iterator[dict]:
    """A row for each stop of each trip update, or for each vehicle; a trip update without stops is one row."""
    import google.protobuf

    raw = gzip.decompress(payload) if payload[:2] == b"\x1f\x8b" else payload
    feed = message().FromString(raw)
    header = field(feed, "header")
    if header is None:
        raise ValueError("no feed header")
    t = field(header, "timestamp")
    meta = {"feed_type": feed_type, "feed_header_ts": iso(t), "feed_header_ts_epoch": t, "gtfs_realtime_version": field(header, "gtfs_realtime_version"), "incrementality": enum(header, "incrementality", "incrementality"), "ingest_ts": ingest_ts, "payload_sha256": sha256(raw).hexdigest(), "poll_interval_s": poll_interval_s, "decoder_version": DECODER_VERSION, "protobuf_runtime": google.protobuf.__version__}
    part = "trip_update" if feed_type == "trip_updates" else "vehicle"
    for e in feed.entity:
        body = field(e, part)
        if body is None:
            continue
        trip, vehicle = field(body, "trip"), field(body, "vehicle")
        row = meta | {
            "entity_id": field(e, "id"), "is_deleted": field(e, "is_deleted"),
            "trip_id": field(trip, "trip_id"), "route_id": field(trip, "route_id"), "direction_id": field(trip, "direction_id"), "trip_start_time": field(trip, "start_time"),
            "service_date": field(trip, "start_date"), "trip_schedule_relationship": enum(trip, "schedule_relationship", "trip"),
            "vehicle_id": field(vehicle, "id"), "vehicle_label": field(vehicle, "label"),
        }
        at = field(body, "timestamp")
        if part == "vehicle":
            p = field(body, "position")
            yield row | {"vehicle_report_ts": iso(at), "vehicle_report_ts_epoch": at, **{c: field(p, c) for c in ("latitude", "longitude", "bearing", "speed")}, "current_stop_sequence": field(body, "current_stop_sequence"), "current_stop_id": field(body, "stop_id"), "current_status": enum(body, "current_status", "status"), "congestion_level": enum(body, "congestion_level", "congestion"), "occupancy_status": enum(body, "occupancy_status", "occupancy"), "occupancy_percentage": field(body, "occupancy_percentage")}
            continue
        row |= {"trip_update_ts": iso(at), "trip_update_ts_epoch": at, "trip_delay_s": field(body, "delay"), "n_stop_time_updates": len(body.stop_time_update)}
        for s in body.stop_time_update or [None]:
            stop = {"stop_sequence": field(s, "stop_sequence"), "stop_id": field(s, "stop_id"), "stop_schedule_relationship": enum(s, "schedule_relationship", "stop")}
            for what in ("arrival", "departure"):
                x = field(s, what)
                stop |= {f"{what}_time": iso(field(x, "time")), f"{what}_time_epoch": field(x, "time"), f"{what}_delay_s": field(x, "delay"), f"{what}_uncertainty": field(x, "uncertainty")}
            yield row | stop


def scan(spark: SparkSession, root: str, feed_type: str) -> DataFrame:
    """The payloads of one feed under root/raw, with their poll epochs."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb.gz").option("recursiveFileLookup", "true").load(f"{root}/raw/{feed_type}")
    return files.select("path", "content", poll_epoch(F.col("path")).alias("poll_epoch"))


def scan_stream(spark: SparkSession, root: str, feed_type: str, max_files: int = 200) -> DataFrame:
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.pb.gz").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(f"{root}/raw/{feed_type}")
    return files.select("path", "content", poll_epoch(F.col("path")).alias("poll_epoch"))


def decoded(files: DataFrame, feed_type: str, poll_interval_s: int = 120) -> DataFrame:
    """(source_path, poll_epoch, decode_error, columns of the feed): rows, or one row with the error of a bad payload."""
    schema = f"source_path string, poll_epoch bigint, decode_error string, {SCHEMAS[feed_type]}"
    arrow = _arrow(schema)

    def run(batches):
        for b in batches:
            for path, content, epoch in zip(*(b.column(i).to_pylist() for i in range(3))):
                try:
                    rows = [{"source_path": path, "poll_epoch": epoch, **r} for r in decode(content, feed_type, poll_interval_s, iso(epoch))]
                except Exception as e:  # a bad payload is a row of the quarantine, whatever is wrong with it
                    rows = [{"source_path": path, "poll_epoch": epoch, "decode_error": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return files.select("path", "content", "poll_epoch").mapInArrow(run, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine)."""
    return rows.where("decode_error is null").drop("decode_error"), rows.where("decode_error is not null").select("source_path", "poll_epoch", "decode_error")
