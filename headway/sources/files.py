"""Files beside the lake: decoded JSON lines, feature tables, reports, registered tables, snapshots by time."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, gzipped or not; fields beyond the schema are left out, absent ones are null."""
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """One object a row, with absent fields as nulls, gzipped; the files are as many as the partitions."""
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def read_features(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A feature table with a header; an empty field is null."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A small report as one file of CSV with a header, or of JSON lines, in a folder: for aggregates, not for facts."""
    one = df.coalesce(1).write.mode("overwrite")
    one.option("header", True).csv(path) if kind == "csv" else one.json(path)


def register(spark: SparkSession, name: str, path: str, schema: str) -> None:
    """An external table over Parquet files, found by name; one that is there is registered anew, its files stay."""
    spark.sql(f"drop table if exists {name}")
    spark.catalog.createTable(name, path, "parquet", _struct(schema))


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _list(spark: SparkSession, folder: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().toString() for f in fs.listStatus(path) if f.isDirectory()] if fs.exists(path) else []


def latest(spark: SparkSession, folder: str) -> str:
    """The last of the folder's snapshots by name."""
    found = sorted(_list(spark, folder))
    if not found:
        raise ValueError(f"{folder} has no snapshot")
    return found[-1]


def observed_at(spark: SparkSession, sidecar: str, now: datetime | None = None) -> str:
    """When a snapshot was fetched, as its sidecar says, in UTC; now, if there is no sidecar or it has no such time."""
    rows = []
    path = spark._jvm.org.apache.hadoop.fs.Path(sidecar)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        rows = spark.read.text(sidecar, wholetext=True).collect()
    at = now or datetime.now(timezone.utc)
    try:
        at = datetime.fromisoformat(json.loads(rows[0][0])["fetched_at"]) if rows else at
    except (KeyError, TypeError, ValueError):
        pass
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    return at.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
