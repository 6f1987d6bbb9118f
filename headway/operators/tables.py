"""Versioned Parquet tables: each write makes a version, and a small file names the current one.

Files go through Hadoop's file system, so a table may lie wherever Spark reads. A version's folder is written whole before
the file that names it is replaced; a reader never sees half a write, and a table may be overwritten from itself.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.constants import RETENTION_DAYS


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _logs(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/_log")
        return sorted(int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(p) if f.getPath().getName().endswith(".json")) if fs.exists(p) else []

    def meta(self, version: int | None = None) -> dict:
        logs = self._logs()
        if not logs:
            return {"versions": [], "retention_days": RETENTION_DAYS}
        want = logs[-1] if version is None else version
        if want not in logs:
            raise ValueError(f"{self.path} has no version {version}: it has {logs}")
        fs, p = self._fs(f"{self.path}/_log/{want}.json")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    @property
    def version(self) -> int | None:
        logs = self._logs()
        return logs[-1] if logs else None

    def read(self, version: int | None = None) -> DataFrame:
        """A version's rows. Folders written with one layout are one scan; partitions that a later write replaced are left out."""
        meta = self.meta(version)
        if "data" not in meta:
            raise ValueError(f"{self.path} has no version yet")
        return self._scan(meta["data"], meta["schema"])

    def _scan(self, data: list[dict], schema: str) -> DataFrame:
        groups: dict[str, list[dict]] = {}
        for d in data:
            groups.setdefault(json.dumps([d["by"], d["without"]]), []).append(d)
        parts = []
        for same in groups.values():
            df = self.spark.read.schema(schema).option("basePath", self.path).parquet(*[f"{self.path}/{d['folder']}" for d in same])
            for column, values in same[0]["without"].items():
                listed = F.col(column).cast("string").isin([v for v in values if v is not None])
                df = df.where(~F.coalesce(listed, F.lit(False)) & (F.col(column).isNotNull() if None in values else F.lit(True)))
            parts.append(df.drop("part"))
        return reduce(DataFrame.unionByName, parts)

    def side(self, name: str) -> DataFrame | None:
        """A side table that was committed with this one; None before the first such write."""
        found = self.meta().get("side", {}).get(name)
        return self._scan(found["data"], found["schema"]) if found else None

    def _commit(self, data: list[dict], schema: str, extra: dict, side: dict[str, DataFrame] | None = None) -> int:
        before = self.meta()
        sides = dict(before.get("side", {}))
        for name, df in (side or {}).items():
            old = sides.get(name, {"data": []})["data"]
            sides[name] = {"data": [*old, self._write(df, [])], "schema": _ddl(df)}
        new = 0 if self.version is None else self.version + 1
        carried = {k: before[k] for k in ("batch",) if k in before}
        body = json.dumps({"version": new, "data": data, "schema": schema, "side": sides, "written_at": time.time(), "retention_days": RETENTION_DAYS} | carried | extra)
        fs, p = self._fs(f"{self.path}/_log/{new}.json")
        out = fs.create(p, False)  # fails if another writer was first
        try:
            out.write(bytearray(body.encode()))
        finally:
            out.close()
        return new

    def _write(self, df: DataFrame, partition_by: list[str]) -> dict:
        folder = f"part=w{uuid.uuid4().hex[:12]}"
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.path}/{folder}")
        return {"folder": folder, "by": list(partition_by), "without": {}}

    def overwrite(self, df: DataFrame, partition_by: list[str] = (), side: dict[str, DataFrame] | None = None, **extra) -> int:
        return self._commit([self._write(df, list(partition_by))], _ddl(df), extra, side)

    def append(self, df: DataFrame, partition_by: list[str] = (), side: dict[str, DataFrame] | None = None, **extra) -> int:
        """Adds rows, and rows of side tables in the same commit: all are there, or none."""
        if self.version is not None and _ddl(df) != self.meta()["schema"]:
            raise ValueError(f"the schema differs: {_ddl(df)} and {self.meta()['schema']}")
        return self._commit([*self.meta().get("data", []), self._write(df, list(partition_by))], _ddl(df), extra, side)

    def replace_partitions(self, df: DataFrame, column: str, values: list, **extra) -> int:
        """The rows whose `column` is one of the values give way to df; other partitions are not read or written."""
        if self.version is None:
            return self.overwrite(df, [column], **extra)
        listed = [None if v is None else str(v) for v in values]
        old = [d | {"without": d["without"] | {column: sorted({*d["without"].get(column, []), *listed}, key=str)}} for d in self.meta()["data"]]
        return self._commit([*old, self._write(df.select(self.read().columns), [column])], self.meta()["schema"], extra)

    def compact(self, partition_by: list[str] = (), above: int = 0) -> int:
        """One folder in place of many, if there are more than `above`."""
        return self.overwrite(self.read(), partition_by) if len(self.meta()["data"]) > above else self.version

    def bootstrap(self, schema: str) -> int:
        return self.overwrite(self.spark.createDataFrame([], schema)) if self.version is None else self.version

    def _folders(self, version: int) -> set[str]:
        meta = self.meta(version)
        return {d["folder"] for part in [meta["data"], *(s["data"] for s in meta["side"].values())] for d in part}

    def vacuum(self, now: float | None = None) -> list[str]:
        """Deletes versions beyond the retention and the folders that no version is left to name; the current one stays."""
        now = now or time.time()
        keep = [v for v in self._logs() if v == self.version or now - self.meta(v)["written_at"] <= self.meta(v)["retention_days"] * 86400]
        named = {f for v in keep for f in self._folders(v)}
        gone = []
        for v in self._logs():
            if v not in keep:
                for f in sorted(self._folders(v) - named - set(gone)):
                    fs, p = self._fs(f"{self.path}/{f}")
                    fs.delete(p, True)
                    gone.append(f)
                fs, p = self._fs(f"{self.path}/_log/{v}.json")
                fs.delete(p, False)
        return gone


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def merge_earliest(target: DataFrame, source: DataFrame, keys: list[str], order: str, ties: tuple[str, ...] = (), refresh: tuple[str, ...] = ()) -> DataFrame:
    """target with source merged: of each key (nulls equal) the row that is earliest by `order`, target's on a tie.

    Merging the same source again changes nothing; a late but earlier row corrects; a later one doesn't move a row, but
    columns of `refresh` follow the largest seen, so measures that grow don't go stale.
    """
    both = target.withColumn("_prio", F.lit(0)).unionByName(source.withColumn("_prio", F.lit(1)))
    w = Window.partitionBy(*keys)
    out = both.withColumn("_rn", F.row_number().over(w.orderBy(F.col(order).asc_nulls_last(), "_prio", *ties)))
    for c in refresh:
        out = out.withColumn(c, F.max(c).over(w))
    return out.where("_rn = 1").drop("_rn", "_prio")


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(n_before, n_inserted, n_updated, n_after) of such a merge."""
    s = source.groupBy(*keys).agg(F.min(order).alias("_s"))
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(order).alias("_t"), F.lit(1).alias("_in_t"))
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        on = c if on is None else on & c
    j = s.withColumn("_in_s", F.lit(1)).join(t, on, "full")
    new, both = F.col("_in_t").isNull(), F.col("_in_t").isNotNull() & F.col("_in_s").isNotNull()
    return j.agg(F.count("_in_t").alias("n_before"), F.count_if(new).alias("n_inserted"), F.count_if(both & (F.col("_s") < F.col("_t"))).alias("n_updated"), F.count(F.lit(1)).alias("n_after"))


def unprocessed(files: DataFrame, ledger: DataFrame, key: str = "path") -> DataFrame:
    """Files that the ledger doesn't name."""
    return files.join(ledger.select(key).distinct(), key, "left_anti")


def merge_by_partition(table: VersionedTable, new: DataFrame, keys: list[str], order: str, column: str, ties: tuple[str, ...] = (), refresh: tuple[str, ...] = (), most: int = 64, **extra) -> int:
    """merge_earliest into a table, of which only the partitions (of `column`, one of the keys) that new rows touch are
    read and written. Beyond `most` folders the table is compacted."""
    new = new.persist()
    try:
        values = [r[0] for r in new.select(column).distinct().collect()]  # as many as partitions are touched
        if table.version is None:
            return table.overwrite(merge_earliest(new.limit(0), new, keys, order, ties, refresh), [column], **extra)
        listed = F.col(column).isin([v for v in values if v is not None])
        old = table.read().where(F.coalesce(listed, F.lit(False)) | (F.col(column).isNull() if None in values else F.lit(False)))
        table.replace_partitions(merge_earliest(old, new.select(old.columns), keys, order, ties, refresh), column, values, **extra)
        return table.compact([column], most)
    finally:
        new.unpersist()
