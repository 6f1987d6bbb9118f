"""Replay of archived polls into a keyed log of files, with dead letters, a rate budget and a pace.

The log stands where a broker's topics would: a folder of JSON lines (key, value) for each topic. Where a connector's jar
is at hand, the same rows are written with format "kafka"; options() has what that sink needs.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.quality import contracts
from headway.sources import feed


def polls(feeds: dict[str, DataFrame], max_polls: int | None = None) -> DataFrame:
    """(poll_epoch, feed, path, content): the payloads of all feeds by time and then feed; at most so many polls of each."""
    out = None
    for name, files in feeds.items():
        part = files.where("poll_epoch is not null").select("poll_epoch", F.lit(name).alias("feed"), "path", "content")
        if max_polls is not None:
            part = part.orderBy("poll_epoch", "path").limit(max_polls)
        out = part if out is None else out.unionByName(part)
    return out.orderBy("poll_epoch", "feed", "path")


def waits(epochs: list[int], speed: float) -> list[float]:
    """Seconds to wait before each poll, so that a replay runs `speed` times as fast as the archive; none if zero."""
    return [0.0] + [max(0, b - a) / speed if speed > 0 else 0.0 for a, b in zip(epochs, epochs[1:])]


def publish(rows: DataFrame, key: Column, topic: str, log: str, failed_at: str, more: dict[str, Column] | None = None) -> dict:
    """Rows that keep the contract go to the topic, keyed; others to its dead letters, with the reasons."""
    checked = contracts.violations(rows, more).persist()
    try:
        good, bad = checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)
        contracts.keyed(good, key).write.mode("append").json(f"{log}/{topic}")
        contracts.dead_letters(bad, topic, failed_at).write.mode("append").json(f"{log}/{topic}.dead")
        n = checked.agg(F.count(F.lit(1)), F.count_if(F.size("violations") > 0)).first()
        return {"published": n[0] - n[1], "dead": n[1]}
    finally:
        checked.unpersist()


def replay(spark: SparkSession, root: str, feed_types: list[str], log: str, key: Callable[[], Column], failed_at: str, speed: float = 0.0, max_polls: int | None = None, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Polls in their order. At speed zero they are one job; else a job a poll, paced as in the archive."""
    found = polls({f: feed.scan(spark, root, f) for f in feed_types}, max_polls)
    done = {"published": 0, "dead": 0, "quarantined": 0}

    def send(files: DataFrame) -> None:
        for f in feed_types:
            good, broken = feed.split(feed.decoded(files.where(F.col("feed") == f), f).persist())
            for k, n in publish(good, key(), f, log, failed_at).items():
                done[k] += n
            done["quarantined"] += broken.count()

    if speed <= 0:
        send(found)
        return done
    times = [r.poll_epoch for r in found.select("poll_epoch").distinct().orderBy("poll_epoch").collect()]  # a number a poll
    for at, wait in zip(times, waits(times, speed)):
        sleep(wait)
        send(found.where(F.col("poll_epoch") == at))
    return done


def subscribe(spark: SparkSession, log: str, topic: str, schema: str, max_files: int = 100) -> DataFrame:
    """The topic's values as a stream, from its beginning; how far it was read is the query's checkpoint."""
    rows = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", max_files).json(f"{log}/{topic}")
    return rows.select("key", F.from_json("value", schema).alias("v")).select("key", "v.*")


def options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    """Of a broker's source or sink: idempotent, acknowledged by all, compressed."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "topic": topic, "startingOffsets": starting, "kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.compression.type": "lz4"}


class RateBudget:
    """At most so many calls in any window of seconds."""

    def __init__(self, most: int, window_s: int = 3600, clock: Callable[[], float] = time.time):
        self.most, self.window_s, self.clock, self.calls = most, window_s, clock, deque()

    def _now(self) -> float:
        now = self.clock()
        while self.calls and now - self.calls[0] > self.window_s:
            self.calls.popleft()
        return now

    @property
    def remaining(self) -> int:
        self._now()
        return self.most - len(self.calls)

    def wait_time(self) -> float:
        """Seconds until a call is allowed; half a second is added so that clocks may differ."""
        now = self._now()
        return 0.0 if len(self.calls) < self.most else self.window_s - (now - self.calls[0]) + 0.5

    def record(self) -> None:
        self.calls.append(self.clock())


def budget(df: DataFrame, keys: list[str], time_column: str, most: int, window_s: int = 3600) -> DataFrame:
    """What a rate budget says after each call in a log of calls: (recent, remaining, wait_s)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(time_column).rangeBetween(-window_s, 0)
    out = df.withColumns({"recent": F.count(F.lit(1)).over(w), "_first": F.min(time_column).over(w)})
    full = F.col("recent") >= most
    return out.withColumns({"remaining": most - F.col("recent"), "wait_s": F.when(full, window_s - (F.col(time_column) - F.col("_first")) + 0.5).otherwise(0.0)}).drop("_first")
