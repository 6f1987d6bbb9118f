"""Catalyst expressions of the domain. Null in, null out, unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.constants import AGENCY_TZ, EARLY_S, LATE_S, LEAD_BUCKETS, LEAD_EDGES


def gtfs_seconds(value: Column) -> Column:
    """Seconds from the service day's start of a time that may pass 24 hours; null if malformed, never zero."""
    t = F.trim(value)
    part = lambda i: F.split_part(t, F.lit(":"), F.lit(i)).try_cast("long")
    return F.when(t.rlike("^[0-9]{1,3}:[0-5][0-9]:[0-5][0-9]$"), part(1) * 3600 + part(2) * 60 + part(3))


def service_day_start(service_date: Column, tz: str = AGENCY_TZ) -> Column:
    """Epoch of local noon less twelve hours, which daylight saving doesn't move; null for what is no date."""
    noon = F.try_to_timestamp(F.concat(service_date, F.lit(" 12:00:00")), F.lit("yyyyMMdd HH:mm:ss"))
    return F.when(service_date.rlike("^[0-9]{8}$"), F.unix_timestamp(F.to_utc_timestamp(noon, tz)) - 43200)


def scheduled_epoch(service_date: Column, gtfs_time: Column, tz: str = AGENCY_TZ) -> Column:
    return service_day_start(service_date, tz) + gtfs_seconds(gtfs_time)


def agency_of(*ids: Column, otherwise: str = "UNKNOWN") -> Column:
    """What stands before the colon of the first id that has one, else `otherwise`: ALL in profiles of a feed."""
    return F.coalesce(*[F.when(x.contains(":"), F.substring_index(x, ":", 1)) for x in ids], F.lit(otherwise))


def on_time(delay_s: Column) -> Column:
    return delay_s.between(EARLY_S, LATE_S)


def lead_bucket(lead_s: Column) -> Column:
    """The name of the left-closed bucket; null for negative leads."""
    out = F.lit(None).cast("string")
    for edge, name in zip(LEAD_EDGES, LEAD_BUCKETS):
        out = F.when(lead_s >= edge, F.lit(name)).otherwise(out)
    return out


def lead_order(lead_s: Column) -> Column:
    """The bucket's number, so that an order by it isn't alphabetical."""
    return sum((F.when(lead_s >= e, 1).otherwise(0) for e in LEAD_EDGES), F.lit(-1)).cast("long")


def epoch_to_iso(epoch: Column) -> Column:
    """UTC text of an epoch above zero."""
    return F.when(epoch > 0, F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def iso_to_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def local(ts: Column, tz: str = AGENCY_TZ) -> Column:
    return F.from_utc_timestamp(ts, tz)


def dedup_key(*parts: Column) -> Column:
    """32 hex digits that identify a row; nulls count as None."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256), 1, 32)


def attribute_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]), 256)


def partition_key(service_date: Column, trip_id: Column) -> Column:
    """The key that keeps a trip's events in order."""
    return F.concat_ws(":", F.coalesce(service_date, F.lit("nodate")), F.coalesce(trip_id, F.lit("notrip")))


def poll_epoch(path: Column) -> Column:
    """The epoch in an archived payload's name; null if the name has another form."""
    found = F.regexp_extract(path, r"([0-9]{10})-[0-9a-f]{8}\.pb\.gz$", 1)
    return F.nullif(found, F.lit("")).try_cast("long")


def redact(text: Column, secret: str | None = None) -> Column:
    """The text without API keys: a given one of eight characters or more, and any that follows api_key=."""
    if secret and len(secret) >= 8:
        text = F.replace(text, F.lit(secret), F.lit("***"))
    return F.regexp_replace(text, r"""(api_key=)[^&\s"')]+""", "$1***")
