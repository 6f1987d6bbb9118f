"""Event contracts as expressions: what is wrong with a row, and where it goes then."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import CONTRACT_VERSION, ERROR_CHARS

#: Fields of an event that must be above zero, at least zero, or in a range, if they are there.
POSITIVE = ("feed_header_ts_epoch", "trip_update_ts_epoch", "vehicle_report_ts_epoch", "arrival_time_epoch", "departure_time_epoch", "report_epoch")
NOT_NEGATIVE = ("arrival_uncertainty", "departure_uncertainty", "stop_sequence")
RANGES = {"latitude": (-90, 90), "longitude": (-180, 180)}


def rules(columns: list[str]) -> dict[str, Column]:
    """Reason: condition that breaks the contract, for the columns that there are."""
    out = {}
    if "service_date" in columns:
        out["service_date is not YYYYMMDD"] = F.col("service_date").isNotNull() & ~F.col("service_date").rlike("^[0-9]{8}$")
    out |= {f"{c} is not above zero": F.col(c) <= 0 for c in POSITIVE if c in columns}
    out |= {f"{c} is negative": F.col(c) < 0 for c in NOT_NEGATIVE if c in columns}
    out |= {f"{c} is out of range": ~F.col(c).between(a, b) for c, (a, b) in RANGES.items() if c in columns}
    return out


def unknown_fields(df: DataFrame, known: list[str]) -> list[str]:
    """Columns that the contract forbids."""
    return sorted(set(df.columns) - set(known))


def wrong_types(json: Column, schema: dict[str, str]) -> Column:
    """Fields of a JSON object whose value is of another type than the contract's: a number in quotes is no number."""
    shape = {"string": '^"', "bigint": "^-?[0-9]+$", "int": "^-?[0-9]+$", "double": r"^-?[0-9.]+(?:[eE][+-]?[0-9]+)?$", "boolean": "^(?:true|false)$"}
    parts = F.from_json(json, "map<string,string>")
    quoted = lambda c: json.rlike(rf'"{c}"\s*:\s*"')
    bad = []
    for c, kind in schema.items():
        v = F.try_element_at(parts, F.lit(c))
        wrong = quoted(c) | ~v.rlike(shape[kind]) if kind != "string" else ~quoted(c)
        bad.append(F.when(v.isNotNull() & wrong, F.lit(f"{c} is no {kind}")))
    return F.filter(F.array(*bad), lambda x: x.isNotNull())


def violations(df: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    checks = rules(df.columns) | (more or {})
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(reason)) for reason, c in checks.items()]), lambda x: x.isNotNull())
    return df.withColumn("violations", found)


def split(df: DataFrame, more: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with violations)."""
    checked = violations(df, more)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def dead_letters(bad: DataFrame, topic: str, failed_at: str) -> DataFrame:
    """(topic, reason, error, contract_version, failed_at, raw)."""
    raw = F.to_json(F.struct(*[c for c in bad.columns if c != "violations"]))
    return bad.select(F.lit(topic).alias("topic"), F.lit("contract_violation").alias("reason"), F.left(F.array_join("violations", "; "), F.lit(ERROR_CHARS)).alias("error"), F.lit(CONTRACT_VERSION).alias("contract_version"), F.lit(failed_at).cast("timestamp").alias("failed_at"), raw.alias("raw"))


def event(df: DataFrame, envelope: list[str], trip: list[str], payload: list[str]) -> DataFrame:
    """The nested event: envelope, trip, payload."""
    return df.select(F.struct(*envelope).alias("envelope"), F.struct(*trip).alias("trip"), *payload)


def keyed(df: DataFrame, key: Column) -> DataFrame:
    """(key, value): events as JSON for a keyed log."""
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
