"""The timetable as a slowly changing dimension, and the as-of join to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.constants import BEGINNING, FOREVER


def _same(keys: list[str], left: str, right: str):
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def classify(incoming: DataFrame, current: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """(keys, change): new, changed, same or missing, by null-safe comparison of the attributes."""
    i, c = incoming.withColumn("_in", F.lit(True)).alias("i"), current.withColumn("_cur", F.lit(True)).alias("c")
    j = i.join(c, _same(keys, "i", "c"), "full")
    differs = ~reduce(lambda a, b: a & b, [F.col(f"i.{a}").eqNullSafe(F.col(f"c.{a}")) for a in attributes])
    change = F.when(F.col("_cur").isNull(), "new").when(F.col("_in").isNull(), "missing").when(differs, "changed").otherwise("same")
    return j.select(*[F.coalesce(F.col(f"i.{k}"), F.col(f"c.{k}")).alias(k) for k in keys], change.alias("change"))


def unique_keys(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def open_versions(df: DataFrame, observed_at: str, seed: bool = False) -> DataFrame:
    """Rows as open versions, valid from the observation on, or from the beginning for a seeding load."""
    start = F.lit(BEGINNING if seed else observed_at).cast("timestamp")
    return df.select("*", start.alias("valid_from"), F.lit(FOREVER).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(seed).alias("valid_from_assumed"))


def upsert(dim: DataFrame | None, incoming: DataFrame, keys: list[str], attributes: list[str], observed_at: str, close_missing: bool = False, seed_backdate: bool = False) -> DataFrame:
    """The dimension after a snapshot: changed keys are closed and opened anew, new ones opened, the same left alone.

    Missing keys stay open unless close_missing. Versions are half open; history is never rewritten but for the end of
    the version that closes. incoming has unique keys.
    """
    incoming = incoming.select(*keys, *attributes)
    if dim is None:
        return open_versions(incoming, observed_at, seed_backdate)
    kinds = classify(incoming, dim.where("is_current"), keys, attributes)
    closing = kinds.where(F.col("change").isin(*(["changed", "missing"] if close_missing else ["changed"]))).select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_closes"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]) & F.col("is_current")
    ends = F.coalesce("_closes", F.lit(False))
    kept = dim.join(closing, on, "left").select(
        *keys, *attributes, "valid_from", F.when(ends, F.lit(observed_at).cast("timestamp")).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~ends).alias("is_current"), "valid_from_assumed"
    )
    opening = kinds.where("change in ('new', 'changed')").select(*[F.col(k).alias(f"_{k}") for k in keys])
    fresh = incoming.join(opening, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_semi")
    return kept.unionByName(open_versions(fresh, observed_at))


def backdate_first(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Each key's first version reaches back to the beginning and says so; adds version, from 1."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    out = dim.withColumn("version", F.row_number().over(w))
    first = F.col("version") == 1
    return out.withColumns({"valid_from_assumed": F.col("valid_from_assumed") | (first & (F.col("valid_from") > F.lit(BEGINNING).cast("timestamp"))), "valid_from": F.when(first, F.lit(BEGINNING).cast("timestamp")).otherwise(F.col("valid_from"))})


def as_of(facts: DataFrame, dim: DataFrame, keys: dict[str, str], at: str, columns: list[str]) -> DataFrame:
    """facts, each with `columns` of the version of its key (fact column: dim column) that is valid at column `at`.

    Left outer and half open: each fact stays once, unmatched ones with nulls. Equal keys lead the plan, so it is a hash
    or sort-merge join with the interval as a residual, not a range join.
    """
    d = dim.select(*[F.col(v).alias(f"_k_{v}") for v in keys.values()], F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *columns)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{v}") for k, v in keys.items()])
    on = on & (F.col("_from") <= F.col(at)) & (F.col(at) < F.col("_to"))
    return facts.join(d, on, "left").drop(*[f"_k_{v}" for v in keys.values()], "_from", "_to")


def gaps(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Versions that don't end where the key's next one begins."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    out = dim.withColumn("next_from", F.lead("valid_from").over(w))
    return out.where("next_from is not null and next_from <> valid_to")
