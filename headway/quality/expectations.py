"""Checks of tables: each yields (name, status, measured, n); too few rows make it unmeasured, not passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _result(agg: DataFrame, name: str, measured: Column, ok: Column | None, floor: int) -> DataFrame:
    status = F.when(F.col("n") < floor, "UNMEASURED").when(F.lit(ok is None), "INFO").when(F.lit(True) if ok is None else F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL")
    return agg.select(F.lit(name).alias("name"), status.alias("status"), measured.cast("double").alias("measured"), F.col("n").cast("long").alias("n"))


def none_violate(df: DataFrame, name: str, violates: Column, floor: int = 1) -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(violates, F.lit(False))).alias("bad"))
    return _result(agg, name, F.col("bad"), F.col("bad") == 0, floor)


def not_null(df, column, floor=1):
    return none_violate(df, f"{column} not null", F.col(column).isNull(), floor)


def accepted_values(df, column, values, floor=1):
    return none_violate(df, f"{column} accepted", F.col(column).isNotNull() & ~F.col(column).isin(*values), floor)


def accepted_range(df, column, low, high, floor=1):
    return none_violate(df, f"{column} in range", ~F.col(column).between(low, high), floor)


def unique(df: DataFrame, columns: list[str], floor: int = 1) -> DataFrame:
    """measured: rows beyond one for each key."""
    agg = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("bad"))
    return _result(agg, f"{'+'.join(columns)} unique", F.col("bad"), F.col("bad") == 0, floor)


def share_below(df: DataFrame, name: str, condition: Column, most: float, floor: int = 1) -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias("share"))
    return _result(agg, name, F.col("share"), F.col("share") < most, floor)


def fresh(df: DataFrame, column: str, now: int, hours: int) -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.max(column).alias("last"))
    return _result(agg, f"{column} fresh", (F.lit(now) - F.col("last")) / 3600, F.lit(now) - F.col("last") <= hours * 3600, 1)


def same_rows(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Two runs over the same input give the same rows."""
    diff = a.exceptAll(b).unionAll(b.exceptAll(a)).agg(F.count(F.lit(1)).alias("bad"))
    agg = a.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(diff))  # one row each
    return _result(agg, name, F.col("bad"), F.col("bad") == 0, 1)


def info(df: DataFrame, name: str, measure: Column) -> DataFrame:
    return _result(df.agg(F.count(F.lit(1)).alias("n"), measure.alias("m")), name, F.col("m"), None, 0)


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
