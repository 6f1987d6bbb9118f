"""The jobs as assets with what they are made of, and the checks that must hold before the next one runs."""

from __future__ import annotations

from argparse import Namespace
from collections.abc import Callable
from graphlib import TopologicalSorter

from pyspark.sql import SparkSession

from headway import cli
from headway.constants import GRAIN
from headway.operators.schedule import gaps
from headway.operators.tables import VersionedTable
from headway.quality import expectations as E
from headway.sources import static

#: Asset: (job, feed, what it is made of).
ASSETS: dict[str, tuple[str, str | None, tuple[str, ...]]] = {
    "bronze_positions": ("bronze", "vehicle_positions", ()),
    "bronze_updates": ("bronze", "trip_updates", ()),
    "silver_positions": ("silver", "vehicle_positions", ("bronze_positions",)),
    "silver_updates": ("silver", "trip_updates", ("bronze_updates",)),
    "arrivals": ("gold", None, ("silver_positions",)),
    "timetable": ("schedule", None, ()),
    "otp": ("otp", None, ("arrivals", "timetable")),
    "marts": ("marts", None, ("otp",)),
    "store": ("export", None, ("marts",)),
}


def _one_row_a_grain(spark: SparkSession, lake: str):
    return E.unique(VersionedTable(spark, f"{lake}/gold/arrivals").read(), list(GRAIN))


def _versions_tile(spark: SparkSession, lake: str):
    dim = VersionedTable(spark, f"{lake}/dim/schedule").read()
    bad = gaps(dim, static.KEYS).select("valid_to")
    return E.report(E.unique(dim.where("is_current"), static.KEYS), E.none_violate(bad, "versions tile", bad["valid_to"].isNotNull(), 0))


def _delays_are_plausible(spark: SparkSession, lake: str):
    return E.accepted_range(VersionedTable(spark, f"{lake}/gold/otp").read(), "delay_s", -86_400, 86_400)


CHECKS: dict[str, Callable] = {"arrivals": _one_row_a_grain, "timetable": _versions_tile, "otp": _delays_are_plausible}


def order(wanted: list[str] | None = None) -> list[str]:
    """The assets, each after what it is made of; of some wanted, those and what they need."""
    need, todo = set(), list(wanted or ASSETS)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo += ASSETS[name][2]
    return [a for a in TopologicalSorter({k: v[2] for k, v in ASSETS.items()}).static_order() if a in need]


def materialise(spark: SparkSession, args: Namespace, data: dict[str, str], wanted: list[str] | None = None) -> dict[str, dict]:
    """Runs the assets' jobs in order; data has the input folder of assets that aren't made of others. A check that fails
    stops the run; one that is unmeasured doesn't."""
    done = {}
    for name in order(wanted):
        job, feed, _ = ASSETS[name]
        given = {"feed": feed} if feed else {}
        given |= {"data": data[name]} if name in data else {}
        done[name] = cli.JOBS[job](spark, Namespace(**(vars(args) | given)))
        if name in CHECKS:
            failed = [r.name for r in CHECKS[name](spark, args.lake).collect() if r.status == "FAIL"]
            if failed:
                raise RuntimeError(f"{name}: {', '.join(failed)}")
    return done
