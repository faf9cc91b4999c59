"""Counts of vehicle use.

Logons are first reduced to uses: one row per (unit, vehicle) with the number
of logons and the last one. That step combines on the map side and comes before
every join, so a vehicle or unit that holds a large share of all logons shrinks
where it lies. All later steps read uses; the lists they build only ever see
distinct units or groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import codes
from muster.operators.numbering import running_sums


def text_list(column: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(column)), ";")


def unit_uses(history: DataFrame) -> DataFrame:
    """One row per (unit, vehicle): logons and last logon. Filters on unit or
    vehicle applied to the result reach the scan."""
    return history.groupBy("unid", "carid").agg(
        F.count("*").alias("n"), F.max("cdts2").alias("last_logon")
    )


def usage_counts(uses: DataFrame) -> DataFrame:
    """Logons and last logon by (dispatch group, vehicle)."""
    return (
        uses.withColumn("dgroup", codes.dispatch_group(F.col("unid")))
        .groupBy("dgroup", "carid")
        .agg(F.sum("n").alias("n"), F.max("last_logon").alias("last_logon"))
    )


def usage_order() -> list[Column]:
    """Sort of the usage report, for the writer."""
    return [F.desc("n"), F.desc("last_logon"), F.asc("dgroup"), F.asc("carid")]


def usage_ecdf(counts: DataFrame) -> DataFrame:
    """Share of (group, vehicle) pairs with at most n logons."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("pairs"))
    summed = running_sums(sizes, "n", "pairs", "upto", "everything")
    return summed.select("n", "pairs", (F.col("upto") / F.col("everything")).alias("share"))


def _vehicle_groups(counts: DataFrame) -> DataFrame:
    return counts.groupBy("carid").agg(text_list("dgroup").alias("dgroups"), F.sum("n").alias("n"))


def routine_vehicles(counts: DataFrame) -> DataFrame:
    """Vehicles logged on more than once by some group."""
    return _vehicle_groups(counts.where("n > 1"))


def rare_vehicles(counts: DataFrame) -> DataFrame:
    """Vehicles no group has logged on more than once.

    The same set as single uses minus the routine vehicles, found in one
    aggregate instead of an anti-join.
    """
    return (
        counts.groupBy("carid")
        .agg(text_list("dgroup").alias("dgroups"), F.sum("n").alias("n"), F.max("n").alias("_most"))
        .where("_most = 1")
        .drop("_most")
    )


def uses_since(history: DataFrame, since: dt.date) -> DataFrame:
    """Uses counted from logons after a date only."""
    return unit_uses(history.where(F.to_date("cdts2") > F.lit(since)))


def recent_usage(uses: DataFrame, *, at_least: int = 2) -> DataFrame:
    """Vehicles used at least twice. ``uses`` are those since the date asked for."""
    return uses.groupBy("carid").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


def vehicle_summary(uses: DataFrame, *keys: str) -> DataFrame:
    """Logons, last date and units by vehicle, or by (keys, vehicle)."""
    return uses.groupBy(*keys, "carid").agg(
        F.sum("n").alias("n"), F.to_date(F.max("last_logon")).alias("last_logon"), text_list("unid").alias("units")
    )


def infrequent_vehicles(uses: DataFrame, *, fewer_than: int = 5) -> DataFrame:
    """Vehicles with few logons. The report is sorted by the numeric id."""
    return vehicle_summary(uses).where(F.col("n") < fewer_than).withColumn(
        "sort_id", codes.whole_number(F.col("carid"))
    )


def most_used_vehicle(uses: DataFrame, unit: str = "generic") -> DataFrame:
    """Most used vehicle of each unit over all history; lowest id on a tie."""
    counts = uses.where(F.col("carid").isNotNull()).groupBy(unit, "carid").agg(F.sum("n").alias("n"))
    return counts.groupBy(unit).agg(
        F.min_by("carid", F.struct(-F.col("n"), F.col("carid"))).alias("most_used"),
        F.max("n").alias("n"),
    )
