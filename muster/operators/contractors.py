"""Vehicles run by contractors.

The inputs ``contracted`` and ``direct`` are uses (see usage.unit_uses) joined
with their shifts: unit, vehicle, logons, last logon and service.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.functions import codes, fixed
from muster.operators import joins, usage
from muster.session import small_table


def alternate_unit(shifts: DataFrame, history: DataFrame) -> DataFrame:
    """Units that never logged on, and whose A/B twin did not either."""
    units = history.select("unid").distinct()
    silent = joins.anti_missing(shifts, "unit_name", units, "unid")
    silent = silent.withColumn("alt", codes.twin_unit(F.col("unit_name")))
    return joins.anti_missing(silent, "alt", units, "unid")


def multi_group_vehicles(contracted: DataFrame) -> DataFrame:
    """Use by (group, vehicle) of vehicles seen in more than one group."""
    by_group = (
        contracted.withColumn("dgroup", codes.capital_group(F.col("unid")))
        .groupBy("dgroup", "carid")
        .agg(
            F.sum("n").alias("n"), F.to_date(F.max("last_logon")).alias("last_logon"),
            usage.text_list("unid").alias("units"), usage.text_list("service").alias("services"),
        )
    )
    # One row per group of the vehicle; an unreadable group counts as one.
    groups = Window.partitionBy("carid")
    return (
        by_group.withColumn("_groups", F.count(F.lit(1)).over(groups))
        .where("_groups > 1")
        .drop("_groups")
    )


def multi_service_vehicles(contracted: DataFrame) -> DataFrame:
    """Use by (service, vehicle) of vehicles seen in more than one service."""
    services = Window.partitionBy("carid")
    return (
        usage.vehicle_summary(contracted, "service")
        .withColumn("_services", F.count(F.lit(1)).over(services))
        .where("_services > 1")
        .drop("_services")
    )


def attach_group_max(pairs: DataFrame) -> DataFrame:
    """Each (service, vehicle) row with the vehicle's top count and last date.

    The window sees one row per service, never logons.
    """
    whole = Window.partitionBy("carid")
    return pairs.withColumns(
        {"max_n": F.max("n").over(whole), "max_last": F.max("last_logon").over(whole)}
    )


def losing_services(pairs: DataFrame) -> DataFrame:
    """(vehicle, service) pairs under the vehicle's top count; ties all stay."""
    return attach_group_max(pairs).where("n <> max_n").select("carid", "service")


def shared_with_direct(contracted: DataFrame, direct: DataFrame) -> DataFrame:
    """Contracted vehicles that direct delivery used too, both counts side by side."""
    both = joins.suffix_join(usage.vehicle_summary(contracted), usage.vehicle_summary(direct), "carid")
    return both.where(F.col("n_d").isNotNull())


def fleet_known_vehicles(contracted: DataFrame, fleet: DataFrame) -> DataFrame:
    """Contracted vehicles that the in-service fleet lists. Summed up by vehicle
    before the fleet is looked up."""
    return joins.semi_in(usage.vehicle_summary(contracted), "carid", fleet, "vehicle_id")


def direct_majority(contracted: DataFrame, direct: DataFrame,
                    invalid: Sequence[str] = fixed.INVALID_CONTRACT_VEHICLES) -> DataFrame:
    """Vehicles used more by direct delivery than by contractors, and the
    listed invalid ones."""
    theirs = contracted.groupBy("carid").agg(F.sum("n").alias("n_c"))
    ours = direct.groupBy("carid").agg(F.sum("n").alias("n_d"))
    more = theirs.join(ours, "carid").where("n_d > n_c").select("carid")
    listed = small_table(contracted.sparkSession, ["carid"], [(vehicle,) for vehicle in invalid])
    return more.union(listed).distinct()


def contractor_vehicles(contracted: DataFrame, direct: DataFrame, legacy: DataFrame,
                        invalid: Sequence[str] = fixed.INVALID_CONTRACT_VEHICLES) -> DataFrame:
    """Vehicle list per contractor: counts, last date, units and last unit;
    without vehicles direct delivery uses more and without losing services.

    The unit that logged on last is the lowest code among those of the last
    date. ``is_new`` marks vehicles missing from the legacy list.
    """
    latest_first = F.struct(-F.unix_date(F.to_date("last_logon")), F.col("unid"))
    pairs = contracted.groupBy("service", "carid").agg(
        F.sum("n").alias("n"), F.to_date(F.max("last_logon")).alias("last_logon"),
        usage.text_list("unid").alias("units"), F.min_by("unid", latest_first).alias("last_unit"),
    )
    # A vehicle of one service has no other service to lose to, so the winners
    # are the rows at the vehicle's top count. The vehicle's total over its
    # services stands beside it, so contracted uses are read once.
    whole = Window.partitionBy("carid")
    kept = pairs.withColumns({"_most": F.max("n").over(whole), "_all": F.sum("n").over(whole)})
    kept = kept.where((F.col("n") == F.col("_most")) & ~F.col("carid").isin(list(invalid)))
    ours = direct.groupBy(F.col("carid").alias("_direct")).agg(F.sum("n").alias("_n_d"))
    kept = kept.join(ours, kept["carid"] == ours["_direct"], "left").where(
        F.col("_n_d").isNull() | (F.col("_n_d") <= F.col("_all"))
    )
    known = legacy.select(F.col("ehs_number").alias("_known")).distinct()
    return kept.join(known, kept["carid"] == known["_known"], "left").select(
        *pairs.columns, F.when(F.col("_known").isNull(), 1).otherwise(0).alias("is_new")
    )


def vehicle_class(contracted: DataFrame) -> DataFrame:
    """Class of each vehicle from the letter of its most used unit.

    ``unit_class`` is null for a letter not listed; ``warning`` names an id
    shape unusual for the class.
    """
    counts = contracted.groupBy("carid", "unid").agg(F.sum("n").alias("n"))
    top = counts.groupBy("carid").agg(
        F.min_by("unid", F.struct(-F.col("n"), F.col("unid"))).alias("top_unit")
    )
    four = F.length("carid") == 4
    first = F.substring("carid", 1, 1)
    odd = (
        F.when(F.col("unit_class").isNull(), "unknown unit letter")
        .when((F.col("unit_class") == "AMB") & ~four, "unusual ambulance id")
        .when((F.col("unit_class") == "NAT") & four & (first != "8"), "unusual transport id")
        .when((F.col("unit_class") == "SUV") & four & ~first.isin("8", "1"), "unusual SUV id")
        .otherwise("")
    )
    return top.withColumn("unit_class", codes.unit_class(F.col("top_unit"))).withColumn("warning", odd)


def class_counts(classes: DataFrame) -> DataFrame:
    return classes.groupBy("unit_class").agg(F.count("*").alias("vehicles"))
