"""Vehicle type of each fleet vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import fixed
from muster.operators import filters, joins, usage

UNKNOWN = "UNKNOWN"


def mapping_seed(fleet: DataFrame, columns=tuple(fixed.CONFIG_COLUMNS)) -> DataFrame:
    """Distinct lower-cased set-ups of the ambulances in service. Lowered first,
    so set-ups that differ only in case appear once."""
    kept = filters.in_service_fleet(fleet).where(F.col("classification").startswith("AMB"))
    return kept.select(*[F.lower(name).alias(name) for name in columns]).distinct()


def new_vehicles(fleet: DataFrame, legacy: DataFrame) -> DataFrame:
    """Fleet records whose id no legacy vehicle has as its name."""
    return joins.anti_missing(fleet, "vehicle_id", legacy, "name")


def lost_vehicles(legacy: DataFrame, fleet: DataFrame) -> DataFrame:
    """Legacy vehicles whose name is no id of the fleet."""
    return joins.anti_missing(legacy, "name", fleet, "vehicle_id")


def vehicle_type_choice(vehicles: DataFrame, unknown: str = UNKNOWN) -> DataFrame:
    """Legacy type if there is one, else the mapped type.

    ``outcome`` is ``valid``, ``gap`` (mapped as unknown) or ``unmapped``
    (neither a legacy type nor a mapping, in no output of the report).
    """
    outcome = (
        F.when(F.col("updated").isNotNull(), "valid")
        .when(F.col("unit_type").isNull(), "unmapped")
        .when(F.col("unit_type") != unknown, "valid")
        .otherwise("gap")
    )
    return vehicles.select(
        F.col("carid").alias("vehicle"),
        F.coalesce("updated", "unit_type").alias("vehicle_type"),
        outcome.alias("outcome"),
    )


def apply_overrides(choice: DataFrame, overrides: DataFrame) -> DataFrame:
    """Close gaps with hand-checked types (columns vehicle, checked_type, one
    row per vehicle) and put the closed ones with the valid rows. Rows still
    open drop out. One left join, so the choice is computed once."""
    checked = overrides.select(F.col("vehicle").alias("_checked"), "checked_type")
    gap = F.col("outcome") == "gap"
    joined = choice.join(checked, gap & (F.col("vehicle") == F.col("_checked")), "left")
    return joined.where((F.col("outcome") == "valid") | (gap & F.col("_checked").isNotNull())).select(
        "vehicle", F.when(gap, F.col("checked_type")).otherwise(F.col("vehicle_type")).alias("vehicle_type")
    )


def suv_uses(history: DataFrame, shifts: DataFrame, *, as_of, since) -> DataFrame:
    """Uses of SUV crews since a date. Logons are counted before units are looked
    up, so a unit with a large share of them is one row per vehicle by then."""
    counted = filters.suv_units(usage.uses_since(history, since))
    return joins.semi_in(counted, "unid", filters.active_shifts(shifts, as_of=as_of), "unit_name")


def suv_assignments(history: DataFrame, shifts: DataFrame, fleet: DataFrame, *, as_of, since,
                    suv_type: str = fixed.SUV_TYPE) -> DataFrame:
    """Fleet SUVs, and vehicles SUV crews used lately that the fleet list lacks."""
    used = suv_uses(history, shifts, as_of=as_of, since=since)
    listed = filters.fleet_suvs(filters.in_service_fleet(fleet)).where(F.length("vehicle_id") != 4)
    routine = usage.recent_usage(used)
    missing = joins.anti_missing(routine, "carid", listed, "vehicle_id")
    return joins.union_same(
        listed.select(F.col("vehicle_id").alias("vehicle")), missing.select(F.col("carid").alias("vehicle"))
    ).withColumn("vehicle_type", F.lit(suv_type))
