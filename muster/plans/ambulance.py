"""Which type does each in-house ambulance have?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.operators import filters, fleet, joins, publish, usage
from muster.sources import quality


def uses(history: DataFrame, shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Uses by direct-delivery ambulance crews of numeric ids of at most four digits."""
    all_uses = usage.unit_uses(history)
    kept = filters.short_vehicles(filters.ambulance_units(filters.numeric_vehicles(all_uses)))
    direct = filters.ambulance_units(filters.direct_shifts(shifts, as_of=as_of), "unit_name")
    return joins.semi_in(kept, "unid", direct, "unit_name")


def described(history: DataFrame, shifts: DataFrame, assets: DataFrame, mapping: DataFrame,
              legacy: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Routine vehicles with fleet record, mapped unit type and legacy type. Registers pass their gates."""
    assets, legacy = quality.checked(assets, "fleet_assets"), quality.checked(legacy, "legacy_vehicles")
    routine = usage.routine_vehicles(usage.usage_counts(uses(history, shifts, as_of=as_of)))
    with_record = joins.routine_fleet(routine, filters.in_service_fleet(assets))
    return joins.legacy_types(joins.config_lookup(with_record, mapping), legacy)


def run(history: DataFrame, shifts: DataFrame, assets: DataFrame, mapping: DataFrame, legacy: DataFrame,
        overrides: DataFrame, *, as_of: dt.date) -> dict[str, DataFrame]:
    """Staging rows, open gaps and vehicles with neither mapping nor legacy type."""
    choice = fleet.vehicle_type_choice(described(history, shifts, assets, mapping, legacy, as_of=as_of))
    valid = fleet.apply_overrides(choice, overrides)
    return {
        "staging": publish.stage_vehicles(valid, as_of=as_of),
        "gaps": joins.anti_missing(choice.where("outcome = 'gap'"), "vehicle", overrides, "vehicle"),
        "unmapped": choice.where(F.col("outcome") == "unmapped"),
    }
