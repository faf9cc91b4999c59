"""Which vehicles does each contractor run, and what are they asked?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from muster.operators import contractors, filters, forms, joins, usage
from muster.session import cut
from muster.sources import quality


def contracted_units(shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return filters.road_units(filters.contracted_shifts(shifts, as_of=as_of), "unit_name", dash=False)


def direct_units(shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return filters.road_units(filters.direct_shifts(shifts, as_of=as_of), "unit_name", dash=False)


def road_uses(history: DataFrame) -> DataFrame:
    return filters.road_units(usage.unit_uses(history), "carid", dash=False)


def contracted_of(uses: DataFrame, shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return joins.keyed_inner(uses, contracted_units(shifts, as_of=as_of).select("unit_name", "service"))


def direct_of(uses: DataFrame, shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return joins.keyed_inner(uses, direct_units(shifts, as_of=as_of).select("unit_name", "service"))


def contracted_uses(history: DataFrame, shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return contracted_of(road_uses(history), shifts, as_of=as_of)


def direct_uses(history: DataFrame, shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return direct_of(road_uses(history), shifts, as_of=as_of)


def vehicles(history: DataFrame, shifts: DataFrame, legacy: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Vehicle list of each contractor. Uses are written once, so history is read once."""
    legacy = quality.checked(legacy, "legacy_vehicles")
    uses = cut(road_uses(history))
    return contractors.contractor_vehicles(
        contracted_of(uses, shifts, as_of=as_of), direct_of(uses, shifts, as_of=as_of), legacy
    )


def reports(uses: DataFrame, contracted: DataFrame, direct: DataFrame, shifts: DataFrame, *, as_of: dt.date,
            fleet: DataFrame | None = None) -> dict[str, DataFrame]:
    """What to ask contractors about: units without a logon, vehicles seldom used,
    used by several groups or services, shared with direct delivery and, given
    the fleet register, known to the fleet."""
    found = {
        "silent_units": contractors.alternate_unit(contracted_units(shifts, as_of=as_of), uses),
        "infrequent": usage.infrequent_vehicles(contracted),
        "several_groups": contractors.multi_group_vehicles(contracted),
        "several_services": contractors.multi_service_vehicles(contracted),
        "shared": contractors.shared_with_direct(contracted, direct),
    }
    if fleet is not None:
        found["known_to_fleet"] = contractors.fleet_known_vehicles(contracted, filters.in_service_fleet(fleet))
    return found


def run(history: DataFrame, shifts: DataFrame, legacy: DataFrame, *, as_of: dt.date,
        fleet: DataFrame | None = None) -> dict[str, DataFrame]:
    """Vehicle list with classes, the rows of both survey forms, and the reports.

    All uses are written once, so history is read once. The contracted ones
    serve the list and the classes, the classed list both forms. Reports are
    computed when read. Registers pass their gates.
    """
    legacy = quality.checked(legacy, "legacy_vehicles")
    fleet = fleet if fleet is None else quality.checked(fleet, "fleet_assets")
    uses = cut(usage.unit_uses(history))
    road = filters.road_units(uses, "carid", dash=False)
    contracted = cut(contracted_of(road, shifts, as_of=as_of))
    direct = direct_of(road, shifts, as_of=as_of)
    listed = contractors.contractor_vehicles(contracted, direct, legacy)
    classed = cut(listed.join(contractors.vehicle_class(contracted), "carid"))
    return {
        "vehicles": classed,
        "ambulance_form": forms.ambulance_form(classed),
        "transport_form": forms.transport_form(classed),
        **reports(uses, contracted, direct, shifts, as_of=as_of, fleet=fleet),
    }
