"""Row selections on vehicles, units and shifts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import codes, fixed


def numeric_vehicles(df: DataFrame, column: str = "carid") -> DataFrame:
    return df.where(F.col(column).rlike("^[0-9]+$"))


def in_service_fleet(fleet: DataFrame, *, out_of_service: str = "Decom", require_active: bool = True,
                     test_vehicles: Sequence[str] = fixed.TEST_VEHICLES) -> DataFrame:
    """Fleet records still in service: no decommissioned vehicles, trailers,
    golf carts or test entries."""
    if require_active:
        fleet = fleet.where("is_active")
    return fleet.where(
        ~codes.blank(F.col("classification")).startswith(out_of_service)
        & (codes.blank(F.col("decommission_date")) == "")
        & ~codes.blank(F.col("stock_level")).startswith(out_of_service)
        & ~codes.blank(F.col("classification")).startswith("Trailer")
        & ~codes.blank(F.col("vehicle_type")).rlike("(?i)^golf")
        & ~F.col("vehicle_id").isin(list(test_vehicles))
    )


def in_service_fleet_legacy(fleet: DataFrame, **changes) -> DataFrame:
    """The contractor rules: a longer prefix and no activity flag."""
    return in_service_fleet(fleet, out_of_service="Decommis", require_active=False, **changes)


def road_units(df: DataFrame, column: str = "unid", *, dash: bool = True) -> DataFrame:
    """Drop codes that are not road units. ``dash`` asks for the dash before
    the unit digit; the contractor rules do not."""
    code = codes.blank(F.col(column))
    return df.where(
        ~code.startswith("XV")
        & ~code.startswith("FRD")
        & ~code.rlike(("-" if dash else "") + r"\d[XYVUROKJIGF]\d+$")
        & ~code.rlike(r"^\p{Upper}{4}\d$")
    )


def _running(as_of: dt.date) -> Column:
    return (F.col("active_inactive") == "Active") & (
        (codes.blank(F.col("effective_end")) == "")
        | (codes.date_of(F.col("effective_end")) > F.lit(as_of))
    )


def active_shifts(shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    """Active shifts without an end date or ending after ``as_of``."""
    return shifts.where(_running(as_of))


def service_split(shifts: DataFrame, *, as_of: dt.date,
                  contracted: Sequence[str] = fixed.CONTRACTED_SERVICES,
                  direct: str = fixed.DIRECT_SERVICE) -> DataFrame:
    """Active shifts marked ``contr`` or ``direct``; other services drop out."""
    label = F.when(F.col("service_type").isin(list(contracted)), "contr").when(
        F.col("service_type") == direct, "direct"
    )
    return (
        active_shifts(shifts, as_of=as_of)
        .withColumn("service_class", label)
        .where(F.col("service_class").isNotNull())
    )


def contracted_shifts(shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return service_split(shifts, as_of=as_of).where("service_class = 'contr'").drop("service_class")


def direct_shifts(shifts: DataFrame, *, as_of: dt.date) -> DataFrame:
    return service_split(shifts, as_of=as_of).where("service_class = 'direct'").drop("service_class")


def recent_fleet(fleet: DataFrame, active: DataFrame, *, as_of: dt.date, days: int = 365) -> DataFrame:
    """Vehicles seen in dispatch, put into service lately or of a recent model year."""
    since = as_of - dt.timedelta(days=days)
    seen = active.select(F.col("name").alias("_seen")).distinct()
    return (
        fleet.join(seen, fleet["vehicle_id"] == seen["_seen"], "left")
        .where(
            F.col("_seen").isNotNull()
            | (codes.date_of(F.col("in_service_date")) > F.lit(since))
            | (F.col("year") >= since.year)
        )
        .drop("_seen")
    )


def fleet_suvs(fleet: DataFrame, *, models: Sequence[str] = fixed.SUV_MODELS,
               classes: Sequence[str] = fixed.SUV_CLASSES, types: Sequence[str] = fixed.SUV_CLASSES,
               stock: Sequence[str] = fixed.SUV_STOCK, division: str = fixed.SUV_DIVISION) -> DataFrame:
    """Fleet records with the words that mark an SUV. The type words default
    to the class words, as the rule runs today."""
    return fleet.where(
        codes.matches_any(F.col("model"), models)
        | codes.matches_any(F.col("classification"), classes)
        | codes.matches_any(F.col("vehicle_type"), types)
        | codes.matches_any(F.col("division"), [division])
        | codes.matches_any(F.col("stock_level"), stock)
    )


def suv_units(history: DataFrame) -> DataFrame:
    """Logons of SUV crews on vehicles whose id is neither 4 long nor 9xx."""
    return history.where(
        F.col("unid").rlike(r"-\d[PSDMLW]\d+$")
        & (F.length("carid") != 4)
        & ~F.col("carid").rlike(r"^9\d{2}$")
    )


def ambulance_units(df: DataFrame, column: str = "unid") -> DataFrame:
    return df.where(F.col(column).rlike(codes.AMBULANCE_CODE))


def short_vehicles(df: DataFrame, column: str = "carid", *, longest: int = 4) -> DataFrame:
    return df.where(F.length(column) <= longest)


def units_of_kind(shifts: DataFrame, kinds: Sequence[str]) -> DataFrame:
    return shifts.where(F.col("cad_unit_type").isin(list(kinds)))


def ground_units(shifts: DataFrame, *, kinds: Sequence[str] = fixed.GROUND_KINDS) -> DataFrame:
    """Active ground shifts with their generic unit code."""
    return units_of_kind(shifts.where(F.col("active_inactive") == "Active"), kinds).withColumn(
        "generic", codes.generic_unit(F.col("unit_name"))
    )


def air_units(shifts: DataFrame, *, kinds: Sequence[str] = fixed.AIR_KINDS) -> DataFrame:
    """Active aircraft shifts; the generic code is the unit code."""
    return units_of_kind(shifts.where(F.col("active_inactive") == "Active"), kinds).withColumn(
        "generic", F.col("unit_name")
    )


def planned_units(shifts: DataFrame, *, transfer: Sequence[str] = fixed.TRANSFER_AGENCIES,
                  mixed: Sequence[str] = fixed.MIXED_AGENCIES,
                  cities: Sequence[str] = fixed.CITY_GROUPS) -> DataFrame:
    """Shifts planned by system: transfer agencies but no air crew, and mixed
    agencies outside the cities."""
    return shifts.where(
        (F.col("agency").isin(list(transfer)) & (F.col("type") != fixed.AIR_CREW))
        | (F.col("agency").isin(list(mixed)) & ~F.substring("unit_name", 1, 4).isin(list(cities)))
    )


def crew_shift_filter(shifts: DataFrame, *, apply_filter: bool = True,
                      weekend_units: Sequence[str] = fixed.WEEKEND_UNITS,
                      kinds: Sequence[str] = fixed.CREWED_KINDS) -> DataFrame:
    """Named units on weekends only, all others by kind. The production run
    computes this and keeps every row: ``apply_filter=False`` does the same."""
    if not apply_filter:
        return shifts
    named = F.col("unit_name").isin(list(weekend_units))
    return shifts.where(
        (named & (F.col("days") == "Weekend")) | (~named & F.col("cad_unit_type").isin(list(kinds)))
    )


def known_pairs(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))
