"""Output tables and writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import codes, fixed
from muster.operators import joins


def stage_vehicles(assigned: DataFrame, *, as_of: dt.date) -> DataFrame:
    return assigned.select(
        "vehicle", "vehicle_type", F.lit("true").alias("active"), F.lit(as_of).alias("effective_start")
    )


def expected_table(assigned: DataFrame) -> DataFrame:
    """Units with an expected type, and the keys of type and vehicle."""
    air = F.substring("default_vehicle", 1, 2) == "C-"
    return assigned.where(F.col("expected_type").isNotNull()).select(
        "generic",
        F.col("expected_type").alias("expected_unit_type"),
        "default_vehicle",
        F.concat(F.lit("UT_"), F.col("expected_type")).alias("expected_unit_type_key"),
        F.concat(F.when(air, "UT_Air_").otherwise("UT_"), F.col("default_vehicle")).alias("default_vehicle_key"),
    )


def assignment_keys(rows: DataFrame, types: DataFrame) -> DataFrame:
    """One row per unit with its key and expected type; undefined types drop.

    ``types`` holds one setting.
    """
    units = rows.select("unid", "grouped_unit").distinct()
    return (
        units.join(types, "grouped_unit")
        .where(F.col("expected_type") != fixed.UNDEFINED_TYPE)
        .select(
            F.concat(F.lit("LUT_"), F.col("unid")).alias("external_key"),
            F.col("expected_type").alias("expected_vehicle_type_key"),
            "grouped_unit", "unid",
        )
    )


def undefined_types(rows: DataFrame, types: DataFrame) -> DataFrame:
    """Units for which no type could be found, for the report."""
    units = rows.select("unid", "grouped_unit").distinct()
    return units.join(types, "grouped_unit").where(F.col("expected_type") == fixed.UNDEFINED_TYPE).select(
        F.concat(F.lit("LUT_"), F.col("unid")).alias("external_key"), "grouped_unit"
    )


def expected_changes(assignments: DataFrame, stored: DataFrame) -> DataFrame:
    """Inserts for keys not stored, updates for stored keys with another type.

    A stored key whose type is missing is an update, so it is not stored twice.
    """
    old = stored.select(F.col("lut_key").alias("_key"), F.col("expected_vehicle_type_key").alias("old_type"))
    action = F.when(F.col("_key").isNull(), "insert").when(
        ~F.col("old_type").eqNullSafe(F.col("expected_vehicle_type_key")), "update"
    )
    return (
        assignments.join(old, assignments["external_key"] == old["_key"], "left")
        .withColumn("action", action)
        .where(F.col("action").isNotNull())
        .select("action", "grouped_unit", "external_key", "expected_vehicle_type_key", "old_type")
    )


def stored_after(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored table with the changes applied, to be written as a new
    version: updated keys keep their group, inserted ones bring theirs."""
    updates = changes.where("action = 'update'").select(
        F.col("external_key").alias("lut_key"), F.col("expected_vehicle_type_key").alias("_new")
    )
    kept = stored.join(updates, "lut_key", "left").select(
        "grouped_unit_name", "lut_key",
        F.coalesce("_new", "expected_vehicle_type_key").alias("expected_vehicle_type_key"),
    )
    added = changes.where("action = 'insert'").select(
        F.col("grouped_unit").alias("grouped_unit_name"), F.col("external_key").alias("lut_key"),
        "expected_vehicle_type_key",
    )
    return joins.union_same(kept, added)


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    """A total sort for a report; a range shuffle, spread over all tasks."""
    return df.orderBy(*order)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)
