"""Survey forms: the rows each contractor is asked to fill in, and the check of
the answers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions import codes, fixed


def field(heading: str) -> str:
    """Column name of a form heading."""
    return re.sub(r"[^0-9a-z]+", "_", heading.lower()).strip("_")


def form_labels(vehicles: DataFrame) -> DataFrame:
    """Folder of each service: its path label. Services of equal labels are told
    apart by their place among them, after a sign no label holds."""
    named = vehicles.select("service").distinct().withColumn("_label", codes.path_label(F.col("service")))
    place = F.row_number().over(Window.partitionBy("_label").orderBy("service"))
    numbered = F.concat("_label", F.lit("-"), place.cast("string"))
    return named.select("service", F.when(place == 1, F.col("_label")).otherwise(numbered).alias("form"))


def _form(vehicles: DataFrame, unit_class: str, headings: Sequence[str], examples: Sequence[tuple]) -> DataFrame:
    names = [field(heading) for heading in headings]
    filled = [F.col("carid"), F.col("last_logon").cast("string"), F.col("last_unit")]
    empty = [F.lit("") for _ in names[len(filled):]]
    rows = vehicles.where(F.col("unit_class") == unit_class).select(
        "service", F.lit(False).alias("is_example"),
        *[column.alias(name) for column, name in zip(filled + empty, names)],
    )
    shown = F.array(
        *[F.struct(*[F.lit(cell).alias(name) for cell, name in zip(row, names)]) for row in examples]
    )
    # Every service gets a form, so each form opens with the examples.
    heads = vehicles.select("service").distinct().select("service", F.lit(True).alias("is_example"), F.inline(shown))
    return heads.unionByName(rows).join(form_labels(vehicles), "service")


def ambulance_form(vehicles: DataFrame) -> DataFrame:
    """Rows of the ambulance forms. ``vehicles`` is the contractor list with
    the class of each vehicle."""
    return _form(vehicles, "AMB", fixed.AMBULANCE_FORM, fixed.AMBULANCE_EXAMPLES)


def transport_form(vehicles: DataFrame) -> DataFrame:
    return _form(vehicles, "NAT", fixed.TRANSPORT_FORM, fixed.TRANSPORT_EXAMPLES)


def write_forms(form: DataFrame, headings: Sequence[str], path: str) -> None:
    """One folder per service, its name in each row: examples first, then vehicles by id."""
    named = form.select(
        "form", "service", "is_example", *[F.col(field(heading)).alias(heading) for heading in headings]
    )
    order = ["form", F.desc("is_example"), headings[0]]
    # A range per task: a form with very many rows spreads over several files,
    # whose names keep the order.
    sorted_rows = named.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.drop("is_example").write.mode("overwrite").partitionBy("form").option("header", True).csv(path)


def _one_of(name: str, choices: Sequence[str]) -> Column:
    return (F.col(name) != "") & ~F.col(name).isin(list(choices))


def _whole(name: str, low: int, high: int) -> Column:
    number = F.col(name).try_cast("double")
    whole = number.isNotNull() & (number == F.floor(number)) & number.between(low, high)
    return (F.col(name) != "") & ~whole


def ambulance_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it. An empty cell is an open
    question, which only the stretcher type must not be."""
    choice = fixed.FORM_CHOICES
    return {
        "stock_level": _one_of("stock_level", choice["stock"]),
        "stretcher_config": _one_of("stretcher_config", choice["stretcher_config"]),
        "stretcher_mount_position": _one_of("stretcher_mount_position", choice["stretcher_mount"]),
        "stretcher_load_type": _one_of("stretcher_load_type", choice["stretcher_load"]),
        "stretcher_type": F.length("stretcher_type") == 0,
        "max_fixed_seats": _whole("max_fixed_seats_incl_driver", 0, 10),
        "max_folding_seats": _whole("max_folding_seats", 0, 10),
        "bariatric_level_1_capable": _one_of("bariatric_level_1_capable", choice["binary"]),
        "fits_isolette": _one_of("fits_isolette", choice["binary"]),
    }


def transport_rules() -> dict[str, Column]:
    return {
        "max_stretchers": _whole("max_stretchers", 0, 10),
        "max_wheelchairs": _whole("max_wheelchairs", 0, 10),
        "max_ambulatory_patients": _whole("max_ambulatory_patients", 0, 20),
        "mixed_use": _one_of("mixed_use", fixed.FORM_CHOICES["binary"]),
    }


def survey_check(answers: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Answers with the names of the rules they break."""
    broken = F.array_compact(F.array(*[F.when(test, name) for name, test in rules.items()]))
    text = {name for name, kind in answers.dtypes if kind == "string"}
    return answers.na.fill("", sorted(text)).withColumn("violations", broken)
