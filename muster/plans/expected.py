"""Expected type and default vehicle of every unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import fixed
from muster.operators import assign, evaluate, expected, filters, joins, publish, usage
from muster.operators import study as study_steps
from muster.operators.study import study_cells
from muster.session import cut
from muster.sources import tables


def recent_ground(history: DataFrame, shifts: DataFrame, types: DataFrame, *, k: int = 30) -> DataFrame:
    """Newest k logons of every active ground unit with vehicle type."""
    return expected.recent_logons(history, filters.ground_units(shifts), types, k)


def ground_uses(history: DataFrame, shifts: DataFrame) -> DataFrame:
    """Uses of all ground units over all history by (generic, vehicle)."""
    units = filters.ground_units(shifts).select("unit_name", "generic")
    known = joins.history_shifts(usage.unit_uses(history), units)
    return known.groupBy("generic", "carid").agg(F.sum("n").alias("n"))


def study(history: DataFrame, shifts: DataFrame, types: DataFrame, *, kinds=fixed.STUDY_GROUND_KINDS,
          cities=fixed.CITY_GROUPS) -> DataFrame:
    """Study cells: shifts of system-planned ground units with a known type."""
    planned = filters.planned_units(filters.ground_units(shifts, kinds=kinds), cities=cities)
    return study_cells(history, planned, types)


def study_report(history: DataFrame, shifts: DataFrame, types: DataFrame, *, kinds=fixed.STUDY_GROUND_KINDS,
                 cities=fixed.CITY_GROUPS, matrix: Sequence[str] = (), k: int = 30,
                 threshold: float = 0.5) -> dict[str, DataFrame]:
    """The whole study: how often types occur and change, how long they last, and how well
    defaults per letter, per group and by monthly update would have done.

    Cells, transitions and runs are written once and every table reads from them.
    ``matrix`` names the types of the transition matrix; without them it is left out.
    """
    cells = cut(study(history, shifts, types, kinds=kinds, cities=cities))
    rows = cells.count()
    steps, runs = cut(study_steps.type_transitions(cells, rows=rows)), cut(study_steps.type_runs(cells, rows=rows))
    found = {
        "type_frequency": study_steps.type_frequency(cells),
        "types_per_unit": study_steps.types_per_unit_histogram(cells),
        "types_per_unit_later": study_steps.types_per_unit_later(runs),
        "transitions": study_steps.transition_share(steps),
        "change_rate": study_steps.change_rate(steps),
        "run_lengths": study_steps.run_histogram(runs),
        "long_runs": study_steps.long_runs(runs),
        "types_per_group": study_steps.types_per_group_histogram(cells),
        "dominant_type": study_steps.dominant_type(cells),
        "rule_accuracy": study_steps.rule_accuracy(cells),
        "monthly_update": evaluate.backtest_monthly(cells, k=k, threshold=threshold, rows=rows),
    }
    if matrix:
        found["transition_matrix"] = study_steps.transition_matrix(steps, matrix)
    return found


def first_pass(history: DataFrame, shifts: DataFrame, types: DataFrame, *, k: int = 30,
               threshold: float = 0.6) -> dict[str, DataFrame]:
    """Types, vehicles taken in turn, and the uses both build on.

    The recent logons and the uses are checkpointed: the history is read once
    for each, and the rounds of the assignment start from what was written.
    """
    recent = cut(recent_ground(history, shifts, types, k=k))
    uses = cut(ground_uses(history, shifts))
    order = assign.unit_order(uses)
    types_by_unit = expected.expected_type(recent, threshold=threshold)
    taken = assign.default_vehicle(recent, types_by_unit, order)
    return {"types": types_by_unit, "taken": taken, "order": order, "uses": uses}


def ground_assignments(history: DataFrame, shifts: DataFrame, types: DataFrame, *, k: int = 30,
                       threshold: float = 0.6) -> DataFrame:
    """Type and vehicle of each ground unit."""
    done = first_pass(history, shifts, types, k=k, threshold=threshold)
    return assign.default_vehicle_fill(done["types"], done["taken"], done["order"], done["uses"], types)


def run(history: DataFrame, shifts: DataFrame, types: DataFrame, *aircraft: DataFrame, k: int = 30,
        threshold: float = 0.6) -> DataFrame:
    """The published table: ground units and the aircraft sheets."""
    ground = ground_assignments(history, shifts, types, k=k, threshold=threshold).drop("source")
    sheets = [
        tables.sheet_assignments(sheet).withColumnRenamed("expected_unit_type", "expected_type")
        for sheet in aircraft
    ]
    return publish.expected_table(joins.union_fill(ground, *sheets))
