"""How vehicle types change over time, and how well simple rules predict them.

All operators read cells: one row per (date, unit, vehicle) with the number of
shifts, counted before any join, so the joins with shifts and types never see
single logons and a unit or vehicle with a large share of them shrinks first.

Consecutive shifts of a generic unit are ordered by (date, vehicle, type);
shifts equal in all three are interchangeable, so n equal shifts are n - 1
unchanged steps. The order is read in slices of one calendar period per unit
and the slices' edges are stitched, so no task sorts the whole history of a
unit, however large that unit is. Slices are dealt out once; ``rows``, what the
cells were counted from or a bound above their number, says to how many tasks,
so a task's memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.functions import codes, fixed
from muster.operators import joins
from muster.session import tasks_for

ORDER = ["date", "carid", "vehicle_type"]


def study_cells(history: DataFrame, shifts: DataFrame, types: DataFrame) -> DataFrame:
    """Shifts with a known type, counted: date, unit, generic unit, vehicle,
    type, district, unit letter, dispatch group and n. ``shifts`` carry the
    generic code."""
    days = history.groupBy("unid", F.to_date("cdts2").alias("date"), "carid").agg(F.count("*").alias("n"))
    units = shifts.select("unit_name", "generic", "district")
    typed = joins.history_types(joins.history_shifts(days, units), types)
    return typed.where(F.col("vehicle_type").isNotNull()).select(
        "date", "unid", "generic", "carid", "vehicle_type", "district",
        codes.unit_letter(F.col("unid")).alias("letter"),
        F.substring("generic", 1, 4).alias("dgroup"), "n",
    )


def type_frequency(cells: DataFrame) -> DataFrame:
    return cells.groupBy("vehicle_type").agg(F.sum("n").alias("n"))


def types_per_unit(cells: DataFrame) -> DataFrame:
    return cells.groupBy("generic").agg(F.count_distinct("vehicle_type").alias("types"))


def types_per_unit_histogram(cells: DataFrame) -> DataFrame:
    return types_per_unit(cells).groupBy("types").agg(F.count("*").alias("units"))


def types_per_unit_later(runs: DataFrame) -> DataFrame:
    """Types of each unit after its first shift, counted over ``type_runs``: a unit
    whose first type never returns has one type less than in ``types_per_unit``,
    one of a single shift is absent."""
    return runs.groupBy("generic").agg(F.count_distinct("vehicle_type").alias("types"))


def with_kind(cells: DataFrame) -> DataFrame:
    """Unit letter with A and B merged."""
    return cells.withColumn(
        "kind", F.when(F.col("letter").isin("A", "B"), "A/B").otherwise(F.col("letter"))
    )


def types_per_group(cells: DataFrame) -> DataFrame:
    return with_kind(cells).groupBy("dgroup", "kind").agg(F.count_distinct("vehicle_type").alias("types"))


def types_per_group_histogram(cells: DataFrame) -> DataFrame:
    return types_per_group(cells).groupBy("types").agg(F.count("*").alias("groups"))


def dominant_type(cells: DataFrame) -> DataFrame:
    """Most used type by (group, kind); lowest code on a tie."""
    counts = with_kind(cells).groupBy("dgroup", "kind", "vehicle_type").agg(F.sum("n").alias("n"))
    return counts.groupBy("dgroup", "kind").agg(
        F.min_by("vehicle_type", F.struct(-F.col("n"), F.col("vehicle_type"))).alias("dominant"),
        F.max("n").alias("n"),
    )


def _sliced(cells: DataFrame, period: str, rows: int | None) -> DataFrame:
    sliced = cells.select("generic", F.trunc("date", period).alias("slice"), *ORDER, "n")
    if rows is not None:
        sliced = sliced.repartition(tasks_for(cells.sparkSession, rows), "generic", "slice")
    return sliced.groupBy("generic", "slice", *ORDER).agg(F.sum("n").alias("n"))


def type_transitions(cells: DataFrame, *, period: str = "month", rows: int | None = None) -> DataFrame:
    """Count by (current type, type of the shift before).

    A slice is reduced to its counts by pair of types, its first and its last
    type. The step between two slices is added when they are stitched.
    """
    inside = Window.partitionBy("generic", "slice").orderBy(*ORDER)
    name = F.col("vehicle_type")
    nothing = F.lit(None).cast("string")
    one = F.lit(1).cast("bigint")

    def step(curr, prev, n):
        return F.struct(curr.alias("curr"), prev.alias("prev"), n.alias("n"))

    stepped = _sliced(cells, period, rows).select(
        "generic", "slice", "vehicle_type", "n",
        F.lag("vehicle_type").over(inside).alias("_before"), F.lead("vehicle_type").over(inside).alias("_after"),
    )
    # A missing previous type marks the slice's first row, a missing current
    # type its last one.
    last = F.when(F.col("_after").isNull(), step(nothing, name, one))
    parts = F.array_compact(F.array(step(name, name, F.col("n") - 1), step(name, F.col("_before"), one), last))
    pairs = (
        stepped.select("generic", "slice", F.inline(parts))
        .where("n > 0")
        .groupBy("generic", "slice", "curr", "prev")
        .agg(F.sum("n").alias("n"))
    )
    whole = F.col("curr").isNotNull() & F.col("prev").isNotNull()
    slices = pairs.groupBy("generic", "slice").agg(
        F.collect_list(F.when(whole, F.struct("curr", "prev", "n"))).alias("steps"),
        F.max(F.when(F.col("prev").isNull(), F.col("curr"))).alias("first"),
        F.max(F.when(F.col("curr").isNull(), F.col("prev"))).alias("last"),
    )
    across = Window.partitionBy("generic").orderBy("slice")
    between = F.array(step(F.col("first"), F.lag("last").over(across), one))
    return (
        slices.select("steps", between.alias("between"))
        .select(F.inline(F.concat("steps", "between")))
        .where("prev IS NOT NULL")
        .groupBy("curr", "prev")
        .agg(F.sum("n").alias("n"))
    )


def transition_share(transitions: DataFrame) -> DataFrame:
    """Count over the sum by current type. One row per pair of types."""
    whole = Window.partitionBy("curr")
    total = F.sum("n").over(whole)
    return transitions.select("curr", "prev", "n", total.alias("total"), (F.col("n") / total).alias("share"))


def transition_matrix(transitions: DataFrame, types: Sequence[str]) -> DataFrame:
    """Row percentages by current type, a column per previous type.

    A previous type that is not in ``types`` stops the job: without its column
    the row would no longer add up to 100.
    """
    unlisted = F.raise_error(F.concat(F.lit("type without a column: "), "prev")).cast("string")
    share = transition_share(transitions).withColumn("_pct", F.bround("share", 3) * 100)
    share = share.withColumn("prev", F.when(F.col("prev").isin(*types), F.col("prev")).otherwise(unlisted))
    return share.groupBy("curr").pivot("prev", list(types)).agg(F.first("_pct")).na.fill(0.0)


def change_rate(transitions: DataFrame) -> DataFrame:
    """Number of changes and their share of all steps."""
    return transitions.agg(
        F.coalesce(F.sum(F.when(F.col("curr") != F.col("prev"), F.col("n"))), F.lit(0)).alias("changes"),
        F.sum("n").alias("steps"),
    ).withColumn("percent", F.try_divide("changes", "steps") * 100)


def type_runs(cells: DataFrame, *, period: str = "month", rows: int | None = None) -> DataFrame:
    """Lengths of runs of one type per unit, the unit's first shift left out.

    A unit's cells are summed up slice by slice as (first run, last run, closed runs).
    Closed runs are final and go out as they are, one row each. Two summaries merge into
    one by joining the last run of the one to the first of the other where their types
    agree, so only the two outer runs of a slice meet those of the unit's other slices.
    No row and no task holds a slice's or a unit's runs as a list.
    """
    inside = Window.partitionBy("generic", "slice").orderBy(*ORDER)
    changed = F.when(F.col("vehicle_type") == F.lag("vehicle_type").over(inside), 0).otherwise(1)
    marked = _sliced(cells, period, rows).withColumn("_change", changed)
    numbered = marked.withColumn(
        "run", F.sum("_change").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    runs = numbered.groupBy("generic", "slice", "run").agg(
        F.first("vehicle_type").alias("vehicle_type"), F.sum("n").alias("length")
    )
    # The window follows the aggregate's partitioning; both branches read one shuffle.
    runs = runs.withColumn("_last", F.max("run").over(Window.partitionBy("generic", "slice")))
    closed = runs.where("run > 1 AND run < _last").select("generic", "vehicle_type", "length")
    outer = runs.where("run = 1 OR run = _last")
    across = Window.partitionBy("generic").orderBy("slice", "run")
    joined = (F.col("vehicle_type") == F.lag("vehicle_type").over(across)) & (
        F.col("slice") != F.lag("slice").over(across)
    )
    outer = outer.withColumn("_change", F.when(joined, 0).otherwise(1))
    outer = outer.withColumn(
        "_run", F.sum("_change").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    merged = outer.groupBy("generic", "_run").agg(
        F.first("vehicle_type").alias("vehicle_type"), F.sum("length").alias("_sum")
    )
    length = F.col("_sum") - F.when(F.col("_run") == 1, 1).otherwise(0)
    merged = merged.select("generic", "vehicle_type", length.alias("length")).where("length > 0")
    return closed.unionByName(merged)


def long_runs(runs: DataFrame, *, longer_than: int = 5) -> DataFrame:
    return runs.where(F.col("length") > longer_than)


def run_histogram(runs: DataFrame, *, width: int = 5) -> DataFrame:
    start = (F.floor(F.col("length") / width) * width).alias("from_length")
    return runs.groupBy(start).agg(F.count("*").alias("runs"))


def rule_accuracy(cells: DataFrame, defaults=fixed.UNIT_KIND_DEFAULTS) -> DataFrame:
    """Share of shifts with the right type under two rules.

    ``letter``: the type assumed for the unit letter. ``group``: the most used
    type of the (group, kind). The first study divided the group rule's
    matches by the letter rule's rows; ``reference_share`` is that ratio.
    """
    table = F.create_map(*[F.lit(part) for pair in defaults for part in pair])
    assumed = F.try_element_at(table, F.col("letter"))
    by_type = with_kind(cells).groupBy("dgroup", "kind", "vehicle_type").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(assumed == F.col("vehicle_type"), F.col("n")).otherwise(0)).alias("hits"),
        F.sum(F.when(assumed.isNotNull(), F.col("n")).otherwise(0)).alias("covered"),
    )
    by_group = by_type.groupBy("dgroup", "kind").agg(
        F.max("n").alias("top"), *[F.sum(name).alias(name) for name in ("n", "hits", "covered")]
    )
    totals = by_group.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("top", "n", "hits", "covered")])
    rules = F.array(
        F.struct(F.lit("letter").alias("rule"), F.col("hits").alias("matches"), F.col("covered").alias("shifts")),
        F.struct(F.lit("group").alias("rule"), F.col("top").alias("matches"), F.col("n").alias("shifts")),
    )
    return totals.select("covered", F.inline(rules)).select(
        "rule", "matches", "shifts",
        F.try_divide("matches", "shifts").alias("share"),
        F.try_divide("matches", "covered").alias("reference_share"),
    )
