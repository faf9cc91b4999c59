"""How well expected types predict later shifts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions import codes, fixed
from muster.operators import expected, joins
from muster.operators.expected import PRODUCTION_TYPE
from muster.session import cut, tasks_for


def backtest_monthly(cells: DataFrame, *, k: int = 30, threshold: float = 0.5, weeks: int = 4,
                     rank: Column | None = None, rows: int | None = None) -> DataFrame:
    """Every four weeks: learn from all shifts up to the date, predict the next
    four weeks. One row per step with running totals.

    Cells (date, generic, vehicle_type, n) are reduced to day counts and
    checkpointed, as bounds, training and scoring all read them. A day serves
    only the steps at which it is among the unit's newest k days, so it is
    repeated for those steps alone, not for every later one, and a
    (unit, step) group holds at most k days. Steps are counted from the first
    date. Units are dealt out to as many tasks as there are day counts for, and
    cells before by ``rows``, what they were counted from or a bound above their
    number, so a task's memory does not grow with the table.
    """
    if rank is None:
        rank = codes.listed_rank(F.col("vehicle_type"))
    stride = 7 * weeks
    dealt = cells.select("generic", "date", "vehicle_type", "n")
    if rows is not None:
        dealt = dealt.repartition(tasks_for(cells.sparkSession, rows), "generic", "date")
    counts = cut(dealt.groupBy("generic", "date", "vehicle_type").agg(F.sum("n").alias("n")))
    start = counts.select(F.min("date")).scalar()
    end = counts.select(F.max("date")).scalar()
    # Number of the first step at or after a date.
    step_from = F.ceil(F.date_diff("date", start) / stride).cast("int")
    last_step = F.floor(F.date_diff(end, start) / stride).cast("int")

    # The list holds one entry per type of that day.
    by_unit = counts.repartition(tasks_for(cells.sparkSession, counts.count()), "generic")
    days = by_unit.groupBy("generic", "date").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("vehicle_type", F.col("n").alias("m"))).alias("types")
    )
    by_date = Window.partitionBy("generic").orderBy("date")
    until = F.lead("date", k).over(by_date)
    days = days.withColumn("_until", until)
    before_until = F.ceil(F.date_diff("_until", start) / stride).cast("int") - 1
    first_step = F.greatest(F.lit(1), step_from)
    final_step = F.coalesce(before_until, last_step)
    training = days.where(first_step <= final_step).select(
        "generic", "date", "n", "types", F.explode(F.sequence(first_step, final_step)).alias("step")
    )
    recent = expected.within_last_k(training, k, keys=["generic", "step"])
    learnt = recent.select("generic", "step", F.inline("types")).groupBy("generic", "step", "vehicle_type").agg(
        F.sum("m").alias("n")
    )
    predicted = expected.decide(learnt, threshold, rank, keys=["generic", "step"])

    # Step s predicts the days after it up to and including the next step.
    seen = counts.withColumn("step", step_from - 1).where("step >= 1")
    seen = seen.groupBy("generic", "step", "vehicle_type").agg(F.sum("n").alias("n"))
    scored = (
        seen.join(predicted, ["generic", "step"])
        .groupBy("step")
        .agg(
            F.sum("n").alias("shifts"),
            F.sum(F.when(F.col("vehicle_type") == F.col("expected_type"), F.col("n")).otherwise(0)).alias("matches"),
        )
    )
    spine = cells.sparkSession.range(0, 1, 1, 1).select(
        F.explode(F.sequence(F.lit(1), last_step)).alias("step"), start.alias("_start")
    )
    # One row per step: bounded by the calendar.
    upto = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = spine.join(scored, "step", "left").na.fill(0, ["shifts", "matches"])
    running = {"total_shifts": F.sum("shifts").over(upto), "total_matches": F.sum("matches").over(upto)}
    return filled.withColumns(running).select(
        F.col("step").cast("bigint").alias("step"),
        F.date_add("_start", F.col("step") * stride).alias("learnt_to"),
        "shifts", "matches", "total_shifts", "total_matches",
        F.try_divide("total_matches", "total_shifts").alias("share"),
    )


def split_rows(rows: DataFrame, shifts: DataFrame, cutoff: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Training and test rows. Units without a training row are added to the
    training rows as new ones, so they get their default."""
    at = F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")
    train = rows.where(F.col("cdts2") <= at)
    test = rows.where(F.col("cdts2") > at)
    fresh = joins.anti_missing(shifts.select("unit_name", "cad_unit_type"), "unit_name", train, "unid")
    fresh = expected.with_defaults(fresh.withColumnRenamed("unit_name", "unid").withColumns(
        {"carid": F.lit(None).cast("string"), "cdts2": F.lit(None).cast("timestamp_ntz"),
         PRODUCTION_TYPE: F.lit(None).cast("string"), "appended": F.lit(1)}
    ))
    return train.unionByName(fresh), test


def setting_grid(settings: Sequence[tuple[int, float]]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.lit(float(share)).alias("threshold"))
            for k, share in settings
        ]
    )


def holdout_rows(rows: DataFrame, shifts: DataFrame, *, cutoff: dt.datetime,
                 settings: Sequence[tuple[int, float]] = ((7, 0.5),)) -> DataFrame:
    """Test counts by (setting, day, unit, actual type) with the expected type.

    Test logons are counted before settings multiply them. Expected types are
    computed for all settings in one pass over the training rows.
    """
    train, test = split_rows(rows, shifts, cutoff)
    types = expected.production_types(train, settings).select("grouped_unit", "k", "threshold", "expected_type")
    units = train.select("unid", "grouped_unit").distinct()
    known = units.join(types, "grouped_unit").where(F.col("expected_type") != fixed.UNDEFINED_TYPE)
    counted = test.groupBy("unid", F.to_date("cdts2").alias("day"), PRODUCTION_TYPE).agg(F.count("*").alias("n"))
    return counted.select("*", F.inline(setting_grid(settings))).join(
        known.drop("grouped_unit"), ["unid", "k", "threshold"], "left"
    )


def match_counts(scored: DataFrame, *keys: str) -> DataFrame:
    """Matches, mismatches, unknown vehicles and undefined types by the keys."""
    both = F.col(PRODUCTION_TYPE).isNotNull() & F.col("expected_type").isNotNull()
    same = F.col(PRODUCTION_TYPE) == F.col("expected_type")

    def total(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(0))

    return scored.groupBy(*keys).agg(
        F.sum("n").alias("logons"),
        total(both & same).alias("matches"),
        total(both & ~same).alias("mismatches"),
        total(F.col(PRODUCTION_TYPE).isNull()).alias("unknown_vehicle"),
        total(F.col("expected_type").isNull()).alias("undefined_type"),
    )


def match_metrics(scored: DataFrame, *keys: str) -> DataFrame:
    """Counts and their rounded percentages."""
    parts = ["matches", "mismatches", "unknown_vehicle", "undefined_type"]
    return match_counts(scored, *keys).withColumns(
        {f"{part}_percent": codes.percent(F.col(part), F.col("logons")) for part in parts}
    )


def daily_metrics(scored: DataFrame) -> DataFrame:
    """Matches and mismatches by setting and day, days without logons included."""
    counts = match_counts(scored, "k", "threshold", "day").drop("unknown_vehicle", "undefined_type")
    # One row per setting spans its days.
    spans = counts.groupBy("k", "threshold").agg(F.min("day").alias("_from"), F.max("day").alias("_to"))
    spine = spans.select("k", "threshold", F.explode(F.sequence("_from", "_to")).alias("day"))
    filled = spine.join(counts, ["k", "threshold", "day"], "left").na.fill(0, ["logons", "matches", "mismatches"])
    return filled.withColumns(
        {f"{part}_percent": codes.percent(F.col(part), F.col("logons")) for part in ["matches", "mismatches"]}
    )
