"""Default vehicle of each unit.

Units take vehicles in order from a shared pool. A unit first takes its most
used recent vehicle of the expected type that no earlier unit has taken. Units
left over take the next free listed vehicle of that type, and when none is
left, a duplicate of the vehicle they used most.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from muster.operators import joins, usage
from muster.operators.numbering import number_rows
from muster.session import cut


def unit_order(uses: DataFrame) -> DataFrame:
    """Order of units: lowest vehicle id used, then the unit code. ``uses`` has
    one row per (generic, vehicle)."""
    return uses.groupBy("generic").agg(F.min("carid").alias("_first")).select(
        "generic", F.struct(F.col("_first"), F.col("generic").alias("_unit")).alias("turn")
    )


def candidates(recent: DataFrame, expected: DataFrame, order: DataFrame) -> DataFrame:
    """Recent vehicles of the expected type per unit, with use and the unit's turn."""
    wanted = expected.where(F.col("expected_type").isNotNull()).select("generic", "expected_type")
    used = recent.where(F.col("carid").isNotNull()).groupBy("generic", "carid", "vehicle_type")
    return (
        used.agg(F.count("*").alias("n"))
        .join(wanted, "generic")
        .where("vehicle_type = expected_type")
        .join(order, "generic")
        .select("generic", "turn", "carid", F.struct(-F.col("n"), F.col("carid")).alias("liking"))
    )


def _round(state: DataFrame) -> DataFrame:
    """One round over open choices: each unit asks for the best vehicle it has left.

    A vehicle keeps the choices up to its earliest asker: later units will not get
    it any more, whatever comes. An asker that is the earliest of all units with the
    vehicle still among their choices has it for good, and its other choices go.
    """
    unit, vehicle = Window.partitionBy("generic"), Window.partitionBy("carid")
    asked = state.withColumns({"_best": F.min("liking").over(unit), "_settled": F.max("final").over(unit)})
    asked = asked.where("final OR NOT _settled").withColumn("_asks", F.col("liking") == F.col("_best"))
    held = asked.withColumns({
        "_holder": F.min(F.when(F.col("_asks"), F.col("turn"))).over(vehicle), "_earliest": F.min("turn").over(vehicle),
    })
    left = held.where(F.col("_holder").isNull() | (F.col("turn") <= F.col("_holder")))
    return left.select("generic", "turn", "carid", "liking",
                       (F.col("_asks") & (F.col("turn") == F.col("_earliest"))).alias("final"))


def default_vehicle(recent: DataFrame, expected: DataFrame, order: DataFrame, *, rounds_per_cut: int = 4,
                    watch: Callable[[int], None] | None = None) -> DataFrame:
    """Vehicles taken in turn: columns generic, default_vehicle.

    The result is that of the one-by-one walk, reached from all units at once. The
    state is the open frontier: choices that can still come true. A choice goes
    when an earlier unit asks for its vehicle, and a unit that nobody can displace
    leaves with its vehicle. The earliest unit left always settles, so the state
    ends empty; ``watch`` is told the open choices after each step.

    A unit brings at most the vehicles of its recent logons. Each step is
    checkpointed to the shared folder and counts its open choices as it is written.
    """
    state = candidates(recent, expected, order).withColumn("final", F.lit(False))
    settled: DataFrame | None = None
    while True:
        for _ in range(rounds_per_cut):
            state = _round(state)
        gone = F.max("final").over(Window.partitionBy("generic"))
        state = state.withColumn("_settled", gone).where("final OR NOT _settled").drop("_settled")
        counted = Observation()
        state = cut(state.observe(counted, F.count_if(~F.col("final")).alias("open")))
        done = state.where("final").select("generic", F.col("carid").alias("default_vehicle"))
        settled = done if settled is None else settled.unionByName(done)
        still_open = counted.get["open"]
        if watch:
            watch(still_open)
        if not still_open:
            return settled
        state = state.where("NOT final")


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Matches of one slice of vehicles in code order: each goes to the waiting unit
    of its types whose turn comes first. ``rows`` holds the slice's vehicles, a row per
    type, and the units it may reach, by type and place."""
    queues, heads, picks = {}, {}, []
    for name, units in rows[rows["vehicle"].isna()].sort_values("place").groupby("vehicle_type"):
        queues[name] = list(zip(units["first"].isna().eq(False), units["first"].fillna(""), units["unit"]))
        heads[name] = 0
    vehicles = rows[rows["vehicle"].notna()].sort_values("vehicle")
    for vehicle, names in vehicles.groupby("vehicle", sort=True)["vehicle_type"]:
        waiting = [(queues[n][heads[n]], n) for n in names if n in queues and heads[n] < len(queues[n])]
        if waiting:
            (_, _, unit), name = min(waiting)
            heads[name] += 1
            picks.append((rows["slice"].iloc[0], name, unit, vehicle))
    return pd.DataFrame(picks, columns=["slice", "vehicle_type", "generic", "vehicle"])


def _serve_tangled(queue: DataFrame, free: DataFrame, size: int, watch: Callable[[int], None] | None) -> DataFrame:
    """Units and the vehicles they take, where vehicles stand in the lists of several types.

    Units take vehicles in code order, vehicles go to units in turn order. With both
    orders common to all, the walk over the units and the walk over the vehicles give
    the same pairs, and a vehicle only needs the first waiting unit of each of its
    types. So vehicles are dealt into slices of ``size`` by code; a slice is walked in
    one task from the number of units of each type served before it. All slices are
    walked at once from assumed numbers; those whose numbers turn out different are
    walked again. Slices from the first one on become final with each round, and a
    wrong start soon makes no difference, as whoever is ahead waits for the others.
    """
    codes = number_rows(free.select("vehicle").distinct(), [], ["vehicle"])
    listed = cut(free.join(codes, "vehicle").select("vehicle", "vehicle_type",
                                                    F.floor((F.col("place") - 1) / size).alias("slice")))
    # At most `size` vehicles a type and slice.
    parts = listed.groupBy("vehicle_type", "slice").agg(F.count("*").alias("listed"))
    guess = listed.groupBy("vehicle", "slice").agg(F.min("vehicle_type").alias("vehicle_type"))
    taken = guess.groupBy("vehicle_type", "slice").agg(F.count("*").alias("taken"))
    before = Window.partitionBy("vehicle_type").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    schema = "slice long, vehicle_type string, generic string, vehicle string"
    starts = matched = None
    while True:
        served = parts.join(taken, ["vehicle_type", "slice"], "left")
        begun = F.coalesce(F.sum(F.coalesce("taken", F.lit(0))).over(before), F.lit(0))
        now = cut(served.select("vehicle_type", "slice", "listed", begun.alias("begun")))
        if starts is None:
            todo = listed.select("slice").distinct()
        else:
            then = starts.select("vehicle_type", "slice", F.col("begun").alias("_then"))
            moved = now.join(then, ["vehicle_type", "slice"]).where("begun <> _then")
            todo = cut(moved.select("slice").distinct())
        wrong = todo.count()
        if watch:
            watch(wrong)
        if not wrong and matched is None:  # no free vehicle at all
            return queue.limit(0).select("generic", F.lit(None).cast("string").alias("_free"))
        if not wrong:
            return matched.select("generic", F.col("vehicle").alias("_free"))
        reach = now.join(todo, "slice", "left_semi").withColumn(
            "place", F.explode(F.sequence(F.col("begun") + 1, F.col("begun") + F.col("listed"))))
        units = reach.join(queue, ["vehicle_type", "place"]).select(
            "slice", "vehicle_type", "place", F.col("_first").alias("first"), F.col("generic").alias("unit"),
            F.lit(None).cast("string").alias("vehicle"))
        rows = units.unionByName(listed.join(todo, "slice", "left_semi"), allowMissingColumns=True)
        walked = rows.groupBy("slice").applyInPandas(_walk, schema)
        if matched is not None:
            walked = walked.unionByName(matched.join(todo, "slice", "left_anti"))
        alone = matched is None and wrong == 1
        matched, starts = cut(walked), now
        if alone:  # the first slice starts from nothing served, which is right
            if watch:
                watch(0)
            return matched.select("generic", F.col("vehicle").alias("_free"))
        taken = matched.groupBy("vehicle_type", "slice").agg(F.count("*").alias("taken"))


def _serve(waiting: DataFrame, free: DataFrame, listed: DataFrame, size: int,
           watch: Callable[[int], None] | None) -> DataFrame:
    """Units and the free vehicles they take in turn: generic, _free. Types whose vehicles
    are all ``listed`` under one type are matched by number."""
    queue = number_rows(waiting, ["expected_type"], ["_first", "_unit"]).withColumnRenamed("expected_type", "vehicle_type")
    several = listed.groupBy("vehicle").agg(F.collect_set("vehicle_type").alias("_types")).where(F.size("_types") > 1)
    tangled = cut(several.select(F.explode("_types").alias("vehicle_type")).distinct())
    if tangled.isEmpty():
        stock = number_rows(free, ["vehicle_type"], ["vehicle"])
        return queue.join(stock, ["vehicle_type", "place"]).select("generic", F.col("vehicle").alias("_free"))
    queue = cut(queue)
    stock = number_rows(free.join(tangled, "vehicle_type", "left_anti"), ["vehicle_type"], ["vehicle"])
    served = queue.join(stock, ["vehicle_type", "place"]).select("generic", F.col("vehicle").alias("_free"))
    rest = cut(free.join(tangled, "vehicle_type", "left_semi"))
    return served.unionByName(_serve_tangled(queue, rest, size, watch))


def default_vehicle_fill(expected: DataFrame, first: DataFrame, order: DataFrame, uses: DataFrame,
                         types: DataFrame, *, slice_size: int = 10_000,
                         watch: Callable[[int], None] | None = None) -> DataFrame:
    """Vehicles for all units: columns generic, expected_type, default_vehicle
    and source (own, free, duplicate, none).

    Units and free vehicles are numbered within each type and joined by number. A
    vehicle listed under several types goes to the unit whose turn comes first; the
    types it ties together are settled in slices of ``slice_size`` vehicles, and
    ``watch`` is told the slices to walk before each round.
    """
    units = expected.select("generic", "expected_type").join(first, "generic", "left")
    waiting = units.where("default_vehicle IS NULL AND expected_type IS NOT NULL").select("generic", "expected_type")
    waiting = waiting.join(order, "generic").select("generic", "expected_type", "turn._first", "turn._unit")
    free = joins.anti_missing(types.distinct(), "vehicle", first, "default_vehicle")
    free = free.where("vehicle_type IS NOT NULL AND vehicle IS NOT NULL")
    # A type nobody waits for needs no numbers.
    free = joins.semi_in(free, "vehicle_type", waiting, "expected_type")
    served = _serve(waiting, free, types, slice_size, watch)
    usual = usage.most_used_vehicle(uses).select("generic", "most_used")
    filled = units.join(served, "generic", "left").join(usual, "generic", "left")
    none = F.col("expected_type").isNull()
    return filled.select(
        "generic", "expected_type",
        F.when(none, F.lit(None)).otherwise(F.coalesce("default_vehicle", "_free", "most_used")).alias("default_vehicle"),
        F.when(none, "none")
        .when(F.col("default_vehicle").isNotNull(), "own")
        .when(F.col("_free").isNotNull(), "free")
        .otherwise("duplicate")
        .alias("source"),
    )
