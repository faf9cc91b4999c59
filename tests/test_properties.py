"""Operators against plain sequential code on random small tables."""

import datetime as dt
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from helpers import rows
from muster.functions import fixed
from muster.operators import assign, evaluate, expected, study
from muster.operators.numbering import number_rows

RANK = {name: place for place, name in enumerate(fixed.TYPE_RANKING, 1)}
TYPES = ["AA002S", "AA002N", "SC113", "SC114"]


def decide(types, threshold):
    counts = {}
    for name in types:
        counts[name] = counts.get(name, 0) + 1
    top = min(counts, key=lambda name: (-counts[name], name))
    if counts[top] / len(types) > threshold:
        return top
    repeated = [name for name in counts if counts[name] > 1]
    return min(repeated, key=RANK.get) if repeated else None


def random_cells(seed, units=4, days=200, shifts=120):
    rng = random.Random(seed)
    car_type = {str(c): rng.choice(TYPES) for c in range(6)}
    out = []
    for u in range(units):
        for _ in range(shifts):
            car = str(rng.randrange(6)) if rng.random() < 0.5 else str(u)
            out.append((f"U{u}", dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(days)), car, car_type[car]))
    return out


def as_cells(spark, shifts):
    df = spark.createDataFrame(shifts, "generic string, date date, carid string, vehicle_type string")
    return df.groupBy(*df.columns).agg(F.count("*").alias("n"))


@pytest.mark.parametrize("seed", [1, 2])
def test_transitions_and_runs(spark, seed):
    shifts = sorted(random_cells(seed))
    steps, runs = {}, []
    for unit, group in groupby(shifts, key=lambda s: s[0]):
        types = [s[3] for s in group]
        for prev, curr in zip(types, types[1:]):
            steps[(curr, prev)] = steps.get((curr, prev), 0) + 1
        runs += [(unit, name, len(list(g))) for name, g in groupby(types[1:])]
    cells = as_cells(spark, shifts)
    for period in ("month", "week", "year"):
        got = rows(study.type_transitions(cells, period=period), "curr", "prev", "n")
        assert got == sorted((c, p, n) for (c, p), n in steps.items())
        assert rows(study.type_runs(cells, period=period)) == sorted(runs, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("seed,k", [(3, 5), (4, 30)])
def test_backtest(spark, seed, k):
    shifts = random_cells(seed)
    start, end = min(s[1] for s in shifts), max(s[1] for s in shifts)
    expected_rows, total, hits, step = [], 0, 0, 1
    while start + dt.timedelta(days=28 * step) <= end:
        cut = start + dt.timedelta(days=28 * step)
        learnt = {}
        for unit in {s[0] for s in shifts}:
            seen = [s for s in shifts if s[0] == unit and s[1] <= cut]
            if seen:
                times = sorted((s[1] for s in seen), reverse=True)
                bound = times[min(k, len(times)) - 1]
                learnt[unit] = decide([s[3] for s in seen if s[1] >= bound], 0.5)
        later = [s for s in shifts if cut < s[1] <= cut + dt.timedelta(days=28) and s[0] in learnt]
        match = sum(learnt[s[0]] == s[3] for s in later)
        total, hits = total + len(later), hits + match
        expected_rows.append((step, cut, len(later), match, total, hits))
        step += 1
    got = evaluate.backtest_monthly(as_cells(spark, shifts), k=k)
    names = ["step", "learnt_to", "shifts", "matches", "total_shifts", "total_matches"]
    assert [tuple(r) for r in got.orderBy("step").select(*names).collect()] == expected_rows


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_assignment_is_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    units, cars = 30, 22
    car_type = {f"{100 + c}": rng.choice(TYPES[:2]) for c in range(cars)}
    logons = []
    for u in range(units):
        liked = rng.sample(sorted(car_type), 4) if u % 3 else sorted(car_type)[:4]
        for i in range(12):
            logons.append((f"U{u:02d}", rng.choice(liked), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)))
    recent = spark.createDataFrame(
        [(g, c, car_type[c], t) for g, c, t in logons], "generic string, carid string, vehicle_type string, cdts2 timestamp_ntz"
    )
    uses = recent.groupBy("generic", "carid").agg(F.count("*").alias("n"))
    order = assign.unit_order(uses)
    types = expected.expected_type(recent)
    decided = {r.generic: r.expected_type for r in types.collect()}
    turns = sorted(decided, key=lambda g: (min(c for u, c, _ in logons if u == g), g))

    taken, walk = set(), {}
    for unit in turns:
        counts = {}
        for u, car, _ in logons:
            if u == unit and car_type[car] == decided[unit]:
                counts[car] = counts.get(car, 0) + 1
        for car in sorted(counts, key=lambda c: (-counts[c], c)):
            if car not in taken:
                taken.add(car)
                walk[unit] = car
                break
    first = assign.default_vehicle(recent, types, order)
    assert rows(first) == sorted(walk.items())

    listed = spark.createDataFrame(list(car_type.items()) + [("900", TYPES[0])], "vehicle string, vehicle_type string")
    free = {name: sorted(v for v, t in [*car_type.items(), ("900", TYPES[0])] if t == name and v not in taken) for name in TYPES}
    full = dict(walk)
    for unit in turns:
        if unit not in full and decided[unit]:
            if free[decided[unit]]:
                full[unit] = free[decided[unit]].pop(0)
            else:
                own = [c for u, c, _ in logons if u == unit]
                full[unit] = min(set(own), key=lambda c: (-own.count(c), c))
        elif unit not in full:
            full[unit] = None
    got = assign.default_vehicle_fill(types, first, order, uses, listed)
    assert dict(rows(got, "generic", "default_vehicle")) == full
    owned = got.where("source IN ('own', 'free')")
    assert owned.count() == owned.select("default_vehicle").distinct().count()


def test_vehicle_of_two_types_goes_to_the_first_turn(spark):
    for seed in range(3):
        rng = random.Random(seed)
        units = [(f"U{i:02d}", rng.choice(TYPES[:2])) for i in range(14)]
        listed = [(f"{v:03d}", name) for v in range(14) for name in TYPES[:2] if rng.random() < 0.7]
        taken, walk = set(), {}
        for unit, name in units:
            open_to = sorted(v for v, t in listed if t == name and v not in taken)
            if open_to:
                walk[unit] = open_to[0]
                taken.add(open_to[0])
        wanted = spark.createDataFrame(units, "generic string, expected_type string")
        none = spark.createDataFrame([], "generic string, default_vehicle string")
        uses = spark.createDataFrame([(u, "999", 1) for u, _ in units], "generic string, carid string, n bigint")
        types = spark.createDataFrame(listed, "vehicle string, vehicle_type string")
        got = assign.default_vehicle_fill(wanted, none, assign.unit_order(uses), uses, types)
        assert dict(rows(got.where("source = 'free'"), "generic", "default_vehicle")) == walk


def test_a_chain_of_units_settles_and_the_state_shrinks(spark):
    """Every unit but the first wants the vehicle of the one before it first, then its own."""
    logons = [(f"U{u:02d}", f"{v:03d}", n) for u in range(48) for v, n in ((u - 1, 2), (u, 1)) if v >= 0]
    recent = spark.createDataFrame(logons, "generic string, carid string, n int").select(
        "generic", "carid", F.lit("T").alias("vehicle_type"), F.explode(F.sequence(F.lit(1), "n")))
    wanted = recent.select("generic", F.lit("T").alias("expected_type")).distinct()
    order = recent.select("generic").distinct().select(
        "generic", F.struct(F.lit("").alias("_first"), F.col("generic").alias("_unit")).alias("turn"))
    seen = []
    got = assign.default_vehicle(recent, wanted, order, watch=seen.append)
    # the first takes 0, so each one after it is left with its own
    assert rows(got) == [(f"U{u:02d}", f"{u:03d}") for u in range(48)]
    assert seen[-1] == 0 and all(a > b for a, b in zip(seen, seen[1:]))


@pytest.mark.parametrize("units, vehicles, names, size", [(1000, 1000, 2, 10_000), (1000, 1000, 2, 80), (300, 400, 5, 30)])
def test_vehicles_of_several_types_in_few_rounds(spark, units, vehicles, names, size):
    rng = random.Random(units + size)
    types = [f"T{i}" for i in range(names)]
    queue = [(f"U{i:04d}", rng.choice(types)) for i in range(units)]
    listed = [(f"{v:04d}", name) for v in range(vehicles) for name in (rng.sample(types, 2) if names > 2 else types)]
    taken, walk = set(), {}
    for unit, name in queue:
        open_to = [v for v, t in listed if t == name and v not in taken]
        if open_to:
            walk[unit] = open_to[0]
            taken.add(open_to[0])
    wanted = spark.createDataFrame(queue, "generic string, expected_type string")
    none = spark.createDataFrame([], "generic string, default_vehicle string")
    uses = spark.createDataFrame([(u, "999", 1) for u, _ in queue], "generic string, carid string, n bigint")
    given = spark.createDataFrame(listed, "vehicle string, vehicle_type string")
    seen = []
    got = assign.default_vehicle_fill(wanted, none, assign.unit_order(uses), uses, given, slice_size=size, watch=seen.append)
    assert dict(rows(got.where("source = 'free'"), "generic", "default_vehicle")) == walk
    assert len(seen) < 20 and seen[-1] == 0


def test_types_tied_together_without_a_free_vehicle(spark, table):
    wanted = table("generic string, expected_type string", ("U1", "T1"), ("U2", "T2"))
    first = table("generic string, default_vehicle string", ("U1", "7"))
    uses = table("generic string, carid string, n bigint", ("U1", "7", 1), ("U2", "8", 1))
    listed = table("vehicle string, vehicle_type string", ("7", "T1"), ("7", "T2"))
    got = assign.default_vehicle_fill(wanted, first, assign.unit_order(uses), uses, listed)
    assert rows(got, "generic", "default_vehicle", "source") == [("U1", "7", "own"), ("U2", "8", "duplicate")]


def test_numbers_run_through_large_groups(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("g"), ((F.col("id") * 7919) % 1000).alias("v")
    )
    out = number_rows(df, ["g"], ["v"]).collect()
    for group in ("hot", "rare"):
        ordered = sorted((r for r in out if r.g == group), key=lambda r: r.v)
        assert [r.place for r in ordered] == list(range(1, len(ordered) + 1))


def test_same_rows_after_shuffling(spark):
    shifts = random_cells(9)
    baseline = rows(study.type_runs(as_cells(spark, shifts)))
    random.Random(0).shuffle(shifts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert rows(study.type_runs(as_cells(spark, shifts))) == baseline
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
